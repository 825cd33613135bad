"""Compositions of operators into whole feature and model runs."""

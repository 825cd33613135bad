"""Operators for preparing training text: DataFrame in, DataFrame out."""

"""Views of the given tables as flights, aircraft and trajectories, and checked queries."""

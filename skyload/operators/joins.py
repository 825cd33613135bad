"""Joins of flights with aircraft data, trajectory features and subsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyload.constants import KEY, TARGET
from skyload.session import broadcast_if_small

# Keys alone that are broadcast at most: some 16 MB.
MOST_KEYS = 2_000_000


def enrich(flights: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Add aircraft data by type; flights of unknown type get NULL."""
    return flights.join(broadcast_if_small(aircraft), "aircraft_type", "left")


def known_types(flights: DataFrame, aircraft: DataFrame) -> DataFrame:
    """Flights whose type is in the aircraft table."""
    types = aircraft.select("aircraft_type")
    return flights.join(broadcast_if_small(types), "aircraft_type", "left_semi")


def with_flight_features(
    flights: DataFrame, features: DataFrame | None, use_trajectory: bool = True
) -> DataFrame:
    """Flights that have trajectory features, with them; all flights when unused."""
    if not use_trajectory:
        return flights
    return flights.join(features, KEY, "inner")


def points_of(points: DataFrame, flights: DataFrame, key: str = KEY) -> DataFrame:
    """Points of the flights that are left, before any work is done for the others; NULL is no flight."""
    return points.join(broadcast_if_small(flights.select(key).distinct(), MOST_KEYS), key, "left_semi")


def targets_of(flights: DataFrame, subset: DataFrame, target: str = TARGET) -> DataFrame:
    """Key and target of the flights that are in ``subset``."""
    return flights.select(KEY, target).join(subset.select(KEY), KEY, "left_semi")


def join_predictions(tables: dict[str, DataFrame], prediction: str = "prediction") -> DataFrame:
    """One row per flight with a ``tow_<model>`` column per model."""
    wide = None
    for model, table in tables.items():
        column = table.select(KEY, F.col(prediction).alias(f"tow_{model}"))
        wide = column if wide is None else wide.join(column, KEY)
    return wide

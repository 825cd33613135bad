"""Features from flights and their trajectories, split into weight segments."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyload.constants import NOT_NORMALISED
from skyload.functions.times import add_duration
from skyload.operators.columns import complete_rows, drop_features, valid_altitudes
from skyload.operators.joins import enrich, points_of, with_flight_features
from skyload.operators.outliers import clean, clean_trajectory
from skyload.operators.prepare import label_encode, normalise, one_hot
from skyload.operators.segments import split_by_mtow
from skyload.operators.trajectory import trajectory_features
from skyload.session import stable
from skyload.settings import Course, Settings


def trajectory_flight_features(
    flights: DataFrame,
    aircraft: DataFrame,
    points: DataFrame,
    settings: Settings = Settings(use_trajectory=True, refine_phases=True),
    course: Course = Course(),
    isolation: bool = True,
) -> DataFrame:
    """Feature rows with key, target, aircraft type and weight in kg.

    Flights are enriched before cleaning, so those of unknown type drop out as
    incomplete. Weight and distance stay in their units, for a split by them. Points of
    flights that dropped out are left alone.
    """
    rows = enrich(add_duration(flights, exact=True), aircraft)
    # Read twice: for the points and for the features.
    rows = stable(clean(rows, settings.contamination) if isolation else complete_rows(rows))
    if settings.use_trajectory:
        points = points_of(points, rows, course.key)
        # The points are read again to find long flights: the forests must not run twice.
        points = stable(clean_trajectory(points, settings.contamination, course)) if isolation else valid_altitudes(points)
        features = trajectory_features(
            points, course, settings.refine_phases, settings.manual_phases, settings.wind_factor,
            settings.altitude_factor,
        )
        # Moments, codes and the result are three passes over the joined rows.
        rows = stable(with_flight_features(rows, features))
    rows = normalise(rows, ["mtow_kg", *NOT_NORMALISED], keep_distance=True)
    rows = one_hot(label_encode(rows, preserve=["aircraft_type"]))
    return drop_features(rows)


def segmented_features(
    flights: DataFrame,
    aircraft: DataFrame,
    points: DataFrame,
    settings: Settings = Settings(use_trajectory=True, refine_phases=True),
    course: Course = Course(),
    isolation: bool = True,
) -> DataFrame:
    """The same with a ``segment`` and the weight standardised inside it."""
    features = trajectory_flight_features(
        flights, aircraft, points, settings, course, isolation
    )
    return split_by_mtow(features)

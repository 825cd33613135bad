"""Features and models from the flight table alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from skyload.constants import KEY
from skyload.functions.times import add_duration
from skyload.operators import models as m
from skyload.operators.columns import complete_rows, drop_features, scoring_set, valid_altitudes
from skyload.operators.fitted import Preparation, apply_preparation, fit_preparation
from skyload.operators.joins import enrich, known_types, points_of, with_flight_features
from skyload.operators.ordering import join_on
from skyload.operators.outliers import clean, clean_trajectory
from skyload.operators.prepare import label_encode, normalise, one_hot, train_test_split
from skyload.operators.scores import best_features, f_scores, keep_features
from skyload.operators.trajectory import trajectory_features
from skyload.session import stable
from skyload.settings import Course, Settings
from skyload.sources.sinks import load_model, save_model, write_feature_reports, write_metrics, write_predictions, write_stage


def tabular_features(
    flights: DataFrame,
    aircraft: DataFrame,
    settings: Settings = Settings(),
    points: DataFrame | None = None,
    course: Course = Course(),
    isolation: bool = True,
) -> DataFrame:
    """Feature rows with key and target, prepared by their own moments and codes.

    Cleaning comes first, then flights of unknown type drop out. Without ``isolation``
    cleaning only drops incomplete rows.
    """
    # Moments, codes and the result are three passes over the joined rows.
    rows = normalise(stable(tabular_rows(flights, aircraft, settings, points, course, isolation)))
    return one_hot(label_encode(rows), always=(), drop_first=True)


def tabular_rows(
    flights: DataFrame,
    aircraft: DataFrame,
    settings: Settings = Settings(),
    points: DataFrame | None = None,
    course: Course = Course(),
    isolation: bool = True,
) -> DataFrame:
    """What :func:`tabular_features` prepares, as it was found. Points of flights that dropped out are left alone."""
    rows = clean(flights, settings.contamination) if isolation else complete_rows(flights)
    rows = add_duration(rows, exact=True)
    if settings.use_external_data:
        rows = known_types(enrich(rows, aircraft), aircraft)
    if settings.use_trajectory:
        rows = stable(rows)
        points = points_of(points, rows, course.key)
        if isolation:
            # The points are read again to find long flights: the forests must not run twice.
            points = stable(clean_trajectory(points, settings.contamination, course))
        else:
            points = valid_altitudes(points)
        features = trajectory_features(
            points, course, settings.refine_phases, settings.manual_phases, settings.wind_factor,
            settings.altitude_factor,
        )
        rows = with_flight_features(rows, features)
    return rows if settings.use_all_features else drop_features(rows)


@dataclass(frozen=True)
class TabularRun:
    """What a tabular run leaves behind."""

    models: Mapping[str, PipelineModel]
    selected: list[str]
    metrics: DataFrame
    predictions: DataFrame


def run_tabular(
    features: DataFrame,
    settings: Settings = Settings(),
    learners: Mapping[str, m.Learner] | None = None,
    folder: str | None = None,
) -> TabularRun:
    """Split, select, train, judge and predict; with a ``folder``, write what came out.

    Below the folder go the feature table (``features``), the reports of the selection, ``predictions``,
    ``metrics`` with the parameters of each model, and the ``models``.
    """
    features = write_stage(features, folder, "features") if folder else stable(features)
    train, test = train_test_split(features)
    scores = stable(f_scores(train))
    selected = best_features(scores, settings.num_features)
    train, test, _ = keep_features(train, test, selected)
    models = {
        name: m.train(train, learner, test)
        for name, learner in (learners or {settings.learner: m.TABULAR}).items()
    }
    metrics, predictions = m.evaluate(models, test), m.batch_predict(models, test)
    if folder:
        write_feature_reports(scores, selected, folder)
        write_predictions(predictions, f"{folder}/predictions")
        write_metrics(metrics, f"{folder}/metrics", m.settings_table(features.sparkSession, models))
        for name, model in models.items():
            save_model(model, f"{folder}/models", name)
    return TabularRun(models, selected, metrics, predictions)


def train_for_scoring(
    flights: DataFrame,
    aircraft: DataFrame,
    folder: str,
    settings: Settings = Settings(),
    learners: Mapping[str, m.Learner] | None = None,
    points: DataFrame | None = None,
    course: Course = Course(),
    isolation: bool = True,
) -> DataFrame:
    """Fit a preparation and models on training flights, write both below ``folder``, and give the errors on the test flights.

    The preparation sees training rows alone, so the test rows are prepared as flights to be scored later are.
    """
    train, test = train_test_split(stable(tabular_rows(flights, aircraft, settings, points, course, isolation)))
    prepared = fit_preparation(train, drop_first=True)
    prepared.save(f"{folder}/preparation")
    train, test = stable(apply_preparation(train, prepared)), stable(apply_preparation(test, prepared))
    selected = best_features(f_scores(train), settings.num_features)
    train, test, _ = keep_features(train, test, selected)
    models = {name: m.train(train, learner, test) for name, learner in (learners or {settings.learner: m.TABULAR}).items()}
    for name, model in models.items():
        save_model(model, f"{folder}/models", name)
    return m.evaluate(models, test)


def score_flights(
    flights: DataFrame,
    aircraft: DataFrame,
    folder: str,
    names: Sequence[str],
    settings: Settings = Settings(),
    points: DataFrame | None = None,
    course: Course = Course(),
) -> DataFrame:
    """One row per flight to be scored, (flight_id, ``tow_<model>`` for each name), by what :func:`train_for_scoring` wrote.

    The flights need no target, and none is dropped: a prediction is NULL where a flight lacks a feature, its aircraft type
    is unknown among others. Values that training did not have are coded as unseen.
    """
    rows = add_duration(scoring_set(flights), exact=True)
    if settings.use_external_data:
        rows = enrich(rows, aircraft)
    if settings.use_trajectory:
        features = trajectory_features(
            valid_altitudes(points), course, settings.refine_phases, settings.manual_phases, settings.wind_factor,
            settings.altitude_factor,
        )
        rows = join_on(rows, features, [KEY], "left")
    spark = flights.sparkSession
    told = apply_preparation(drop_features(rows), Preparation.load(spark, f"{folder}/preparation"))
    return m.batch_predict({name: load_model(spark, f"{folder}/models", name) for name in names}, told)

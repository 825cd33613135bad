"""An ensemble of models for each segment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyload.constants import MTOW_SEGMENTS, TARGET
from skyload.operators import models as m
from skyload.operators.columns import complete_rows, drop_features
from skyload.operators.prepare import train_test_split
from skyload.operators.scores import select_features
from skyload.operators.segments import SEGMENT
from skyload.session import stable
from skyload.sources.sinks import save_model, write_metrics, write_predictions

LEARNERS = {"boosted": m.FIRST, "histogram": m.SECOND}


def train_segment(
    rows: DataFrame, learners: Mapping[str, m.Learner], k: int = 15
) -> m.Ensemble | None:
    """Split, select and train on one segment; None without both train and test rows."""
    train, test = train_test_split(rows)
    if train.isEmpty() or test.isEmpty():
        return None
    train, test, _ = select_features(train, test, k)
    return m.train_ensemble(train, test, learners)


def train_segment_models(
    split: DataFrame,
    learners: Mapping[str, m.Learner] = LEARNERS,
    segments: Sequence[str] = MTOW_SEGMENTS,
    k: int = 15,
    model_path: str | None = None,
    parallelism: int = 3,
    folder: str | None = None,
) -> tuple[dict[str, m.Ensemble], DataFrame]:
    """Ensembles by segment, and a row (segment, model, errors) per model.

    Models go below ``model_path``; below ``folder`` go each segment's ``predictions``, and its ``metrics`` with the
    parameters of each model.

    The split table is computed once and written by segment, so each segment's many passes read its own rows.
    ``parallelism`` segments are trained at a time; they share nothing.
    """
    split = stable(drop_features(complete_rows(split), final_drop=True), SEGMENT)

    def of_segment(name: str) -> m.Ensemble | None:
        return train_segment(split.where(F.col(SEGMENT) == name).drop(SEGMENT), learners, k)

    with ThreadPool(parallelism) as pool:
        session = split.sparkSession
        found = pool.map(inheritable_thread_target(session)(of_segment), segments)
    trained = {name: e for name, e in zip(segments, found, strict=True) if e is not None}
    for name, ensemble in trained.items():
        for learner, model in ensemble.models.items():
            if model_path:
                save_model(model, model_path, f"{name}_{learner}")
        if folder:
            write_predictions(ensemble.predictions.drop(TARGET), f"{folder}/predictions/{name}")
            write_metrics(ensemble.metrics, f"{folder}/metrics/{name}", m.settings_table(split.sparkSession, ensemble.models))
    tables = [e.metrics.select(F.lit(n).alias(SEGMENT), "*") for n, e in trained.items()]
    return trained, reduce(DataFrame.unionByName, tables)

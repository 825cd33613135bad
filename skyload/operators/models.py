"""Training, searching and applying regressors with Spark ML."""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyload.constants import KEY, TARGET
from skyload.operators.boosting import TREES_A_STAGE, Boosting, HistogramModel, bin_rows, boost_all, stage_errors, train_histogram
from skyload.operators.boosting_whole import boost_whole, send, unsend
from skyload.operators.columns import counted_rows, numeric_columns
from skyload.operators.linear import LinearModel, eliminate, lasso, least_squares, products
from skyload.operators.metrics import ensemble_mean, evaluate_models
from skyload.operators.neighbours import NeighbourModel, index_rows
from skyload.operators.prepare import split_hash
from skyload.operators.reweighted import ReweightedTrees, train_reweighted
from skyload.operators.search import Range, propose
from skyload.operators.support import SupportModel, train_support
from skyload.session import release, stable

# Models that predict by a method of their own.
OWN = (HistogramModel, LinearModel, NeighbourModel, ReweightedTrees, SupportModel)
Model = PipelineModel | HistogramModel | LinearModel | NeighbourModel | ReweightedTrees | SupportModel

SEED = 42
FEATURES, HELD_OUT, WEIGHT = "features", "_held_out", "_weight"
# Rows of a task in Spark ML's trees, about: some 400 bytes each with errors and labels so far.
TASK_ROWS = 250_000
# The settings of the grid search, and the ranges that the searches draw from.
GRID = {"maxIter": [1000, 2000], "stepSize": [0.01, 0.1], "maxDepth": [4, 6, 8]}
ITERATIONS = {"boosted": (100, 1000), "boosted_deep": (500, 2000)}
DEPTHS = {"boosted": (3, 10), "boosted_deep": (4, 10)}


@dataclass(frozen=True)
class Learner:
    """Settings of a learner; ``kind`` is ``gbt``, ``histogram``, ``symmetric``, ``forest``, ``linear``, ``lasso``, ``reweighted``, ``neighbours`` or ``support``.

    With a test set ``gbt`` stops at the first tree that does not lower its error by more than the share ``tolerance``, as Spark's
    boosting looks at one at a time. ``histogram`` and ``symmetric`` (:mod:`skyload.operators.boosting`) end ``patience`` trees after the best one and
    are cut there; they alone have the penalty ``l2``. A forest has no rate.
    """

    kind: str = "gbt"
    depth: int = 6
    iterations: int = 5000
    rate: float = 0.1
    subsample: float = 1.0
    column_share: str = "auto"
    tolerance: float = 0.0
    l2: float = 1.0
    patience: int = 50
    neighbours: int = 5


# Kinds that are boosted on a table of bytes.
BINNED = ("histogram", "symmetric")
# Defaults of the two learners of an ensemble, and of the tabular one.
FIRST = Learner("symmetric", depth=9, iterations=2000, rate=0.15, l2=3.0)
SECOND = Learner("histogram", depth=8, iterations=2000, rate=0.05)
TABULAR = Learner("gbt", depth=6, iterations=5000, rate=0.1)
# A candidate of the leaderboard, with the depth, trees and rate that are usual for it.
REWEIGHTED = Learner("reweighted", depth=3, iterations=50, rate=1.0)


def estimator(learner: Learner, target: str = TARGET):
    """The Spark ML regressor for these settings."""
    shared = {"featuresCol": FEATURES, "labelCol": target, "predictionCol": "prediction"}
    if learner.kind == "gbt":
        return GBTRegressor(
            **shared, seed=SEED, maxDepth=learner.depth, maxIter=learner.iterations,
            stepSize=learner.rate, subsamplingRate=learner.subsample, validationTol=learner.tolerance,
            featureSubsetStrategy="all" if learner.column_share == "auto" else learner.column_share,
        )
    if learner.kind == "forest":
        return RandomForestRegressor(
            **shared, seed=SEED, maxDepth=learner.depth, numTrees=learner.iterations,
            subsamplingRate=learner.subsample, featureSubsetStrategy=learner.column_share,
        )
    if learner.kind == "linear":
        return LinearRegression(**shared)
    if learner.kind == "lasso":
        return LinearRegression(**shared, regParam=1.0, elasticNetParam=1.0, standardization=False)
    raise ValueError(f"no such learner: {learner.kind}")


def feature_columns(df: DataFrame, target: str = TARGET) -> list[str]:
    """Numeric columns but for key and target."""
    return numeric_columns(df, exclude=(KEY, target, HELD_OUT))


def train(
    df: DataFrame,
    learner: Learner = TABULAR,
    test: DataFrame | None = None,
    target: str = TARGET,
    features: Sequence[str] | None = None,
) -> Model:
    """Fit on complete rows of ``df``. Boosting stops early on ``test`` when given."""
    features = list(features or feature_columns(df, target))
    if learner.kind in BINNED:
        return train_histogram(df, boosting_of(learner), test, target, features)
    if learner.kind in ("linear", "lasso"):
        return (least_squares if learner.kind == "linear" else lasso)(products(df, features, target))
    if learner.kind == "reweighted":
        return train_reweighted(df, features, target, learner.depth, learner.iterations, learner.rate, seed=SEED)
    if learner.kind == "neighbours":
        return index_rows(df, features, target, learner.neighbours)
    if learner.kind == "support":
        return train_support(df, features, target, seed=SEED)[0]
    regressor = estimator(learner, target)
    rows = df.select(KEY, *features, target)
    if test is not None and learner.kind == "gbt":
        regressor = regressor.setValidationIndicatorCol(HELD_OUT)
        held = test.select(KEY, *features, target).withColumn(HELD_OUT, F.lit(True))
        rows = rows.withColumn(HELD_OUT, F.lit(False)).unionByName(held)
    assembler = VectorAssembler(inputCols=features, outputCol=FEATURES, handleInvalid="error")
    return Pipeline(stages=[assembler, regressor]).fit(_dealt(rows.dropna("any")))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows in partitions of at most about ``TASK_ROWS``: Spark ML holds a partition's rows for all levels and trees, and a task reads one whole.

    A reader's partitions are cut by bytes of files, which says little about rows of few distinct values.
    """
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS))
    return rows.repartition(parts, KEY)


def boosting_of(learner: Learner) -> Boosting:
    """What histogram boosting takes of a learner's settings."""
    share = 1.0 if learner.column_share in ("auto", "all") else float(learner.column_share)
    return Boosting(learner.depth, learner.iterations, learner.rate, learner.l2, learner.subsample, share, learner.patience, SEED, learner.kind == "symmetric")


def inputs(model: Model) -> list[str]:
    """The features of a model."""
    return model.features if isinstance(model, OWN) else model.stages[0].getInputCols()


def _complete(model: Model) -> Column:
    """Whether a row has all features of a model."""
    return reduce(Column.__and__, [F.col(f"`{c}`").isNotNull() for c in inputs(model)], F.lit(True))


def predict(
    model: Model, df: DataFrame, carry: Sequence[str] = (KEY,)
) -> DataFrame:
    """Prediction per row; NULL where a feature is missing."""
    return batch_predict({"": model}, df, carry).withColumnRenamed("tow_", "prediction")


def batch_predict(models: Mapping[str, Model], df: DataFrame, carry: Sequence[str] = (KEY,)) -> DataFrame:
    """One row per flight: ``carry``, and ``tow_<model>`` for each model, from chained transforms.

    A prediction is NULL where the flight lacks a feature of that model.
    """
    wide = df
    for i, model in enumerate(models.values()):
        if isinstance(model, OWN):
            wide = model.predict(wide, f"_tow_{i}", wide.columns)
            continue
        assembler = model.stages[0].copy()
        assembler.setHandleInvalid("keep").setOutputCol(f"_vector_{i}")
        regressor = model.stages[-1].copy()
        regressor.setFeaturesCol(f"_vector_{i}").setPredictionCol(f"_tow_{i}")
        wide = regressor.transform(assembler.transform(wide))
    told = [F.when(_complete(model), F.col(f"_tow_{i}")).alias(f"tow_{name}") for i, (name, model) in enumerate(models.items())]
    return wide.select(*carry, *told)


def importances(model: Model, name: str = "importance") -> DataFrame:
    """Rows (feature, <name>); a row per feature of the model."""
    if isinstance(model, OWN):
        return model.importances(name)
    features = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(features, values, strict=True))
    return SparkSession.active().createDataFrame(rows, f"feature string, `{name}` double")


def mean_importances(models: Mapping[str, Model], top: int | None = None) -> DataFrame:
    """Importances of several models side by side with their mean, largest first."""
    table = None
    for name, model in models.items():
        column = importances(model, f"{name}_importance")
        table = column if table is None else table.join(column, "feature", "full_outer")
    names = [f"{name}_importance" for name in models]
    known = sum((F.when(F.col(n).isNotNull(), 1).otherwise(0) for n in names), F.lit(0))
    total = sum((F.coalesce(F.col(n), F.lit(0.0)) for n in names), F.lit(0.0))
    ranked = table.withColumn("mean_importance", F.try_divide(total, known)).orderBy(
        F.desc("mean_importance"), "feature"
    )
    return ranked.limit(top) if top else ranked


def _folds(df: DataFrame, count: int, seed: str = "fold") -> DataFrame:
    """Fold by hash of the key, so folds do not depend on partitioning."""
    digits = F.conv(F.substring(split_hash(seed=seed), 1, 8), 16, 10).cast("long")
    return df.withColumn("_fold", F.pmod(digits, F.lit(count)).cast("int"))


def _cross_validate(df, regressor, grid, target, metric, folds, parallelism, features):
    features = list(features or feature_columns(df, target))
    rows = _folds(df, folds).dropna("any", subset=[*features, target])
    assembled = (
        VectorAssembler(inputCols=features, outputCol=FEATURES)
        .transform(rows)
        .select(FEATURES, target, "_fold")
        .persist()
    )
    evaluator = RegressionEvaluator(labelCol=target, metricName=metric)
    search = CrossValidator(
        estimator=regressor, estimatorParamMaps=grid, evaluator=evaluator,
        numFolds=folds, foldCol="_fold", parallelism=parallelism, seed=SEED,
    )
    try:
        fitted = search.fit(assembled)
    finally:
        assembled.unpersist()
    assembler = VectorAssembler(inputCols=features, outputCol=FEATURES)
    return PipelineModel([assembler, fitted.bestModel]), fitted.avgMetrics


def _trial_table(df: DataFrame, trials: list[dict], metric: str) -> DataFrame:
    names = sorted({n for t in trials for n in t["params"]})
    schema = ", ".join(["trial int", f"{metric} double", *[f"`{n}` double" for n in names]])
    rows = [
        (i, None if t["score"] is None else float(t["score"]), *[float(t["params"][n]) if n in t["params"] else None for n in names])
        for i, t in enumerate(trials)
    ]
    return df.sparkSession.createDataFrame(rows, schema)


def grid_search(
    df: DataFrame,
    learner: Learner = FIRST,
    grid: Mapping[str, Sequence] = GRID,
    folds: int = 3,
    target: str = TARGET,
    parallelism: int = 4,
    features: Sequence[str] | None = None,
) -> tuple[Model, DataFrame]:
    """Best model by mean squared error over the folds, and a row per setting tried."""
    if learner.kind in BINNED:
        return _grid_of_histograms(df, learner, grid, folds, target, parallelism, features)
    regressor = estimator(learner, target)
    names = {"numTrees": "maxIter"} if learner.kind == "forest" else {}
    builder = ParamGridBuilder()
    for name in regressor.params:
        values = grid.get(names.get(name.name, name.name))
        if values is not None and not (learner.kind == "forest" and name.name == "stepSize"):
            builder = builder.addGrid(name, list(values))
    maps = builder.build()
    model, scores = _cross_validate(df, regressor, maps, target, "mse", folds, parallelism, features)
    trials = [
        {"params": {p.name: v for p, v in m.items()}, "score": s}
        for m, s in zip(maps, scores, strict=True)
    ]
    return model, _trial_table(df, trials, "mse")


class _BinnedFolds:
    """The rows without each fold in bins, and the fold in the same ones: written once for all settings of a search.

    ``rows`` are complete and know their ``_fold``; equal ones may be one with their number as its ``weight``.
    """

    def __init__(self, rows: DataFrame, folds: int, target: str, features: list[str], weight: str | None = None) -> None:
        self.rows, self.parts = rows, []
        for fold in range(folds):
            binned = bin_rows(rows.where(F.col("_fold") != fold), features, target, weight)
            held = binned.of(rows.where(F.col("_fold") == fold), target)
            self.parts.append((binned, held, held.agg(F.sum("n")).first()[0] or 0))
        self.sent = [send(binned, held) for binned, held, _ in self.parts]

    @property
    def whole(self) -> bool:
        """Whether tasks take a model each."""
        return all(s is not None for s in self.sent)

    def errors(self, learners: Sequence[Learner], parallelism: int) -> list[list[float]]:
        """For each learner, by fold, the mean squared error of a model of the other ones; NaN for an empty fold.

        To nine digits, as sums depend on their order beyond. Learners that differ in the number of trees alone share the trees of the longest.
        All models grow side by side where a task takes one, else those of ``parallelism`` learners.
        """
        longest: dict[Learner, int] = {}
        for learner in learners:
            alike = replace(learner, iterations=0)
            longest[alike] = max(longest.get(alike, 0), learner.iterations)
        kinds, found = list(longest), {}
        at_once = len(kinds) if self.whole else parallelism
        for start in range(0, len(kinds), at_once):
            some = kinds[start : start + at_once]
            settings = [boosting_of(replace(kind, iterations=longest[kind])) for kind in some]
            if self.whole:
                made = boost_whole([(sent, s) for s in settings for sent in self.sent], TREES_A_STAGE, keep=False)
                courses = [errors for _, errors in made]
            else:
                models = boost_all([(binned, s) for s in settings for binned, *_ in self.parts])
                held = [held for _ in settings for _, held, _ in self.parts]
                courses = [[e for _, e in sorted(stage_errors(h, model).items())] for h, model in zip(held, models, strict=True)]
            found |= {kind: courses[i * len(self.parts) : (i + 1) * len(self.parts)] for i, kind in enumerate(some)}
        return [
            [
                float(f"{course[min(learner.iterations, len(course) - 1)] / count:.9g}") if count else float("nan")
                for course, (*_, count) in zip(found[replace(learner, iterations=0)], self.parts, strict=True)
            ]
            for learner in learners
        ]

    def release(self) -> None:
        for sent in self.sent:
            unsend(sent)
        for table in (self.rows, *[t for binned, held, _ in self.parts for t in (binned.table, held)]):
            release(table)


def _rows_in_folds(df: DataFrame, folds: int, target: str, features: list[str]) -> DataFrame:
    """Complete rows with key and fold, written."""
    return stable(_folds(df, folds).select(KEY, *[f"`{c}`" for c in features], f"`{target}`", "_fold").dropna("any"))


def _grid_of_histograms(df, learner, grid, folds, target, parallelism, features):
    features = list(features or feature_columns(df, target))
    parts = _BinnedFolds(_rows_in_folds(df, folds, target, features), folds, target, features)
    named = {"maxIter": "iterations", "stepSize": "rate", "maxDepth": "depth", "l2": "l2"}
    settings = [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]
    learners = [replace(learner, **{named[n]: v for n, v in s.items()}) for s in settings]
    scores = [sum(of_setting) / folds for of_setting in parts.errors(learners, parallelism)]
    best = learners[scores.index(min(scores))]
    trials = [{"params": p, "score": s} for p, s in zip(settings, scores, strict=True)]
    model = train(parts.rows, best, target=target, features=features)
    parts.release()
    return model, _trial_table(df, trials, "mse")


def _random_settings(draw: random.Random, kind: str, iterations: tuple[int, int], depth: tuple[int, int]) -> dict[str, float]:
    """One draw from the search space; trees in steps of a hundred, or of one where the range is shorter."""
    low, high = iterations
    settings = {
        "maxIter": draw.randrange(low, high + 1, 100 if high - low >= 100 else 1),
        "maxDepth": draw.randint(*depth),
        "stepSize": 0.01 * (0.3 / 0.01) ** draw.random(),
    }
    if kind != "boosted_deep":
        settings["subsamplingRate"] = draw.uniform(0.5, 1.0)
        settings["featureSubsetStrategy"] = draw.uniform(0.5, 1.0)
    return settings


def random_search(
    df: DataFrame,
    trials: int = 50,
    timeout: float | None = None,
    kind: str = "boosted",
    folds: int = 3,
    target: str = TARGET,
    iterations: tuple[int, int] | None = None,
    depth: tuple[int, int] | None = None,
    parallelism: int = 4,
    features: Sequence[str] | None = None,
) -> tuple[dict, DataFrame]:
    """Best settings by cross-validated rmse, and a row per trial.

    ``iterations`` and ``depth`` are the ranges drawn from, by default those of ``ITERATIONS`` and ``DEPTHS``. With a ``timeout`` no
    trial starts after so many seconds, but the first one always runs; the trials that did not are listed without an rmse.
    Trees are boosted node by node without a penalty. Rows equal in fold, features and target are one with their number as its weight, in
    trees and errors; a tree that takes a share of the rows draws them together. Without complete rows there is nothing to search on,
    which is a ValueError.
    """
    features = list(features or feature_columns(df, target))
    draw, started = random.Random(SEED), time.monotonic()
    settings = [_random_settings(draw, kind, iterations or ITERATIONS[kind], depth or DEPTHS[kind]) for _ in range(trials)]
    usual = Learner("histogram", l2=0.0)
    learners = [replace(usual, **{_NAMED[n]: str(v) if n == "featureSubsetStrategy" else v for n, v in s.items()}) for s in settings]
    rows = _folds(df, folds).dropna("any", subset=[*features, target]).select(*[f"`{c}`" for c in (*features, target)], "_fold")
    parts = _BinnedFolds(stable(counted_rows(rows, WEIGHT)), folds, target, features, WEIGHT)
    scores: list[float | None] = []
    try:
        if not any(count for *_, count in parts.parts):
            raise ValueError("no complete rows to search on")
        # Trials know nothing of each other: without a limit of time they are one batch.
        at_once = parallelism if timeout is not None else max(trials, 1)
        for i in range(0, trials, at_once):
            some = learners[i : i + at_once]
            late = bool(i) and timeout is not None and time.monotonic() - started > timeout
            scores += [None] * len(some) if late else [sum(e**0.5 for e in errors) / folds for errors in parts.errors(some, parallelism)]
    finally:
        parts.release()
    done = [{"params": p, "score": s} for p, s in zip(settings, scores, strict=True)]
    best = min((t for t in done if t["score"] is not None), key=lambda t: t["score"])
    return best["params"], _trial_table(df, done, "rmse")


def search_space(kind: str, iterations: tuple[int, int] | None = None, depth: tuple[int, int] | None = None) -> dict[str, Range]:
    """The ranges of :func:`adaptive_search`; trees in steps of a hundred, or of one where the range is shorter."""
    low, high = iterations or ITERATIONS[kind]
    shared = {
        "maxIter": Range(low, high, 100 if high - low >= 100 else 1),
        "maxDepth": Range(*(depth or DEPTHS[kind]), 1),
        "stepSize": Range(0.01, 0.3, log=True),
    }
    if kind == "boosted_deep":
        return shared | {"l2": Range(0.01, 10.0, log=True)}
    return shared | {"subsamplingRate": Range(0.5, 1.0), "featureSubsetStrategy": Range(0.5, 1.0)}


_NAMED = {
    "maxIter": "iterations", "maxDepth": "depth", "stepSize": "rate",
    "l2": "l2", "subsamplingRate": "subsample", "featureSubsetStrategy": "column_share",
}


def adaptive_search(
    df: DataFrame,
    trials: int = 50,
    timeout: float | None = None,
    kind: str = "boosted",
    folds: int = 3,
    target: str = TARGET,
    iterations: tuple[int, int] | None = None,
    depth: tuple[int, int] | None = None,
    parallelism: int = 4,
    features: Sequence[str] | None = None,
) -> tuple[Learner, DataFrame]:
    """The learner of the best trial by cross-validated rmse, and a row per trial; settings are proposed from earlier trials.

    ``boosted`` searches the second learner of an ensemble, ``boosted_deep`` the first with its leaf penalty. A trial is proposed from those that began at
    least ``parallelism`` before it, with the ones after them as running, whichever ends first: the table is the same in every run. With a ``timeout``
    no trial starts after so many seconds, but the first one always runs; the trials that did not are left out of the table.
    A fold without complete rows has no error to go by, which is a ValueError.
    """
    features = list(features or feature_columns(df, target))
    space = search_space(kind, iterations, depth)
    usual = FIRST if kind == "boosted_deep" else SECOND
    parts = _BinnedFolds(_rows_in_folds(df, folds, target, features), folds, target, features)
    if not all(held for *_, held in parts.parts):
        parts.release()
        raise ValueError("a fold has no complete rows")

    def learner(settings: Mapping[str, float]) -> Learner:
        return replace(usual, **{_NAMED[n]: str(v) if n == "featureSubsetStrategy" else v for n, v in settings.items()})

    started, tried = time.monotonic(), []
    try:
        late = False
        while len(tried) < trials and not late:
            # Those that run side by side begin together: the first of them knows less than has ended by then.
            begun: list[Mapping[str, float]] = []
            for i in range(len(tried), min(trials, len(tried) + parallelism)):
                late = bool(i) and timeout is not None and time.monotonic() - started > timeout
                if late:
                    break
                ended = max(0, i - parallelism + 1)
                begun.append(propose(space, tried[:ended], [*[s for s, _ in tried[ended:]], *begun], random.Random(f"{SEED}:{i}")))
            if begun:
                found = parts.errors([learner(s) for s in begun], parallelism)
                tried += [(s, sum(e**0.5 for e in errors) / folds) for s, errors in zip(begun, found, strict=True)]
    finally:
        parts.release()
    listed = [{"params": s, "score": e} for s, e in tried]
    return learner(min(listed, key=lambda t: t["score"])["params"]), _trial_table(df, listed, "rmse")


def recursive_elimination(
    df: DataFrame, keep: int = 15, target: str = TARGET, features: Sequence[str] | None = None
) -> tuple[list[str], DataFrame]:
    """Drop the feature of smallest absolute coefficient until ``keep`` are left; the rows are read twice, however many are dropped.

    Also gives rows (feature, rank), where rank 1 marks the features kept.
    """
    left, dropped = eliminate(products(df, list(features or feature_columns(df, target)), target), keep)
    ranks = [(f, 1) for f in left] + [(f, i + 2) for i, f in enumerate(dropped)]
    return left, df.sparkSession.createDataFrame(ranks, "feature string, rank int")


def leaderboard(
    train_rows: DataFrame, test_rows: DataFrame, learners: Mapping[str, Learner], target: str = TARGET
) -> tuple[Model, DataFrame]:
    """Train the candidates and rank them by rmse on the test rows; also the best model."""
    models = {name: train(train_rows, learner, target=target) for name, learner in learners.items()}
    found = evaluate(models, test_rows, target).orderBy("rmse")
    return models[found.first().model], found


def evaluate(models: Mapping[str, Model], test: DataFrame, target: str = TARGET) -> DataFrame:
    """Errors of several models on one test set, a row per model."""
    return evaluate_models(batch_predict(models, test.dropna("any"), (KEY, target)), list(models), target)


@dataclass(frozen=True)
class Ensemble:
    """Models of an ensemble with their errors, predictions and importances, and the trials of a search by model."""

    models: Mapping[str, Model]
    metrics: DataFrame
    predictions: DataFrame
    top_features: DataFrame
    trials: Mapping[str, DataFrame]


def train_ensemble(
    train_rows: DataFrame,
    test_rows: DataFrame,
    learners: Mapping[str, Learner],
    target: str = TARGET,
    search_grid: Mapping[str, Sequence] | None = None,
) -> Ensemble:
    """Train the learners, average their predictions, and judge all of them.

    Without a search, boosting stops early on the same test rows that it is judged on, so those errors are a little low.
    """
    models, trials = {}, {}
    for name, learner in learners.items():
        if search_grid is None:
            models[name] = train(train_rows, learner, test_rows, target)
        else:
            models[name], trials[name] = grid_search(train_rows, learner, search_grid, target=target)
    told = batch_predict(models, test_rows.dropna("any"), (KEY, target))
    judged = ensemble_mean(told, list(models))
    metrics = evaluate_models(judged, [*models, "ensemble"], target)
    return Ensemble(models, metrics, judged, mean_importances(models, top=10), trials)


def settings_table(spark: SparkSession, models: Mapping[str, Model]) -> DataFrame:
    """(model, parameter, value): what each model was trained with."""
    rows = []
    for name, model in models.items():
        if isinstance(model, HistogramModel):
            rows.append((name, "trees", str(len(model.trees))))
        elif isinstance(model, LinearModel):
            rows.append((name, "intercept", str(model.intercept)))
        elif isinstance(model, NeighbourModel):
            rows.append((name, "neighbours", str(model.k)))
        elif isinstance(model, SupportModel):
            rows.append((name, "cosines", str(len(model.coefficients) - 1)))
        elif isinstance(model, ReweightedTrees):
            rows.append((name, "trees", str(len(model.weights))))
        else:
            rows += [(name, p.name, str(v)) for p, v in model.stages[-1].extractParamMap().items()]
    return spark.createDataFrame(sorted(rows), "model string, parameter string, value string")


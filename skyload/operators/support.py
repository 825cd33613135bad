"""Regression with an error that is free within a tube, on random features of a Gaussian kernel.

Features and target are standardised; a row's distance to others enters through cosines of random projections. The objective is half
the squared length of the coefficients plus ``cost`` times the errors beyond the tube, whose corner is rounded over a small
stretch, so that Newton steps apply. A step is one aggregation of gradient and curvature, and one of the objective at several lengths of the step.
Equal rows are one with their number, and only rows in the rounded corner bend the objective.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyload.constants import KEY, TARGET
from skyload.operators.columns import counted_rows
from skyload.session import in_task, release, stable, to_tasks

# Cosines; the tube and the rounding of its corner, in deviations of the target; rows worked on at once.
COSINES, TUBE, ROUNDED, BLOCK = 256, 0.1, 0.05, 4096
# Steps at most; it ends before once a step lowers the objective by less than this share.
MOST_STEPS, SETTLED = 50, 1e-9
LENGTHS = 0.5 ** np.arange(12)


@dataclass(frozen=True)
class Projection:
    """Means and deviations of the features, and random directions and shifts of the cosines."""

    mean: np.ndarray
    deviation: np.ndarray
    directions: np.ndarray
    shifts: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        """A row's cosines, and a 1."""
        scaled = (x - self.mean) / self.deviation
        cosines = np.sqrt(2 / len(self.shifts)) * np.cos(scaled @ self.directions + self.shifts)
        return np.concatenate([cosines, np.ones((len(x), 1))], axis=1)


def project(mean: np.ndarray, deviation: np.ndarray, cosines: int, seed: int) -> Projection:
    """Directions of a kernel that falls to exp(-r² / d) at the distance r of d standardised features."""
    dice = np.random.default_rng(seed)
    wide = np.sqrt(2 / max(len(mean), 1))
    return Projection(mean, deviation, dice.normal(0, wide, (len(mean), cosines)), dice.uniform(0, 2 * np.pi, cosines))


def loss(left: np.ndarray, tube: float, rounded: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Errors beyond the tube, and their first and second derivatives."""
    beyond = np.maximum(np.abs(left) - tube, 0.0)
    bent = beyond < rounded
    value = np.where(bent, beyond**2 / (2 * rounded), beyond - rounded / 2)
    return value, np.sign(left) * np.minimum(beyond / rounded, 1.0), np.where(bent & (beyond > 0), 1 / rounded, 0.0)


@dataclass(frozen=True)
class SupportModel:
    """Features, their projection, the coefficients of the cosines and of 1, and mean and deviation of the target."""

    features: list[str]
    projection: Projection
    coefficients: np.ndarray
    mean: float
    deviation: float

    def predict(self, df: DataFrame, name: str = "prediction", carry: Sequence[str] = (KEY,)) -> DataFrame:
        """``carry`` and the prediction of each row, NULL where a feature is missing."""
        held = to_tasks(df.sparkSession, self)
        rows = df.select(*[F.col(f"`{c}`") for c in carry], *[F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(self.features)])
        schema = df.select(*[f"`{c}`" for c in carry]).schema.add(name, "double")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = in_task(held)
            for whole in batches:
                for start in range(0, whole.num_rows, BLOCK):
                    batch = whole.slice(start, BLOCK)
                    x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[len(carry) :]], axis=1)
                    told = model.projection.of(x) @ model.coefficients * model.deviation + model.mean
                    yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(told, mask=np.isnan(x).any(axis=1))], names=schema.names)

        return rows.mapInArrow(run, schema)

    def importances(self, name: str = "importance") -> DataFrame:
        """(feature, <name>): each feature's share of the squared directions, weighted by the squared coefficients."""
        parts = np.square(self.projection.directions) @ np.square(self.coefficients[:-1])
        shares = parts / parts.sum() if parts.sum() else parts
        return SparkSession.active().createDataFrame(list(zip(self.features, shares.tolist(), strict=True)), f"feature string, `{name}` double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write a row for each cosine and a table of the scales, target last, below ``path``."""
        p = self.projection
        shifts = [*p.shifts.tolist(), None]
        directions = [*p.directions.T.tolist(), None]
        cosines = list(zip(range(len(shifts)), self.coefficients.tolist(), shifts, directions, strict=True))
        spark.createDataFrame(cosines, "place int, coefficient double, shift double, direction array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/cosines")
        scales = list(zip(range(len(self.features) + 1), [*self.features, None], [*p.mean.tolist(), self.mean], [*p.deviation.tolist(), self.deviation], strict=True))
        spark.createDataFrame(scales, "place int, feature string, mean double, deviation double").coalesce(1).write.mode("overwrite").parquet(f"{path}/scales")

    @staticmethod
    def load(spark: SparkSession, path: str) -> SupportModel:
        *cosines, last = spark.read.parquet(f"{path}/cosines").orderBy("place").collect()
        *scales, target = spark.read.parquet(f"{path}/scales").orderBy("place").collect()
        number = lambda rows, c: np.array([r[c] for r in rows], float)
        projection = Projection(number(scales, "mean"), number(scales, "deviation"), number(cosines, "direction").T, number(cosines, "shift"))
        return SupportModel([r.feature for r in scales], projection, np.append(number(cosines, "coefficient"), last.coefficient), target["mean"], target.deviation)


def train_support(
    train: DataFrame, features: Sequence[str], target: str = TARGET, cost: float = 1.0, tube: float = TUBE, rounded: float = ROUNDED, cosines: int = COSINES, seed: int = 42
) -> tuple[SupportModel, list[float]]:
    """The model of the complete rows of ``train`` and the objective after each step, which never rises.

    Its corner being rounded lowers an error by at most ``rounded`` / 2 deviations of the target. A constant feature does not count; without
    complete rows the model is 0 everywhere.
    """
    features = list(features)
    columns = [F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate([*features, target])]
    rows = stable(counted_rows(train.select(*columns).dropna("any"), "_n"))
    names = rows.columns[:-1]
    found = rows.agg(F.sum("_n"), *[F.sum(F.col("_n") * F.col(c)) / F.sum("_n") for c in names], *[F.min(c) for c in names], *[F.max(c) for c in names]).first()
    if not found[0]:
        release(rows)
        zeros = np.zeros(len(features))
        return SupportModel(features, project(zeros, np.ones(len(features)), cosines, seed), np.zeros(cosines + 1), 0.0, 1.0), []
    mean, low, high = (np.array(found[1 + i * len(names) : 1 + (i + 1) * len(names)], float) for i in range(3))
    squares = rows.agg(*[F.sum(F.col("_n") * (F.col(c) - F.lit(m)) ** 2) for c, m in zip(names, mean.tolist(), strict=True)]).first()
    spread = np.sqrt(np.array(squares, float) / found[0])
    mean, spread = np.where(low == high, low, mean), np.where((low == high) | (spread == 0), 1.0, spread)
    model = SupportModel(features, project(mean[:-1], spread[:-1], cosines, seed), np.zeros(cosines + 1), float(mean[-1]), float(spread[-1]))
    penalised = np.append(np.ones(cosines), 0.0)
    first, second = np.triu_indices(cosines + 1)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                table = np.stack([c.to_numpy() for c in whole.slice(start, BLOCK).columns], axis=1)
                yield model.projection.of(table[:, :-2]), (table[:, -2] - model.mean) / model.deviation, table[:, -1]

    def curvature(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slope, bend = np.zeros(cosines + 1), np.zeros((cosines + 1, cosines + 1))
            for z, y, n in blocks(batches):
                _, one, two = loss(y - z @ at, tube, rounded)
                slope -= z.T @ (n * one)
                bent = two > 0
                bend += (z[bent] * (n * two)[bent, None]).T @ z[bent]
            cells = np.concatenate([bend[first, second], slope])
            place = np.concatenate([first, np.full(len(slope), -1)]), np.concatenate([second, np.arange(len(slope))])
            yield pa.RecordBatch.from_arrays([pa.array(place[0]), pa.array(place[1]), pa.array(cells)], names=["i", "j", "s"])

        sums = rows.mapInArrow(run, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()
        i, j, s = (sums.column(c).to_numpy() for c in ("i", "j", "s"))
        slope, bend = np.zeros(cosines + 1), np.zeros((cosines + 1, cosines + 1))
        slope[j[i < 0]] = s[i < 0]
        bend[i[i >= 0], j[i >= 0]] = bend[j[i >= 0], i[i >= 0]] = s[i >= 0]
        return cost * slope + penalised * at, cost * bend + np.diag(penalised)

    def objectives(points: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(len(points))
            for z, y, n in blocks(batches):
                sums += n @ loss(y[:, None] - z @ points.T, tube, rounded)[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(points))), pa.array(sums)], names=["i", "s"])

        found = dict(rows.mapInArrow(run, "i bigint, s double").groupBy("i").agg(F.sum("s")).collect())
        return np.array([cost * found[i] for i in range(len(points))]) + 0.5 * np.square(points) @ penalised

    at, course = model.coefficients, [float(objectives(model.coefficients[None])[0])]
    while len(course) <= MOST_STEPS:
        slope, bend = curvature(at)
        # No row may be in the bend of the constant; then a unit keeps the step defined.
        bend[-1, -1] += bend[-1, -1] <= 0
        step = np.linalg.solve(bend, slope)
        tried = at - LENGTHS[:, None] * step
        values = objectives(tried)
        best = int(np.argmin(values))
        gained = course[-1] - float(values[best])
        if gained <= 0:
            break
        at = tried[best]
        course.append(float(values[best]))
        if gained <= SETTLED * course[0]:
            break
    release(rows)
    return SupportModel(features, model.projection, at, model.mean, model.deviation), course

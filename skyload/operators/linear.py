"""Linear models from one table of products of columns.

Rows are read twice, whatever the number of features and models: for the means, and for sums of products of columns without their
means. The table of products has a cell for each pair of columns; least squares, elimination of features and lasso need nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyload.constants import KEY, TARGET

# A feature of which the others leave less than this share of its variance is a combination of them.
REDUNDANT = 1e-9
# Lasso ends once a round changes no coefficient by more than this share of the target's deviation.
SETTLED, MOST_ROUNDS = 1e-10, 100_000


@dataclass(frozen=True)
class Products:
    """Sums of products of features and target (the last column), without their means, over ``n`` complete rows; a constant column has zeros."""

    features: list[str]
    n: int
    means: np.ndarray
    sums: np.ndarray

    def of(self, features: Sequence[str]) -> Products:
        """The same for some of the features."""
        at = [*[self.features.index(f) for f in features], len(self.features)]
        return Products(list(features), self.n, self.means[at], self.sums[np.ix_(at, at)])


@dataclass(frozen=True)
class LinearModel:
    """A coefficient for each feature, and an intercept."""

    features: list[str]
    coefficients: list[float]
    intercept: float

    def predict(self, df: DataFrame, name: str = "prediction", carry: Sequence[str] = (KEY,)) -> DataFrame:
        """``carry`` and the prediction of each row, NULL where a feature is missing."""
        terms = [F.col(f"`{f}`").cast("double") * F.lit(c) for f, c in zip(self.features, self.coefficients, strict=True)]
        return df.select(*[f"`{c}`" for c in carry], reduce(Column.__add__, terms, F.lit(self.intercept)).alias(name))

    def importances(self, name: str = "importance") -> DataFrame:
        """(feature, <name>): absolute coefficients."""
        rows = [(f, abs(c)) for f, c in zip(self.features, self.coefficients, strict=True)]
        return SparkSession.active().createDataFrame(rows, f"feature string, `{name}` double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write a row for each feature and one without a feature, the intercept, below ``path``."""
        rows = [*[(i, f, c) for i, (f, c) in enumerate(zip(self.features, self.coefficients, strict=True))], (-1, None, self.intercept)]
        table = spark.createDataFrame(rows, "place int, feature string, coefficient double")
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearModel:
        first, *rows = spark.read.parquet(f"{path}/coefficients").orderBy("place").collect()
        return LinearModel([r.feature for r in rows], [r.coefficient for r in rows], first.coefficient)


def products(df: DataFrame, features: Sequence[str], target: str = TARGET) -> Products:
    """Sums of products over the complete rows. The driver gets one number for each pair of columns; without rows all are 0."""
    names = [*features, target]
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_{i}") for i, c in enumerate(names)]).dropna("any")
    own = range(len(names))
    found = rows.agg(
        F.count(F.lit(1)), *[F.avg(f"_{i}") for i in own], *[F.min(f"_{i}") for i in own], *[F.max(f"_{i}") for i in own]
    ).first()
    n, means, low, high = found[0], *[found[1 + len(names) * k : 1 + len(names) * (k + 1)] for k in range(3)]
    if not n:
        return Products(list(features), 0, np.zeros(len(names)), np.zeros((len(names), len(names))))
    # The mean of a constant column may differ from its value in the last place.
    centre = np.array([low[i] if low[i] == high[i] else means[i] for i in own])
    first, second = np.triu_indices(len(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centre), len(centre)))
        for batch in batches:
            if batch.num_rows:
                block = np.stack([c.to_numpy() for c in batch.columns], axis=1) - centre
                sums += block.T @ block
        yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), pa.array(sums[first, second])], names=["i", "j", "s"])

    cells = rows.mapInArrow(run, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    sums = np.zeros((len(names), len(names)))
    for r in cells:
        sums[r.i, r.j] = sums[r.j, r.i] = r.s
    return Products(list(features), n, centre, sums)


def sweep(table: np.ndarray, k: int, sign: int = 1) -> np.ndarray:
    """The symmetric table with column ``k`` among the features of the fit, or out of it again with ``sign`` -1."""
    pivot = table[k, k]
    out = table - np.outer(table[:, k], table[k]) / pivot
    out[k], out[:, k] = sign * table[k] / pivot, sign * table[:, k] / pivot
    out[k, k] = -1 / pivot
    return out


class _Fit:
    """Least squares on a set of features that grows and shrinks by one; a combination of others has the coefficient 0 and waits."""

    def __init__(self, of: Products) -> None:
        self.scale = np.sqrt(np.diag(of.sums))
        self.scale[self.scale == 0] = 1.0
        self.table = of.sums / np.outer(self.scale, self.scale)
        self.inside: set[int] = set()

    def add(self, features: Sequence[int]) -> None:
        for k in features:
            if k not in self.inside and self.table[k, k] > REDUNDANT:
                self.table = sweep(self.table, k)
                self.inside.add(k)

    def remove(self, k: int) -> None:
        if k in self.inside:
            self.table = sweep(self.table, k, -1)
            self.inside.remove(k)

    def coefficient(self, k: int) -> float:
        return float(self.table[k, -1] * self.scale[-1] / self.scale[k]) if k in self.inside else 0.0


def _model(of: Products, coefficients: list[float]) -> LinearModel:
    return LinearModel(of.features, coefficients, float(of.means[-1] - np.dot(of.means[:-1], coefficients)))


def least_squares(of: Products) -> LinearModel:
    """Ordinary least squares with an intercept; a feature that is constant or a combination of earlier ones has the coefficient 0."""
    fit = _Fit(of)
    fit.add(range(len(of.features)))
    return _model(of, [fit.coefficient(k) for k in range(len(of.features))])


def lasso(of: Products, penalty: float = 1.0) -> LinearModel:
    """Half the mean squared error plus ``penalty`` times the absolute coefficients, by coordinate descent on the products; features keep their units."""
    count = len(of.features)
    table, toward = of.sums[:-1, :-1] / max(of.n, 1), of.sums[:-1, -1] / max(of.n, 1)
    own, deviation = np.diag(table), np.sqrt(of.sums[-1, -1] / max(of.n, 1))
    coefficients, fitted = np.zeros(count), np.zeros(count)
    for _ in range(MOST_ROUNDS):
        largest = 0.0
        for k in np.flatnonzero(own > 0):
            pull = toward[k] - fitted[k] + own[k] * coefficients[k]
            new = np.sign(pull) * max(abs(pull) - penalty, 0.0) / own[k]
            if step := new - coefficients[k]:
                fitted += table[k] * step
                coefficients[k] = new
                largest = max(largest, abs(step) * np.sqrt(own[k]))
        if largest <= SETTLED * deviation:
            break
    return _model(of, coefficients.tolist())


def eliminate(of: Products, keep: int) -> tuple[list[str], list[str]]:
    """Drop the feature of smallest absolute coefficient, the first of equal ones, until ``keep`` are left: those left, and those dropped, the last one first."""
    fit = _Fit(of)
    left, dropped = list(range(len(of.features))), []
    fit.add(left)
    while len(left) > keep:
        k = min(left, key=lambda c: abs(fit.coefficient(c)))
        left.remove(k)
        dropped.insert(0, k)
        fit.remove(k)
        fit.add(left)
    return [of.features[k] for k in left], [of.features[k] for k in dropped]

"""Categories as statistics of the target, from earlier rows only.

Rows stand in the order of a hash of their keys. A training row's category becomes the mean target of the rows of that category before
it, drawn towards a prior, so no row sees its own target. Rows to be scored get the mean of all training rows of their category.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyload.constants import KEY, LABEL_COLUMNS, TARGET
from skyload.operators.prepare import split_hash
from skyload.session import broadcast_if_small, release, stable

# Stretches of the order hold about so many rows of a category at most, and a task sorts one of them.
STRETCH_ROWS = 1_000_000
# Digits of the hash, of 16 values each, that stretches have in common at least.
LEAST_DIGITS = 2
SUFFIX, SEED = "_statistic", "order"
# Sums are exact, so they do not depend on how rows are partitioned.
EXACT = "decimal(28,6)"


@dataclass(frozen=True)
class TargetStatistics:
    """``sums`` has (column, value, n, total) of the training rows, ``value`` NULL for NULL; ``prior`` counts as ``weight`` rows."""

    sums: DataFrame
    prior: float
    weight: float

    def save(self, folder: str) -> None:
        """Write sums and prior below ``folder``."""
        self.sums.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/target_sums")
        prior = self.sums.sparkSession.createDataFrame([(self.prior, self.weight)], "prior double, weight double")
        prior.coalesce(1).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/target_prior")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> TargetStatistics:
        prior = spark.read.parquet(f"{folder.rstrip('/')}/target_prior").first()
        return TargetStatistics(spark.read.parquet(f"{folder.rstrip('/')}/target_sums"), prior.prior, prior.weight)


def _category(column: str) -> Column:
    """The value as text that is never NULL: NULL and empty text differ."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{column}`").cast("string")), F.lit(""))


def _mean(total: Column, n: Column, prior: float, weight: float) -> Column:
    return (F.coalesce(total.cast("double"), F.lit(0.0)) + F.lit(prior * weight)) / (F.coalesce(n, F.lit(0)) + F.lit(weight))


def fit_statistics(train: DataFrame, columns: Sequence[str] = LABEL_COLUMNS, target: str = TARGET, weight: float = 1.0) -> TargetStatistics:
    """Rows and sums of the target by category, and its mean as the prior; rows without a target do not count. Without any the prior is 0."""
    if weight <= 0:
        raise ValueError("the prior needs a weight above 0")
    known = train.where(F.col(f"`{target}`").isNotNull())
    both = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])).alias("x")
    exact = F.col(f"`{target}`").cast(EXACT)
    sums = stable(known.select(exact.alias("y"), both).groupBy("x.column", "x.value").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("total")))
    # Each row has one value of the first column, NULL included.
    whole = sums.where(F.col("column") == F.lit(columns[0])).agg(F.sum("total").cast("double"), F.sum("n")).first()
    return TargetStatistics(sums, whole[0] / whole[1] if whole[1] else 0.0, weight)


def ordered_statistics(
    train: DataFrame, fitted: TargetStatistics, columns: Sequence[str] = LABEL_COLUMNS, target: str = TARGET, stretch_rows: int = STRETCH_ROWS
) -> DataFrame:
    """Training rows with ``<column>_statistic``: the mean target of earlier rows of the category, with the prior; written.

    Many rows are cut into stretches of the order, by the first digits of the hash: each category is summed up in each, the sums of those before a
    stretch are carried into it, and only its own rows are sorted in one task. Rows are dealt out by stretch once, for all columns. The result
    is the same for any ``stretch_rows``. NULL is a category. Rows of equal keys stand by their targets; rows equal in both have each other's places. A row without a target has a statistic and adds nothing.
    """
    exact = F.col(f"`{target}`").cast(EXACT)
    stored = rows = stable(train.withColumns({"_hash": split_hash(seed=SEED), "_y": exact}))
    digits = max(0, math.ceil(math.log(max(rows.count(), 1) / stretch_rows, 16)))
    if digits:
        # Stretches alone keep all tasks busy.
        digits = max(digits, LEAST_DIGITS)
        rows = rows.withColumn("_stretch", F.substring("_hash", 1, digits)).repartition("_stretch")
    by = ["_stretch", "_category"] if digits else ["_category"]
    for column in columns:
        placed = rows.withColumn("_category", _category(column))
        line = W.partitionBy(*by).orderBy("_hash", KEY, "_y").rowsBetween(W.unboundedPreceding, -1)
        total, n = F.coalesce(F.sum("_y").over(line), F.lit(0)), F.count("_y").over(line)
        if digits:
            # A row for each stretch of each category: of every category at most 16 to the power of ``digits``.
            stretches = stored.withColumns({"_category": _category(column), "_stretch": F.substring("_hash", 1, digits)}).groupBy(*by).agg(F.sum("_y").alias("_t"), F.count("_y").alias("_n"))
            earlier = W.partitionBy("_category").orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
            carried = stretches.select(
                "_category", "_stretch", F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_total"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_count")
            )
            placed = placed.join(broadcast_if_small(carried), by)
            total, n = total + F.col("_total"), n + F.col("_count")
        rows = placed.withColumn(f"{column}{SUFFIX}", _mean(total, n, fitted.prior, fitted.weight)).drop("_category", "_total", "_count")
    found = stable(rows.select(*[f"`{c}`" for c in train.columns], *[f"{c}{SUFFIX}" for c in columns]))
    release(stored)
    return found


def apply_statistics(df: DataFrame, fitted: TargetStatistics, columns: Sequence[str] = LABEL_COLUMNS) -> DataFrame:
    """Rows with ``<column>_statistic`` of all training rows of their category; the prior for a category that training did not have."""

    def add(rows: DataFrame, column: str) -> DataFrame:
        table = fitted.sums.where(F.col("column") == F.lit(column)).select(_category("value").alias("_category"), F.col("n").alias("_n"), F.col("total").alias("_t"))
        joined = rows.withColumn("_category", _category(column)).join(broadcast_if_small(table), "_category", "left")
        return joined.withColumn(f"{column}{SUFFIX}", _mean(F.col("_t"), F.col("_n"), fitted.prior, fitted.weight)).drop("_category", "_n", "_t")

    return reduce(add, columns, df).select(*[f"`{c}`" for c in df.columns], *[f"{c}{SUFFIX}" for c in columns])

"""Row numbers, long groups and exact quantiles without putting a group in one task.

A window partition, and the final state of an exact ``percentile``, are held by one
task. That is right for the usual flight. For whole tables, and for a flight
that holds a large share of all points, rows are range-partitioned on their order
instead: Spark samples the order, each task sorts an equal range, and only one count
per range has to be added up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyload.session import stable

# Distinct values that one task may hold for an exact percentile. The result has the same bits beyond.
PERCENTILE_VALUES = 1_000_000
# Rows of a range or a group of work, about; tables get as many partitions as that takes.
PARTITION_ROWS = 1_000_000


def shuffle_partitions(df: DataFrame, rows: int = 0) -> int:
    """The session's number of partitions, more if ``rows`` rows call for it."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_ROWS))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same names, in which NULL equals NULL; the left side's are kept."""
    if not keys:
        return left.crossJoin(right)
    named = right.select(*[F.col(f"`{k}`").alias(f"_on_{k}") for k in keys], *[f"`{c}`" for c in right.columns if c not in keys])
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_on_{k}`")) for k in keys]
    return left.join(named, same, how).drop(*[f"_on_{k}" for k in keys])


def _running(keys: Sequence[str]):
    """Ranges before the present one, by key. One row per key and range, so few."""
    return (
        Window.partitionBy(*keys)
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def with_row_index(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    index: str = "row_no",
    total: str = "n_points",
) -> DataFrame:
    """Add the 0-based place of each row in its key's order, and the key's row count.

    ``order`` should be total. One count per key and range is joined back.
    """
    by = [*keys, *order]
    ranged = (
        df.repartitionByRange(shuffle_partitions(df, df.select(*keys).count()), *by)
        .sortWithinPartitions(*by)
        .withColumns({"_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
    )
    ranged = stable(ranged)
    spans = ranged.groupBy(*keys, "_range").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    spans = spans.select(
        *keys,
        "_range",
        "_first",
        F.coalesce(F.sum("_rows").over(_running(keys)), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(*keys)).alias(total),
    )
    return (
        join_on(ranged, spans, [*keys, "_range"])
        .withColumn(index, F.col("_before") + F.col("_place") - F.col("_first"))
        .select(*df.columns, index, total)
    )


def long_groups(df: DataFrame, key: str, rows: int) -> DataFrame | None:
    """Keys with more than ``rows`` rows as a table, or None when there are none.

    Reads the key column only and counts before the shuffle.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    found = counted.where(F.col("_rows") > rows).select(key)
    # Mostly there are none, and nothing is written.
    return None if found.isEmpty() else stable(found)


def split_by_length(
    df: DataFrame, key: str, rows: int, long_keys: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups that fit one task, and rows of the longer ones (or None); NULL is a key.

    Keys found before may be handed in. They are a stored table, so Spark broadcasts them if their size allows it.
    """
    if long_keys is None:
        long_keys = long_groups(df, key, rows)
    if long_keys is None:
        return df, None
    return join_on(df, long_keys, [key], "left_anti"), join_on(df, long_keys, [key], "left_semi")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    keys: Sequence[str] = (),
    values_in_task: int = PERCENTILE_VALUES,
) -> DataFrame:
    """Linearly interpolated quantiles of a column, one row per key.

    ``probabilities`` maps result column to probability. NULL values do not count. Equal values
    are counted first, in one pass over ``df``. Up to ``values_in_task`` distinct ones go to the built-in aggregate with
    their counts; more are range-partitioned, and only the ranges that hold a wanted rank are looked
    into. Both give the same bits.
    """
    present = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    by = [*keys, "_v"]
    counts = stable(present.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows")))
    distinct = counts.count()
    if distinct <= values_in_task:
        found = {name: F.percentile("_v", F.lit(p), F.col("_rows")) for name, p in probabilities.items()}
        return counts.groupBy(*keys).agg(*[c.alias(n) for n, c in found.items()])

    ranged = stable(
        counts.repartitionByRange(shuffle_partitions(df, distinct), *by).withColumn("_range", F.spark_partition_id())
    )
    spans = ranged.groupBy(*keys, "_range").agg(F.sum("_rows").alias("_in"))
    spans = spans.withColumns(
        {
            "_before": F.coalesce(F.sum("_in").over(_running(keys)), F.lit(0)),
            "_total": F.sum("_in").over(Window.partitionBy(*keys)),
        }
    )
    wanted = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(float(p)).alias("p")) for n, p in probabilities.items()]
    )
    spans = spans.withColumn("_wanted", F.explode(wanted)).select(
        *keys, "_range", "_before", "_in",
        F.col("_wanted.name").alias("_name"),
        (F.col("_wanted.p") * (F.col("_total") - 1)).alias("_rank"),
    )

    def holds(rank):
        return (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_in"))

    spans = spans.where(holds(F.floor("_rank")) | holds(F.ceil("_rank")))
    in_range = Window.partitionBy(*keys, "_range", "_name").orderBy("_v")
    upto = F.col("_before") + F.sum("_rows").over(in_range)
    looked = join_on(ranged, spans, [*keys, "_range"]).withColumn("_upto", upto)
    low = F.when(F.col("_upto") > F.floor("_rank"), F.col("_v"))
    high = F.when(F.col("_upto") > F.ceil("_rank"), F.col("_v"))
    ends = looked.groupBy(*keys, "_name", "_rank").agg(
        F.min(low).alias("_low"), F.min(high).alias("_high")
    )
    between = (F.ceil("_rank") - F.col("_rank")) * F.col("_low") + (F.col("_rank") - F.floor("_rank")) * F.col("_high")
    placed = ends.withColumn("_q", F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(between))
    return placed.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == n, F.col("_q"))).alias(n) for n in probabilities]
    )

"""Standardising, encoding and splitting into train and test rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyload.constants import KEY, LABEL_COLUMNS, NOT_NORMALISED, ONE_HOT_COLUMN
from skyload.operators.columns import numeric_columns
from skyload.operators.ordering import with_row_index
from skyload.session import SMALL_ROWS, small_table

# A test row has the first four hex digits of its key's md5 below this: about 20 %.
TEST_BELOW = "3333"
TEST_SHARE = 0.2


def spread(value: Column, ddof: int = 0) -> Column:
    """Standard deviation as an aggregate; exactly 0 when all values are equal.

    Sums merged from several tasks would leave a rest of about 1e-16 there.
    """
    deviation = F.stddev_samp(value) if ddof else F.stddev_pop(value)
    return F.when(F.min(value) == F.max(value), F.lit(0.0)).otherwise(deviation)


def moment_columns(columns: Sequence[str], ddof: int = 0) -> list[Column]:
    """Aggregates ``n_rows``, ``<c>_mean`` and ``<c>_std`` (``ddof=1``: sample deviation)."""
    return [
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(c).alias(f"{c}_mean") for c in columns],
        *[spread(F.col(f"`{c}`"), ddof).alias(f"{c}_std") for c in columns],
    ]


def moments(
    df: DataFrame, columns: Sequence[str], ddof: int = 0, by: Sequence[str] = ()
) -> DataFrame:
    """Row count, means and deviations: one row, or one per group."""
    return df.groupBy(*by).agg(*moment_columns(columns, ddof))


def standard_score(value: Column, mean: Column, deviation: Column) -> Column:
    """(x - mean) / std, and 0 for every value of a column without spread."""
    spread = F.when(deviation > 0, (value.cast("double") - mean) / deviation)
    return F.when(value.isNotNull(), F.coalesce(spread, F.lit(0.0)))


def normalise(
    df: DataFrame,
    exclude: Iterable[str] = NOT_NORMALISED,
    keep_distance: bool = False,
    ddof: int = 0,
    only_double: bool = False,
) -> DataFrame:
    """Standardise the numeric columns that are not excluded.

    The moments are one row, computed first; what follows is a projection.
    ``keep_distance`` leaves ``flown_distance`` as it is, for a later split by it.
    """
    left_out = [*exclude, *(["flown_distance"] if keep_distance else [])]
    columns = numeric_columns(df, left_out, only_double)
    if not columns:
        return df
    found = moments(df, columns, ddof).first()

    def score(c: str) -> Column:
        mean, deviation = found[f"{c}_mean"], found[f"{c}_std"]
        return standard_score(
            F.col(f"`{c}`"), F.lit(mean).cast("double"), F.lit(deviation).cast("double")
        )

    return df.withColumns({c: score(c) for c in columns})


def levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several columns as (column, value) rows, in one pass."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.explode(pairs).alias("level"))
        .select("level.column", "level.value")
        .where(F.col("value").isNotNull())
        .distinct()
    )


def label_codes(df: DataFrame, columns: Sequence[str], rows: int = SMALL_ROWS) -> dict[str, DataFrame]:
    """For each column a table (value, code): codes from 0 in binary order of the values.

    Up to ``rows`` distinct values in all are sorted on the driver and broadcast. More
    are numbered by range partitions and joined on the value.
    """
    found = levels(df, columns)
    listed = found.limit(rows + 1).collect()
    spark = df.sparkSession
    if len(listed) > rows:
        numbered = with_row_index(found, ["value"], ["column"], "code", "_total")
        return {
            c: numbered.where(F.col("column") == c).select("value", F.col("code").cast("int"))
            for c in columns
        }
    codes = {}
    for c in columns:
        values = sorted((r.value for r in listed if r.column == c), key=str.encode)
        table = small_table(spark, {"value": values or [""], "code": list(range(len(values) or 1))})
        codes[c] = F.broadcast(table.select("value", F.col("code").cast("int")))
    return codes


def label_encode(
    df: DataFrame,
    columns: Sequence[str] = LABEL_COLUMNS,
    preserve: Iterable[str] = (),
    rows: int = SMALL_ROWS,
) -> DataFrame:
    """Replace each column by ``<c>_encoded``; preserved columns stay beside it."""
    kept = set(preserve)
    for c, table in label_codes(df, columns, rows).items():
        coded = table.select(F.col("value").alias("_value"), F.col("code").alias(f"{c}_encoded"))
        df = df.join(coded, F.col(c) == F.col("_value"), "left").drop("_value")
        if c not in kept:
            df = df.drop(c)
    return df


def one_hot(
    df: DataFrame,
    column: str = ONE_HOT_COLUMN,
    always: Sequence[str] = ("M", "H"),
    drop_first: bool = False,
    most: int | None = None,
) -> DataFrame:
    """A 0/1 column ``<column>_<value>`` per value; ``always`` are there without rows too.

    ``drop_first`` leaves out the smallest value found. With ``most``, more values than that are an error;
    every value makes a column, so a column of very many suits :func:`one_hot_vector` better.
    """
    found = [r.value for r in levels(df, [column]).collect()]
    if most is not None and len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    values = sorted(found) if drop_first else sorted({*found, *always})
    if drop_first:
        values = values[1:]
    flags = {
        f"{column}_{v}": F.when(F.col(column) == F.lit(v), F.lit(1)).otherwise(F.lit(0))
        for v in values
    }
    return df.withColumns(flags).drop(column)


def one_hot_vector(df: DataFrame, column: str = ONE_HOT_COLUMN) -> DataFrame:
    """``<column>_index`` by order of the values, and ``<column>_encoded`` as a 0/1 vector."""
    index, vector = f"{column}_index", f"{column}_encoded"
    indexer = StringIndexer(
        inputCol=column, outputCol=index, stringOrderType="alphabetAsc", handleInvalid="keep"
    )
    encoder = OneHotEncoder(inputCol=index, outputCol=vector, dropLast=True)
    return Pipeline(stages=[indexer, encoder]).fit(df).transform(df)


def split_hash(key: str = KEY, seed: str = "") -> Column:
    """Hash of the key; does not depend on where or when the row is read."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))


def is_test_row(key: str = KEY, seed: str = "") -> Column:
    """About 20 % of the rows, the same ones in every run and partitioning."""
    return F.substring(split_hash(key, seed), 1, 4) < F.lit(TEST_BELOW)


def train_test_split(
    df: DataFrame, key: str = KEY, seed: str = "", exact: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by hash of the key; ``exact`` gives 20 % to the row."""
    if not exact:
        test = is_test_row(key, seed)
        return df.where(~test), df.where(test)
    ordered = with_row_index(df.withColumn("_hash", split_hash(key, seed)), ["_hash", key])
    test = F.col("row_no") < F.ceil(F.col("n_points") * F.lit(TEST_SHARE))
    return tuple(
        ordered.where(part).drop("_hash", "row_no", "n_points") for part in (~test, test)
    )

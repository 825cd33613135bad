"""A preparation that is fitted on training rows, stored, and applied to any others.

Scoring rows must get the scales, codes and flags of the rows that a model learned from, not their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyload.constants import LABEL_COLUMNS, NOT_NORMALISED, ONE_HOT_COLUMN
from skyload.operators.columns import numeric_columns
from skyload.operators.prepare import label_codes, levels, moments, standard_score
from skyload.session import SMALL_ROWS, broadcast_if_small, stable

# Code of a value that no training row had.
UNSEEN = -1
# Values of a column that each get a flag, at most.
MOST_FLAGS = 1000


@dataclass(frozen=True)
class Preparation:
    """Tables that training rows were fitted to.

    ``scales`` has (place, column, mean, deviation), ``codes`` (column, value, code) and ``flags`` (column, value).
    """

    scales: DataFrame
    codes: DataFrame
    flags: DataFrame

    def save(self, folder: str) -> None:
        """Write the tables below ``folder``, which may hold the models as well."""
        for name in ("scales", "codes", "flags"):
            getattr(self, name).write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> Preparation:
        return Preparation(*[spark.read.parquet(f"{folder.rstrip('/')}/{name}") for name in ("scales", "codes", "flags")])


def fit_preparation(
    train: DataFrame,
    exclude: Iterable[str] = NOT_NORMALISED,
    labels: Sequence[str] = LABEL_COLUMNS,
    one_hot: str | None = ONE_HOT_COLUMN,
    drop_first: bool = False,
    ddof: int = 0,
    rows: int = SMALL_ROWS,
) -> Preparation:
    """Scales of the numeric columns, codes of ``labels`` from 0 in binary order, and values of ``one_hot`` that get a flag.

    Columns that ``train`` does not have are passed over. ``drop_first`` leaves the smallest value without a flag; more than
    ``MOST_FLAGS`` values are an error, as each makes a column. Without rows there are scales of NULL, no codes and no flags.
    """
    spark = train.sparkSession
    columns = numeric_columns(train, exclude)
    labels = [c for c in labels if c in train.columns]
    found = moments(train, columns, ddof).first()
    number = lambda v: None if v is None else float(v)
    scales = [(i, c, number(found[f"{c}_mean"]), number(found[f"{c}_std"])) for i, c in enumerate(columns)]
    schema = "place bigint, column string, mean double, deviation double"
    coded = []
    if labels:
        # A column without values is a single empty one there; NULL and such values get no code.
        present = stable(levels(train, labels))
        tables = label_codes(train, labels, rows)
        coded = [t.select(F.lit(c).alias("column"), "value", "code").join(present.where(F.col("column") == c).select("value"), "value", "left_semi") for c, t in tables.items()]
    empty = spark.createDataFrame([], "column string, value string, code int")
    codes = reduce(DataFrame.unionByName, [t.select("column", "value", "code") for t in coded], empty)
    values: list[str] = []
    if one_hot is not None and one_hot in train.columns:
        values = sorted(r.value for r in levels(train, [one_hot]).limit(MOST_FLAGS + 1).collect())
        if len(values) > MOST_FLAGS:
            raise ValueError(f"{one_hot} has more than {MOST_FLAGS} values")
    flags = spark.createDataFrame([(one_hot, v) for v in (values[1:] if drop_first else values)], "column string, value string")
    if one_hot is not None and not values:
        flags = flags.union(spark.createDataFrame([(one_hot, None)], "column string, value string"))
    return Preparation(spark.createDataFrame(scales, schema), stable(codes), flags)


def apply_preparation(df: DataFrame, prepared: Preparation, preserve: Iterable[str] = ()) -> DataFrame:
    """Rows with the scales, codes and flags of the training rows.

    A value that training did not have is coded ``UNSEEN`` and has no flag; NULL stays NULL. Label columns not in ``preserve`` and
    the flagged column drop out. A scaled column that ``df`` lacks is an error, as a model needs it.
    """
    scales = prepared.scales.orderBy("place").collect()  # a row for each column
    missing = [s.column for s in scales if s.column not in df.columns]
    if missing:
        raise ValueError(f"no columns {', '.join(missing)}")
    out = df.withColumns({s.column: standard_score(F.col(f"`{s.column}`"), F.lit(s["mean"]).cast("double"), F.lit(s.deviation).cast("double")) for s in scales})
    kept = set(preserve)
    for (name,) in sorted(prepared.codes.select("column").distinct().collect()):
        table = prepared.codes.where(F.col("column") == name).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        text = F.col(f"`{name}`").cast("string")
        code = F.when(F.col(f"`{name}`").isNotNull(), F.coalesce("_code", F.lit(UNSEEN)))
        out = out.join(broadcast_if_small(table), text == F.col("_value"), "left").withColumn(f"{name}_encoded", code).drop("_value", "_code")
        if name not in kept:
            out = out.drop(name)
    flagged = prepared.flags.collect()  # at most MOST_FLAGS
    flags = {f"{f.column}_{f.value}": F.when(F.col(f.column) == F.lit(f.value), F.lit(1)).otherwise(F.lit(0)) for f in flagged if f.value is not None}
    return out.withColumns(flags).drop(*{f.column for f in flagged})

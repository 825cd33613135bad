"""Choosing, dropping and filtering."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, NumericType

from skyload.constants import ALTITUDE_MAX, ALTITUDE_MIN, DROPPED_FEATURES, KEY, TARGET


def numeric_columns(
    df: DataFrame, exclude: Iterable[str] = (), only_double: bool = False
) -> list[str]:
    """Names of the numeric columns, in order, without the excluded ones."""
    kind = DoubleType if only_double else NumericType
    left_out = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, kind) and f.name not in left_out]


def numeric_only(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    return df.select(*numeric_columns(df, exclude))


def drop_features(df: DataFrame, final_drop: bool = False, drop_key: bool = False) -> DataFrame:
    """Drop columns that are no features; absent ones are passed over.

    ``final_drop`` drops the aircraft type as well, ``drop_key`` the flight id.
    """
    extra = [*(["aircraft_type"] if final_drop else []), *([KEY] if drop_key else [])]
    return df.drop(*DROPPED_FEATURES, *extra)


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without any NULL."""
    return df.dropna("any")


def valid_altitudes(points: DataFrame) -> DataFrame:
    """Complete points with an altitude in the range of the atmosphere model."""
    return complete_rows(points.where(F.col("altitude").between(ALTITUDE_MIN, ALTITUDE_MAX)))


def features_and_target(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    """All but the target, and the target; both with the key to join them again."""
    return df.drop(target), df.select(KEY, target)


def scoring_set(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Flights to predict: the target is dropped where there is one."""
    return df.drop(target)


def counted_rows(df: DataFrame, name: str) -> DataFrame:
    """Equal rows once, with their number as a double; what only adds up over rows costs as much as there are different ones."""
    return df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).cast("double").alias(name))

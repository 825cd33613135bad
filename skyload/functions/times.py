"""Timestamps and durations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyload.constants import DATE_COLUMNS


def as_timestamp(value: Column) -> Column:
    """Parse to a timestamp; text that is no timestamp gives NULL, not an error."""
    return value.try_cast("timestamp")


def format_dates(df: DataFrame, columns: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Date columns that are present, as ``yyyy-MM-dd HH:mm:ss`` text."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns(
        {c: F.date_format(as_timestamp(F.col(c)), "yyyy-MM-dd HH:mm:ss") for c in present}
    )


def add_duration(
    df: DataFrame,
    start: str = "actual_offblock_time",
    end: str = "arrival_time",
    exact: bool = False,
) -> DataFrame:
    """Minutes from ``start`` to ``end`` in a ``duration`` column.

    By default whole seconds, rounded to two places, and NULL when negative.
    With ``exact`` fractions of a second and negative values are kept.
    """
    begin, finish = as_timestamp(F.col(start)), as_timestamp(F.col(end))
    if exact:
        minutes = (F.unix_micros(finish) - F.unix_micros(begin)) / F.lit(60e6)
    else:
        rounded = F.round((F.unix_timestamp(finish) - F.unix_timestamp(begin)) / F.lit(60.0), 2)
        minutes = F.when(rounded >= 0, rounded)
    return df.withColumn("duration", minutes)

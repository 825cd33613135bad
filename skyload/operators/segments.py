"""Splitting flights into segments that get models of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyload.constants import KEY, MTOW_SEGMENTS, TARGET
from skyload.functions.bins import distance_bin, is_narrow_body, wide_body_label
from skyload.operators.ordering import exact_quantiles, with_row_index
from skyload.operators.prepare import moments, standard_score

SEGMENT = "segment"
_QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def mtow_quartiles(df: DataFrame, mtow: str = "mtow_kg") -> dict[str, float]:
    """Inner quartile edges of narrow-body weight."""
    narrow = df.where(is_narrow_body(F.col(mtow)))
    return exact_quantiles(narrow, mtow, _QUARTILES).first().asDict()


def label_by_mtow(df: DataFrame, mtow: str = "mtow_kg", method: str = "quantile") -> DataFrame:
    """``segment`` by weight: narrow bodies by quartile, wide bodies by type.

    ``quantile`` keeps equal weights together. ``ntile`` cuts four parts of equal
    size and so through ties, which are ordered by flight id. Unknown weight gives NULL.
    """
    names = MTOW_SEGMENTS[:4]
    weight, narrow = F.col(mtow), is_narrow_body(F.col(mtow))
    if method == "ntile":
        part = narrow_body_ntile(df.select(KEY, mtow), mtow).select(KEY, "ntile")
        df = df.join(part, KEY, "left")
        quarter = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("ntile"))
        label = F.when(narrow, quarter).when(~narrow, wide_body_label(F.col("aircraft_type")))
        return df.withColumn(SEGMENT, label).drop("ntile")
    edges = mtow_quartiles(df, mtow)
    quarter = F.lit(names[3])
    for edge, name in reversed(list(zip(edges.values(), names, strict=False))):
        quarter = F.when(weight <= F.lit(edge), F.lit(name)).otherwise(quarter)
    label = F.when(narrow, quarter).when(~narrow, wide_body_label(F.col("aircraft_type")))
    return df.withColumn(SEGMENT, label)


def narrow_body_ntile(df: DataFrame, mtow: str = "mtow_kg", parts: int = 4) -> DataFrame:
    """Narrow-body flights with ``ntile`` 1..4 over weight and flight id.

    The first ``n mod 4`` parts hold one flight more, as with the window function,
    but no single task orders all flights.
    """
    rows = with_row_index(df.where(is_narrow_body(F.col(mtow))), [mtow, KEY])
    small = F.floor(F.col("n_points") / parts)
    larger = F.pmod(F.col("n_points"), F.lit(parts))
    in_larger = F.col("row_no") < larger * (small + 1)
    part = F.when(in_larger, F.floor(F.col("row_no") / (small + 1))).otherwise(
        larger + F.floor(F.try_divide(F.col("row_no") - larger * (small + 1), small))
    )
    return rows.withColumn("ntile", part.cast("int") + 1).drop("row_no", "n_points")


def label_by_distance(df: DataFrame, mtow: str = "mtow_kg") -> DataFrame:
    """``segment``: narrow bodies by distance flown, wide bodies by type."""
    narrow = is_narrow_body(F.col(mtow))
    label = F.when(narrow, distance_bin(F.col("flown_distance"))).when(
        ~narrow, wide_body_label(F.col("aircraft_type"))
    )
    return df.withColumn(SEGMENT, label)


def standardise_in_segments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standardise columns inside each segment; rows without a segment drop out.

    The moments have one row per segment (at most six), so they are broadcast.
    """
    df = df.where(F.col(SEGMENT).isNotNull())
    found = moments(df, columns, by=[SEGMENT]).drop("n_rows")
    scores = {
        c: standard_score(F.col(c), F.col(f"{c}_mean"), F.col(f"{c}_std")) for c in columns
    }
    spare = [f"{c}_{s}" for c in columns for s in ("mean", "std")]
    return df.join(F.broadcast(found), SEGMENT).withColumns(scores).drop(*spare)


def split_by_mtow(
    df: DataFrame, mtow: str = "mtow_kg", method: str = "quantile", is_test: bool = False
) -> DataFrame:
    """Flights labelled with their weight segment, weight standardised inside it."""
    split = standardise_in_segments(label_by_mtow(df, mtow, method), [mtow])
    return split.drop(TARGET) if is_test else split


def split_by_distance(df: DataFrame, mtow: str = "mtow_kg") -> DataFrame:
    """As ``split_by_mtow`` by distance; weight and distance are standardised."""
    return standardise_in_segments(label_by_distance(df, mtow), [mtow, "flown_distance"])


def segment_views(
    split: DataFrame, names: Sequence[str] = MTOW_SEGMENTS, target: str = TARGET
) -> dict[str, tuple[DataFrame, DataFrame | None]]:
    """(features, target) by segment, as filtered views of one table."""
    views = {}
    for name in names:
        part = split.where(F.col(SEGMENT) == name).drop(SEGMENT)
        known = target in part.columns
        views[name] = (part.drop(target), part.select(KEY, target) if known else None)
    return views


def split_by_wake_class(
    df: DataFrame, target: str = TARGET
) -> dict[str, tuple[DataFrame, DataFrame]]:
    """(features, target) for wake classes M and H, told by their 0/1 columns."""
    views = {}
    for name in ("wtc_M", "wtc_H"):
        part = df.where(F.col(name) == 1)
        views[name] = (part.drop(target, "wtc_H", "wtc_M"), part.select(KEY, target))
    return views


def segment_summary(split: DataFrame, columns: Sequence[str] = (TARGET,)) -> DataFrame:
    """Size and moments of each segment in one grouped pass."""
    return moments(split.where(F.col(SEGMENT).isNotNull()), columns, by=[SEGMENT])


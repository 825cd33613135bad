"""Labels from fixed edges and from a type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyload.constants import (
    DISTANCE_EDGES,
    DISTANCE_SEGMENTS,
    NARROW_BODY_LIMIT_KG,
    WIDE_BODY_TYPE,
)


def left_closed_bins(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the last edge not above ``value``; NULL below the first edge."""
    label = F.lit(None).cast("string")
    for edge, name in zip(edges, labels, strict=True):
        label = F.when(value >= F.lit(edge), F.lit(name)).otherwise(label)
    return label


def distance_bin(distance: Column) -> Column:
    """[0, 500), [500, 1000) and from 1000."""
    return left_closed_bins(distance, DISTANCE_EDGES, DISTANCE_SEGMENTS[: len(DISTANCE_EDGES)])


def is_narrow_body(mtow: Column) -> Column:
    """True up to the limit, false above, NULL when the weight is unknown."""
    return mtow <= F.lit(NARROW_BODY_LIMIT_KG)


def wide_body_label(aircraft_type: Column) -> Column:
    """The one wide-body type with a segment of its own, against all others."""
    own = F.coalesce(aircraft_type == F.lit(WIDE_BODY_TYPE), F.lit(False))
    return F.when(own, F.lit("b77w")).otherwise(F.lit("non_b77w"))

"""Connected parts of a graph whose links are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyload.session import release, stable


def _star(links: DataFrame, small: bool) -> DataFrame:
    """Each node's neighbours, linked with the least of them and itself: the larger neighbours, or the smaller ones."""
    if small:
        around = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("near"))
    else:
        around = links.select(F.col("a").alias("node"), F.col("b").alias("near")).union(links.select("b", "a"))
    least = around.groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("least"))
    met = around.join(least, "node")
    if small:
        kept = met.select(F.explode(F.array(F.struct(F.col("near").alias("b"), F.col("least").alias("a")), F.struct(F.col("node").alias("b"), F.col("least").alias("a")))).alias("l"))
        new = kept.select("l.a", "l.b")
    else:
        new = met.where(F.col("near") > F.col("node")).select(F.col("least").alias("a"), F.col("near").alias("b"))
    return new.where("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, least): for each node of the links (a, b) the least node that it is connected with.

    Links are turned over until each points from a node to the least one of its part; every round
    halves the paths at least, about.
    """
    now = stable(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    state = _state(now)
    while state[0]:
        large = stable(_star(now, small=False))
        old, now = now, stable(_star(large, small=True))
        release(old)
        release(large)
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("least"))

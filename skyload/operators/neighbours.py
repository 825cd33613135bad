"""Mean target of the nearest rows, exact, from an index of boxes.

Rows are parted at medians of a sample into boxes of similar size, whose true edges are those of all their rows. A row to be told
looks into the nearest boxes that hold enough rows; the distance of the last neighbour found there bounds how far any other
box may be, and only those within it are looked into. Pieces of boxes meet pieces of the rows that visit them, so no task holds
more of either than a bound.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyload.constants import KEY, TARGET
from skyload.session import in_task, release, stable, to_tasks

# Rows that medians are taken from, boxes at most, rows of a box aimed at, and rows of a piece of a box or of its visitors.
SAMPLE_ROWS, MOST_BOXES, BOX_ROWS, PIECE_ROWS = 100_000, 4096, 4000, 8000
# Visitors whose distances are worked out at once.
BLOCK = 128


@dataclass(frozen=True)
class Boxes:
    """Edges of the boxes, a row for each, and how many rows they hold."""

    number: np.ndarray
    low: np.ndarray
    high: np.ndarray
    count: np.ndarray

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each box, added up feature by feature as those of rows are."""
        out = np.zeros((len(points), len(self.number)))
        for f in range(points.shape[1]):
            x = points[:, f, None]
            out += np.square(np.maximum(np.maximum(self.low[:, f] - x, x - self.high[:, f]), 0.0))
        return out

    def home(self, distances: np.ndarray, k: int) -> np.ndarray:
        """Which boxes each point looks into first: the nearest ones until they hold ``k`` rows."""
        order = np.argsort(distances, axis=1, kind="stable")
        before = np.cumsum(self.count[order], axis=1) - self.count[order]
        first = np.zeros(distances.shape, bool)
        np.put_along_axis(first, order, before < k, axis=1)
        return first


@dataclass(frozen=True)
class NeighbourModel:
    """Written rows (_box, _piece, _key, _y, _x) with their boxes."""

    features: list[str]
    k: int
    rows: DataFrame
    boxes: Boxes

    def predict(self, df: DataFrame, name: str = "prediction", carry: Sequence[str] = (KEY,)) -> DataFrame:
        """``carry`` and the mean target of the ``k`` nearest rows, the smaller keys of equally near ones; NULL where a feature is missing."""
        given = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)]
        rows = stable(df.select(*given, _vector(self.features).alias("_x")))
        # Rows with the same features have the same neighbours, and are asked for once.
        asked = stable(rows.where(F.col("_x").isNotNull()).select("_x").distinct().withColumn("_q", F.monotonically_increasing_id()))
        found = neighbours(self, asked)
        told = asked.join(found.groupBy("_q").agg(F.avg("_y").alias("_told")), "_q").select("_x", "_told")
        known = rows.where(F.col("_x").isNotNull()).join(told, "_x", "left")
        every = known.unionByName(rows.where(F.col("_x").isNull()).withColumn("_told", F.lit(None).cast("double")))
        return every.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], F.col("_told").alias(name))

    def importances(self, name: str = "importance") -> DataFrame:
        """(feature, <name>): all features count alike."""
        return SparkSession.active().createDataFrame([(f, 1 / len(self.features)) for f in self.features], f"feature string, `{name}` double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the rows and a table of the features below ``path``."""
        self.rows.write.mode("overwrite").parquet(f"{path}/neighbours")
        named = [(i, f, self.k) for i, f in enumerate(self.features)]
        spark.createDataFrame(named, "place int, feature string, k int").coalesce(1).write.mode("overwrite").parquet(f"{path}/neighbour_features")

    @staticmethod
    def load(spark: SparkSession, path: str) -> NeighbourModel:
        named = spark.read.parquet(f"{path}/neighbour_features").orderBy("place").collect()
        rows = spark.read.parquet(f"{path}/neighbours")
        return NeighbourModel([r.feature for r in named], named[0].k, rows, _edges(rows, len(named)))


def _vector(features: Sequence[str]):
    """The features as an array, NULL where one is missing or NaN."""
    values = [F.col(f"`{f}`").cast("double") for f in features]
    complete = F.lit(True)
    for v in values:
        complete = complete & v.isNotNull() & ~F.isnan(v)
    return F.when(complete, F.array(*values))


def _matrix(column: pa.Array | pd.Series, features: int) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack(column.to_numpy()).astype(float) if len(column) else np.zeros((0, features))
    return np.asarray(column.flatten()).reshape(-1, features)


def _cuts(sample: np.ndarray, boxes: int) -> list[tuple[int, float, int, int]]:
    """Nodes (feature, value, next at or below it, next above), cut at the median of the widest feature; feature -1 is a box with its number as value."""
    nodes: list = [None]
    open_: list[tuple[int, np.ndarray]] = [(0, sample)]
    made = 0
    while open_:
        at, points = open_.pop(0)
        spread = points.max(axis=0) - points.min(axis=0) if len(points) else np.zeros(1)
        f = int(np.argmax(spread))
        if made + len(open_) + 1 >= boxes or not spread[f] > 0:
            nodes[at] = (-1, float(made), 0, 0)
            made += 1
            continue
        value = float(np.partition(points[:, f], (len(points) - 1) // 2)[(len(points) - 1) // 2])
        if value == points[:, f].max():
            value = float(points[:, f][points[:, f] < value].max())
        nodes[at] = (f, value, len(nodes), len(nodes) + 1)
        low = points[:, f] <= value
        open_ += [(len(nodes), points[low]), (len(nodes) + 1, points[~low])]
        nodes += [None, None]
    return nodes


def _edges(rows: DataFrame, features: int) -> Boxes:
    """The true edges of the boxes over all rows; at most ``MOST_BOXES`` rows reach the driver."""
    sides = [f(F.col("_x")[i]).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(features)]
    found = sorted(rows.groupBy("_box").agg(F.count(F.lit(1)).alias("n"), *sides).collect())
    table = np.array([list(r[2:]) for r in found], float).reshape(len(found), 2 * features)
    return Boxes(np.array([r[0] for r in found], np.int64), table[:, :features], table[:, features:], np.array([r[1] for r in found], np.int64))


def index_rows(
    train: DataFrame, features: Sequence[str], target: str = TARGET, k: int = 5, key: str = KEY, box_rows: int = BOX_ROWS, piece_rows: int = PIECE_ROWS, seed: int = 42
) -> NeighbourModel:
    """Index of the complete rows of ``train``, written.

    Of rows with the same features only the ``k`` of the smallest keys can be among the nearest, so others are left out; a heap of
    equal rows is thus small. Every other row is kept. Where the boxes hold fewer than ``k`` rows, all of them are neighbours.
    """
    features = list(features)
    rows = train.select(F.col(f"`{key}`").cast("bigint").alias("_key"), F.col(f"`{target}`").cast("double").alias("_y"), _vector(features).alias("_x")).dropna("any", subset=["_y", "_x"])
    first = W.partitionBy("_x").orderBy("_key", "_y")
    kept = stable(rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k).drop("_n"))
    count = kept.count()
    sample = kept.select("_x").sample(min(1.0, SAMPLE_ROWS / max(count, 1)), seed).limit(SAMPLE_ROWS).toArrow()
    points = _matrix(sample.column("_x").combine_chunks(), len(features)) if sample.num_rows else np.zeros((0, len(features)))
    nodes = _cuts(points, min(MOST_BOXES, -(-count // box_rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feature, value, low, high = (np.array(c) for c in zip(*nodes, strict=True))
        for batch in batches:
            x = _matrix(batch.column("_x"), len(features))
            at, own = np.zeros(len(x), np.int64), np.arange(len(x))
            while len(own := own[feature[at[own]] >= 0]):
                node = at[own]
                at[own] = np.where(x[own, feature[node]] <= value[node], low[node], high[node])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value[at].astype(np.int64))], names=[*batch.schema.names, "_box"])

    boxed = stable(kept.mapInArrow(run, "_key bigint, _y double, _x array<double>, _box bigint"))
    release(kept)
    boxes = _edges(boxed, len(features))
    pieces = _by_box(boxed, boxes.number, -(-boxes.count // piece_rows))
    piece = F.pmod(F.xxhash64("_key", "_y", "_x"), F.col("_pieces")).alias("_piece")
    placed = stable(pieces.select("_box", piece, "_key", "_y", "_x"))
    release(boxed)
    return NeighbourModel(features, k, placed, boxes)


def _by_box(rows: DataFrame, number: np.ndarray, pieces: np.ndarray, name: str = "_pieces") -> DataFrame:
    """Rows with a number for their box; that table has at most ``MOST_BOXES`` rows."""
    pairs = list(zip(number.tolist(), pieces.tolist(), strict=True))
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(pairs, f"_box bigint, {name} bigint")), "_box")


def _visits(asked: DataFrame, model: NeighbourModel, first: bool) -> DataFrame:
    """(_box, _q, _x, _bound): boxes that rows look into at ``first``, without a bound, or the others within the distance ``_bound``."""
    held = to_tasks(asked.sparkSession, model.boxes)
    k, features = model.k, len(model.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes = in_task(held)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                distances = boxes.distances(_matrix(part.column("_x"), features))
                chosen = boxes.home(distances, k)
                bound = np.full(part.num_rows, np.inf)
                if not first:
                    bound = part.column("_bound").to_numpy()
                    chosen = ~chosen & (distances <= bound[:, None])
                row, box = np.nonzero(chosen)
                columns = [pa.array(boxes.number[box]), part.column("_q").take(pa.array(row)), part.column("_x").take(pa.array(row)), pa.array(bound[row])]
                yield pa.RecordBatch.from_arrays(columns, names=["_box", "_q", "_x", "_bound"])

    return stable(asked.mapInArrow(run, "_box bigint, _q bigint, _x array<double>, _bound double"))


def _nearest(x: np.ndarray, points: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(point, row, squared distance): the ``k`` nearest rows of ``x`` to each point that are no farther than its ``bound``, smaller places first where equal.

    Products of all pairs tell roughly which rows may be among them, with a margin for rounding; only those distances are worked out in full.
    """
    own_lengths, lengths = np.square(points).sum(axis=1), np.square(x).sum(axis=1)
    rough = own_lengths[:, None] + lengths - 2 * (points @ x.T)
    if np.isfinite(rough).all():
        limit = bound
        if len(x) > k and not (rough <= bound[:, None]).sum() <= 2 * k * len(points):
            limit = np.minimum(bound, np.partition(rough, k - 1, axis=1)[:, k - 1])
        slack = 8 * (x.shape[1] + 4) * np.finfo(float).eps * (own_lengths + lengths.max())
        own, at = np.nonzero(rough <= (limit + 2 * slack)[:, None])
    else:
        own, at = np.indices(rough.shape).reshape(2, -1)
    d = np.zeros(len(own))
    for f in range(x.shape[1]):
        d += np.square(points[own, f] - x[at, f])
    order = np.lexsort((at, d, own))
    own, at, d = own[order], at[order], d[order]
    first = np.arange(len(own)) - np.searchsorted(own, own) < k
    return own[first], at[first], d[first]


def _met(model: NeighbourModel, visits: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(_q, _d, _key, _y): for each visit the ``k`` nearest rows of each piece of the box."""
    counts = {r[0]: r[1] for r in visits.groupBy("_box").count().collect()}
    number = model.boxes.number
    slots = np.array([-(-counts.get(b, 0) // piece_rows) for b in number.tolist()], np.int64)
    pieces = dict(model.rows.groupBy("_box").agg(F.max("_piece") + 1).collect())
    held = _by_box(model.rows, number[slots > 0], slots[slots > 0], "_slots")
    held = held.select("_box", "_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_slots") - 1)).alias("_slot"), "_key", "_y", "_x")
    coming = _by_box(_by_box(visits, number, slots, "_slots"), number, np.array([pieces[b] for b in number.tolist()], np.int64))
    coming = coming.select("_box", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pieces") - 1)).alias("_piece"), F.pmod(F.xxhash64("_q"), F.col("_slots")).alias("_slot"), "_q", "_x", "_bound")
    k, features = model.k, len(model.features)

    def nearest(rows: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_key", "_y"], na_position="first", kind="stable")
        x, points = _matrix(rows["_x"], features), _matrix(asking["_x"], features)
        asked, bound, out = asking["_q"].to_numpy(), asking["_bound"].to_numpy(), []
        for start in range(0, len(points), BLOCK) if len(x) else ():
            part = slice(start, start + BLOCK)
            own, at, d = _nearest(x, points[part], bound[part], k)
            out.append(pd.DataFrame({"_q": asked[part][own], "_d": d, "_key": rows["_key"].array[at], "_y": rows["_y"].to_numpy()[at]}))
        return pd.concat(out) if out else pd.DataFrame({"_q": [], "_d": [], "_key": [], "_y": []})

    by = ("_box", "_piece", "_slot")
    return held.groupBy(*by).cogroup(coming.groupBy(*by)).applyInPandas(nearest, "_q bigint, _d double, _key bigint, _y double")


def _first(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("_q").orderBy("_d", "_key", "_y")
    return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k)


def neighbours(model: NeighbourModel, asked: DataFrame) -> DataFrame:
    """(_q, _d, _key, _y, _n): the ``k`` nearest rows of each one asked (_q, _x), with their squared distances; no two rows asked share a ``_q``."""
    if not len(model.boxes.number):
        return asked.sparkSession.createDataFrame([], "_q bigint, _d double, _key bigint, _y double, _n int")
    near = stable(_first(_met(model, _visits(asked, model, True)), model.k).drop("_n"))
    bounds = near.groupBy("_q").agg(F.max("_d").alias("_bound"))
    others = _visits(asked.join(bounds, "_q"), model, False)
    return _first(near.unionByName(_met(model, others)), model.k)

"""Removing outlying rows by isolation forest or by distance to a centre."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from skyload.functions import isolation
from skyload.operators.columns import complete_rows, numeric_columns, valid_altitudes
from skyload.operators.ordering import exact_quantiles, join_on, shuffle_partitions, split_by_length
from skyload.operators.prepare import moments, standard_score
from skyload.session import stable
from skyload.settings import Course

SEED = 42
# Distinct rows of short flights whose forests are grown at once.
FOREST_ROWS = 500
_TREE_SCHEMA = "tree int, sample_rows int, feature array<int>, threshold array<double>, path array<double>"


def _identity(columns: Sequence[str]) -> Column:
    """What tells rows apart for sampling: rows equal in these columns are one draw."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns], F.lit(SEED))


def _point(columns: Sequence[str]) -> Column:
    """The columns as an array. They need no common scale: a split is drawn within one column's range."""
    return F.array(*[F.col(f"`{c}`").cast("double") for c in columns])


def _candidates(points: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """(group, tree, draw, point): some hundred distinct rows for each tree.

    ``points`` has ``_identity``, ``_point`` and ``_distinct``, the number of distinct identities of the group.
    """
    kinds = {c: points.schema[c].dataType.simpleString() for c in group}
    schema = ", ".join([*[f"`{c}` {k}" for c, k in kinds.items()], "tree int, draw bigint, point array<double>"])

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            distinct, identity = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_distinct", "_identity"))
            for rows in np.unique(distinct).tolist():
                own = np.flatnonzero(distinct == rows)
                place, tree, order = isolation.candidates(identity[own].view("uint64"), rows)
                found = batch.take(pa.array(own[place]))
                columns = [*[found.column(c) for c in group], pa.array(tree.astype("int32")), pa.array(order.view("int64")), found.column("_point")]
                yield pa.RecordBatch.from_arrays(columns, names=[*group, "tree", "draw", "point"])

    drawn = points.select(*group, "_identity", "_point", "_distinct").mapInArrow(draw, schema)
    return drawn.groupBy(*group, "tree", "draw").agg(F.any_value("point").alias("point"))


def _grow_tree(candidates: pd.DataFrame, group: int = 0) -> pd.DataFrame:
    order = candidates["draw"].to_numpy().view("uint64").argsort()[: isolation.SAMPLE_ROWS]
    sample = np.stack(candidates["point"].to_numpy()[order])
    tree = int(candidates["tree"].iloc[0])
    grown = isolation.grow(sample[None], isolation.tree_seeds(group)[[tree]])
    feature, threshold, path = (part[0].tolist() for part in grown)
    return pd.DataFrame(
        {
            "tree": [tree], "sample_rows": [len(sample)], "feature": [feature],
            "threshold": [threshold], "path": [path],
        }
    )


def _forest(trees: pd.DataFrame) -> tuple[tuple[np.ndarray, ...], int]:
    """Arrays of all trees, and the size of the largest sample."""
    trees = trees.sort_values("tree")
    columns = [[np.asarray(a) for a in trees[name]] for name in ("feature", "threshold", "path")]
    return isolation.forest(list(zip(*columns, strict=True))), int(trees["sample_rows"].max())


def _seed_of(flight: object) -> int:
    return zlib.crc32(str(flight).encode())


def anomaly_scores(
    df: DataFrame, key: Sequence[str] | None = None, exclude: Iterable[str] = ()
) -> DataFrame:
    """Complete rows with an isolation-forest ``anomaly_score``.

    Rows are told apart by all columns, or by ``key`` where that is unique. All numeric columns
    count, the key included unless it is excluded. The forest (100 trees of at most 511 nodes) is
    fitted on samples drawn in one pass over all rows and sent to the tasks that score. Rows are
    computed once; scoring is costly, so it alone deals them evenly.
    """
    complete = stable(complete_rows(df))
    rows = complete.count()
    columns = numeric_columns(complete, exclude)
    if rows == 0:
        return complete.withColumn("anomaly_score", F.lit(0.0))
    points = complete.withColumns({"_identity": _identity(key or complete.columns), "_point": _point(columns)})
    distinct = points.select("_identity").distinct().count()
    trees = (
        _candidates(points.withColumn("_distinct", F.lit(distinct)))
        .groupBy("tree")
        .applyInPandas(lambda group: _grow_tree(group), _TREE_SCHEMA)
        .toPandas()
    )
    forest, sample_rows = _forest(trees)

    names, width = complete.columns, len(columns)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("_point").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            found = isolation.scores(data, forest, sample_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(found)], names=[*names, "anomaly_score"])

    even = complete.repartition(shuffle_partitions(df, rows)).withColumn("_point", _point(columns))
    return even.mapInArrow(score, StructType([*complete.schema.fields, StructField("anomaly_score", DoubleType())]))


def clean(
    df: DataFrame,
    contamination: float = 0.01,
    key: Sequence[str] | None = None,
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Complete rows without the share that an isolation forest finds most isolated."""
    scored = stable(anomaly_scores(df, key, exclude))
    limit = exact_quantiles(scored, "anomaly_score", {"q": 1.0 - contamination}).first()
    if limit is None or limit.q is None:
        return scored.drop("anomaly_score")
    return scored.where(F.col("anomaly_score") <= F.lit(limit.q)).drop("anomaly_score")


def _flight_scores(data: np.ndarray, identity: np.ndarray, first: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Scores of a flight of more distinct rows than a tree takes; ``identity`` of its distinct rows, which are the ``first`` ones."""
    place, tree, order = isolation.candidates(identity, len(identity))
    by_tree = np.lexsort((order, tree))
    cuts = np.searchsorted(tree[by_tree], np.arange(1, isolation.TREES))
    samples = [data[first[place[part[: isolation.SAMPLE_ROWS]]]] for part in np.split(by_tree, cuts)]
    sizes = [len(s) for s in samples]
    if min(sizes) == max(sizes):
        forest = isolation.grow(np.stack(samples), seeds)
    else:
        grown = (isolation.grow(s[None], seeds[[t]]) for t, s in enumerate(samples))
        forest = isolation.forest([tuple(part[0] for part in tree) for tree in grown])
    return isolation.scores(data, forest, max(sizes))


def _kept_points(data: np.ndarray, identity: np.ndarray, rows: list[int], groups: list[int], contamination: float) -> np.ndarray:
    """Whether each point stays. Flights of ``rows`` points lie one after another; ``groups`` tells their forests apart."""
    kept = np.ones(len(data), bool)
    small: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []

    def cut(start: int, scores: np.ndarray) -> None:
        kept[start : start + len(scores)] = scores <= isolation.quantile(scores, 1.0 - contamination)

    def together() -> None:
        points = np.concatenate([data[start + first] for start, _, first, *_ in small])
        sizes = np.array([len(first) for _, _, first, *_ in small])
        found = isolation.shared_scores(points, sizes, np.stack([seeds for *_, seeds in small]))
        for (start, _, _, own, _), scores in zip(small, np.split(found, np.cumsum(sizes)[:-1]), strict=True):
            cut(start, scores[own])
        small.clear()

    start = held = 0
    for n, group in zip(rows, groups, strict=True):
        if n > 1:
            distinct, first, own = np.unique(identity[start : start + n], return_index=True, return_inverse=True)
            seeds = isolation.tree_seeds(group)
            if len(distinct) > isolation.SAMPLE_ROWS:
                cut(start, _flight_scores(data[start : start + n], distinct, first, seeds))
            else:
                small.append((start, n, first, own, seeds))
                held += len(first)
                if held >= FOREST_ROWS:
                    together()
                    held = 0
        start += n
    if small:
        together()
    return kept


def _clean_flights(contamination: float, columns: Sequence[str], key: str):
    """Function that cleans the flights of a task; their points come sorted by flight, each flight fits the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in itertools.chain(batches, [None]):
            table = waiting if batch is None else pa.Table.from_batches([*(waiting.to_batches() if waiting else ()), batch])
            if table is None or not table.num_rows:
                continue
            flight = pc.dictionary_encode(table.column(key).combine_chunks(), null_encoding="encode").indices.to_numpy()
            starts = np.flatnonzero(np.r_[True, flight[1:] != flight[:-1]])
            # The last flight may go on in the next batch.
            end = table.num_rows if batch is None else int(starts[-1])
            waiting = table.slice(end)
            if not end:
                continue
            part, starts = table.slice(0, end), starts[starts < end]
            data = np.stack([part.column(c).to_numpy().astype("float64") for c in columns], axis=1) if columns else np.zeros((end, 0))
            identity = part.column("_identity").to_numpy().view("uint64")
            groups = [_seed_of(part.column(key).slice(s, 1).to_pandas().iloc[0]) for s in starts.tolist()]
            kept = _kept_points(data, identity, np.diff(np.r_[starts, end]).tolist(), groups, contamination)
            yield from part.filter(pa.array(kept)).drop_columns("_identity").to_batches()

    return run


def _score_piece(columns: Sequence[str]):
    """Function that scores one salted part of a long flight with the flight's trees."""

    def score(points: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
        if points.empty:
            return points[list(columns)].assign(anomaly_score=[])
        forest, sample_rows = _forest(trees)
        found = isolation.scores(np.stack(points["_point"].to_numpy()), forest, sample_rows)
        return points[list(columns)].assign(anomaly_score=found)

    return score


def _clean_long_flights(
    points: DataFrame, contamination: float, columns: Sequence[str], course: Course
) -> DataFrame:
    """The same for flights too long for a task: sample, fit, score salted parts, cut.

    Samples, seeds, scores and limits are those that one task would find. ``points`` has ``_identity``.
    """
    key, names = course.key, [c for c in points.columns if c != "_identity"]
    distinct = points.select(key, "_identity").distinct().groupBy(key).agg(F.count(F.lit(1)).alias("_distinct"))
    counts = points.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = stable(join_on(counts, distinct, [key]).withColumn("_salts", F.ceil(F.col("_rows") / F.lit(course.long_rows)).cast("int")))
    pointed = join_on(points.withColumn("_point", _point(columns)), sizes, [key])
    flight_type = points.schema[key].dataType.simpleString()
    named = pointed.withColumnRenamed(key, "_flight")
    trees = stable(
        _candidates(named, ["_flight"])
        .groupBy("_flight", "tree")
        .applyInPandas(
            lambda group: _grow_tree(group, _seed_of(group["_flight"].iloc[0])).assign(_flight=group["_flight"].iloc[0]),
            f"{_TREE_SCHEMA}, _flight {flight_type}",
        )
        .withColumnRenamed("_flight", key)
    )
    salted_trees = join_on(trees, sizes.select(key, "_salts"), [key]).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    ).drop("_salts")
    salted = pointed.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names]), F.col("_salts")).cast("int")).select(*[f"`{c}`" for c in names], "_point", "_salt")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in points.schema if f.name in names)
    scored = stable(
        salted.groupBy(key, "_salt")
        .cogroup(salted_trees.groupBy(key, "_salt"))
        .applyInPandas(_score_piece(names), f"{fields}, anomaly_score double")
    )
    limits = exact_quantiles(scored, "anomaly_score", {"_limit": 1.0 - contamination}, [key])
    return join_on(scored, limits, [key]).where(F.col("anomaly_score") <= F.col("_limit")).select(*[f"`{c}`" for c in names])


def clean_trajectory(
    points: DataFrame,
    contamination: float = 0.01,
    course: Course = Course(),
    exclude: Iterable[str] = (),
) -> DataFrame:
    """Points of valid altitude without the most isolated ones of their flight.

    Flights of one point pass. A flight up to ``course.long_rows`` points is one
    task's; a longer one is sampled and scored in parts, with the same result. Points equal in all
    columns are one draw.
    """
    points = valid_altitudes(points)
    columns = numeric_columns(points, exclude)
    told = points.withColumn("_identity", _identity(points.columns))
    usual, long = split_by_length(told, course.key, course.long_rows)
    # The work is in the forests, not in the bytes, so partitions are not merged by size; by the key itself, Spark would keep those of the windows, merged.
    spread = usual.repartition(shuffle_partitions(usual, usual.select(course.key).count()), F.xxhash64(course.key))
    cleaned = spread.sortWithinPartitions(course.key).mapInArrow(_clean_flights(contamination, columns, course.key), points.schema)
    if long is None:
        return cleaned
    return cleaned.unionByName(_clean_long_flights(long, contamination, columns, course))


def centre_distances(
    df: DataFrame, k: int = 1, exclude: Iterable[str] = (), ddof: int = 1
) -> DataFrame:
    """Complete rows with the ``distance`` of their standardised values to their centre.

    One centre is the mean. More are found by bisecting k-means.
    """
    df = complete_rows(df)
    columns = numeric_columns(df, exclude, only_double=True)
    found = moments(df, columns, ddof).first()
    scores = {
        f"_z{i}": standard_score(
            F.col(c), F.lit(found[f"{c}_mean"]).cast("double"), F.lit(found[f"{c}_std"]).cast("double")
        )
        for i, c in enumerate(columns)
    }
    scaled = df.withColumns(scores)
    if k > 1:
        vectors = VectorAssembler(inputCols=list(scores), outputCol="_vector").transform(scaled)
        model = BisectingKMeans(
            k=k, seed=SEED, featuresCol="_vector", predictionCol="_cluster"
        ).fit(vectors)
        scaled = model.transform(vectors)
        centres = [list(map(float, centre)) for centre in model.clusterCenters()]
        places = [F.get(F.array(*[F.lit(c[i]) for c in centres]), F.col("_cluster")) for i in range(len(columns))]
    else:
        places = [F.lit(0.0)] * len(columns)
    gaps = [F.col(z) - place for z, place in zip(scores, places, strict=True)]
    square = sum((gap * gap for gap in gaps), F.lit(0.0))
    return scaled.withColumn("distance", F.sqrt(square)).select(*df.columns, "distance")


def clean_by_distance(
    df: DataFrame, contamination: float = 0.01, k: int = 1, exclude: Iterable[str] = ()
) -> DataFrame:
    """Complete rows without the share that lies farthest from its centre."""
    # More centres than one take many passes over the rows.
    far = stable(centre_distances(stable(complete_rows(df)), k, exclude)) if k > 1 else centre_distances(df, k, exclude)
    limit = exact_quantiles(far, "distance", {"q": 1.0 - contamination}).first()
    return far.where(F.col("distance") <= F.lit(limit.q if limit else None)).drop("distance")


def clean_trajectory_by_distance(
    points: DataFrame, contamination: float = 0.01, k: int = 1, exclude: Iterable[str] = ()
) -> DataFrame:
    """The same for points of valid altitude."""
    return clean_by_distance(valid_altitudes(points), contamination, k, exclude)

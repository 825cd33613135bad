"""Second-order boosted trees on a table of bytes.

Columns are cut at quantiles into at most 255 bins once, so a row is a few bytes. A level of a tree is one aggregation: sums of
gradient and hessian by node, feature and bin, taken in the tasks first, and the best split of each node from running sums over the bins. Only those
splits come to the driver. Sums are of whole numbers, so a tree does not depend on how the rows are partitioned. Several models grow
side by side: a level of all their trees is one job, and models of the same rows share the pass over them.

Trees are grown node by node, or symmetric: one split for a whole level, the one that gains most over all its nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyload.constants import KEY, TARGET
from skyload.session import in_task, release, stable, to_tasks

MOST_BINS = 255
# Relative error of the quantiles that columns are cut at.
QUANTILE_ERROR = 1e-3
# Trees after which predictions so far are written, and errors of the test rows looked at.
TREES_A_STAGE = 10
# Children have at least so many rows; bits that a sum of gradients has room for.
LEAST_ROWS, SUM_BITS = 1, 60
# Cells of histograms that models share a pass for, at 16 bytes each; one model has as many as it needs. Cells that leave a task at a time.
CELLS_IN_TASK, CELLS_IN_BATCH = 4_000_000, 100_000


@dataclass(frozen=True)
class Tree:
    """Nodes by number: the root is 0; ``feature`` is -1 for a leaf, else rows with a bin up to ``bin`` go ``left``."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node each row of bins ends at."""
        count, inner, own = len(bins), self.feature >= 0, np.arange(len(self.feature))
        cells, rows, at = np.ascontiguousarray(bins.T).ravel(), np.arange(count), np.zeros(count, np.int64)
        # A leaf leads to itself.
        first = np.where(inner, self.feature, 0) * count
        left, right = np.where(inner, self.left, own), np.where(inner, self.right, own)
        while inner.take(at).any():
            at = np.where(cells.take(first.take(at) + rows) <= self.bin.take(at), left.take(at), right.take(at))
        return at


@dataclass(frozen=True)
class LevelTree:
    """One split a level: a row's leaf has a bit for each, set where the bin of ``feature`` is above ``bin``; ``gain`` is a level's, ``value`` a leaf's."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf each row of bins ends at."""
        at = np.zeros(len(bins), np.int64)
        for level in range(len(self.feature)):
            at |= (bins[:, self.feature[level]] > self.bin[level]).astype(np.int64) << level
        return at


@dataclass(frozen=True)
class HistogramModel:
    """Features with the upper edges of their bins, the value before the first tree, and the trees."""

    features: list[str]
    edges: list[np.ndarray]
    base: float
    trees: list[Tree | LevelTree]

    def bins(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Bins of rows, a column for each feature; a value beyond all edges is in the last bin."""
        return np.stack([np.searchsorted(e, c, side="left").astype(np.uint8) for e, c in zip(self.edges, columns, strict=True)], axis=1)

    def stages(self, bins: np.ndarray) -> Iterator[np.ndarray]:
        """Predictions after no tree, after the first, and so on."""
        told = np.full(len(bins), self.base)
        yield told
        for tree in self.trees:
            told = told + tree.value[tree.leaves(bins)]
            yield told

    def predict(self, df: DataFrame, name: str = "prediction", carry: Sequence[str] = (KEY,)) -> DataFrame:
        """``carry`` and the prediction of each row, NULL where a feature is missing."""
        held = to_tasks(df.sparkSession, self)
        rows = df.select(*[F.col(f"`{c}`") for c in carry], *[F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(self.features)])
        schema = df.select(*[f"`{c}`" for c in carry]).schema.add(name, "double")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = in_task(held)
            for batch in batches:
                columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(carry), batch.num_columns)]
                told = np.full(batch.num_rows, model.base)
                if batch.num_rows and columns:
                    for told in model.stages(model.bins(columns)):  # noqa: B007
                        pass
                lacking = np.any([np.isnan(c) for c in columns], axis=0) if columns else np.zeros(batch.num_rows, bool)
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(told, mask=lacking)], names=schema.names)

        return rows.mapInArrow(run, schema)

    def importances(self, name: str = "importance") -> DataFrame:
        """(feature, <name>): each feature's share of all gains."""
        gains = np.zeros(len(self.features))
        for tree in self.trees:
            np.add.at(gains, tree.feature[tree.feature >= 0], tree.gain[tree.feature >= 0])
        shares = gains / gains.sum() if gains.sum() else gains
        return SparkSession.active().createDataFrame(list(zip(self.features, shares.tolist(), strict=True)), f"feature string, `{name}` double")

    def save(self, spark: SparkSession, path: str) -> None:
        """Write edges and nodes as two tables below ``path``; a symmetric tree's nodes are its levels, then its leaves."""
        edges = [(i, f, self.base, e.tolist()) for i, (f, e) in enumerate(zip(self.features, self.edges, strict=True))]
        nodes = [(t, n, *node) for t, tree in enumerate(self.trees) for n, node in enumerate(_nodes(tree))]
        spark.createDataFrame(edges, "place int, feature string, base double, edges array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
        schema = "tree int, node int, feature int, bin int, left int, right int, value double, gain double"
        spark.createDataFrame(nodes, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> HistogramModel:
        rows = spark.read.parquet(f"{path}/features").orderBy("place").collect()
        trees: list[list] = []
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():
            while len(trees) <= r.tree:
                trees.append([])
            trees[r.tree].append([r[c] for c in _NODE])
        return HistogramModel([r.feature for r in rows], [np.array(r.edges, float) for r in rows], rows[0].base, [_tree(t) for t in trees])


_NODE = ("feature", "bin", "left", "right", "value", "gain")


def _nodes(tree: Tree | LevelTree) -> list[tuple]:
    if isinstance(tree, LevelTree):
        levels = [(f, b, 0, 0, 0.0, g) for f, b, g in zip(tree.feature.tolist(), tree.bin.tolist(), tree.gain.tolist(), strict=True)]
        return levels + [(-1, 0, 0, 0, v, 0.0) for v in tree.value.tolist()]
    return list(zip(*[getattr(tree, c).tolist() for c in _NODE], strict=True))


def _tree(nodes: list[Sequence]) -> Tree | LevelTree:
    levels = [n for n in nodes if n[0] >= 0]
    if levels and not levels[0][2]:  # the root is on no node's left, so these lead nowhere: they are levels
        at = lambda i, kind: np.array([n[i] for n in levels], kind)
        return LevelTree(at(0, np.int64), at(1, np.int64), np.array([n[4] for n in nodes[len(levels) :]], float), at(5, float))
    columns = list(zip(*nodes, strict=True))
    return Tree(*[np.array(c, float if name in ("value", "gain") else np.int64) for name, c in zip(_NODE, columns, strict=True)])


@dataclass(frozen=True)
class Boosting:
    """Settings: penalty ``l2`` of leaf values, shares of rows and columns drawn for each tree, how many trees without a lower error end it, and
    whether trees are ``symmetric``."""

    depth: int = 8
    iterations: int = 2000
    rate: float = 0.05
    l2: float = 1.0
    subsample: float = 1.0
    column_share: float = 1.0
    patience: int = 50
    seed: int = 42
    symmetric: bool = False


def column_edges(df: DataFrame, features: Sequence[str], most: int = MOST_BINS) -> list[np.ndarray]:
    """Upper edges of each column's bins: all its values but the largest if there are few, else quantiles."""
    names = [f"`{c}`" for c in features]
    counts = df.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(names)]).first()
    out = []
    few = [i for i in range(len(names)) if counts[i] <= most // 2]
    values = df.agg(*[F.array_sort(F.collect_set(F.col(names[i]).cast("double"))).alias(f"v{i}") for i in few]).first() if few else ()
    held = dict(zip(few, values, strict=True))
    shares = [(i + 1) / most for i in range(most - 1)]
    many = [i for i in range(len(names)) if i not in held]
    cuts = dict(zip(many, df.approxQuantile([features[i] for i in many], shares, QUANTILE_ERROR), strict=True)) if many else {}
    for i in range(len(names)):
        out.append(np.unique(held[i][:-1] if i in held else cuts[i]).astype(float))
    return out


def byte_table(df: DataFrame, model: HistogramModel, target: str = TARGET, weight: str | None = None) -> DataFrame:
    """(draw, y, n, bins): each complete row's target and its bins, a byte for each feature; ``draw`` is a hash of its key.

    With a ``weight`` a row stands for so many equal ones, and ``draw`` is a hash of its features and target.
    """
    values = [F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(model.features)]
    y = F.col(f"`{target}`").cast("double").alias("y")
    draw, n = (F.xxhash64(KEY), F.lit(1)) if weight is None else (F.xxhash64(*values, y), F.col(weight))
    rows = df.select(draw.alias("draw"), y, n.cast("bigint").alias("n"), *values).dropna("any")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = model.bins([c.to_numpy() for c in batch.columns[3:]]) if batch.num_rows else np.zeros((0, 1), np.uint8)
            starts = np.arange(batch.num_rows + 1, dtype=np.int32) * bins.shape[1]
            cells = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(bins))])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], cells], names=["draw", "y", "n", "bins"])

    return stable(rows.mapInArrow(run, "draw bigint, y double, n bigint, bins binary"))


def _bins_of(batch: pa.RecordBatch, features: int) -> np.ndarray:
    """Bins of a batch's rows, those of a feature side by side in memory."""
    cells = batch.column("bins").cast(pa.binary())
    starts = np.frombuffer(cells.buffers()[1], np.int32, cells.offset + len(cells) + 1)[cells.offset :]
    return np.asfortranarray(np.frombuffer(cells.buffers()[2], np.uint8)[starts[0] : starts[-1]].reshape(-1, features))


def drawn(draw: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    """Which rows, by the hash of their keys, are in the sample of a tree."""
    if share >= 1:
        return np.ones(len(draw), bool)
    x = draw.view(np.uint64) + np.uint64((tree * 0x9E3779B97F4A7C15 + seed) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) < share * 2.0**53


def drawn_columns(features: int, tree: int, settings: Boosting) -> np.ndarray:
    """Features that a tree may split at."""
    if settings.column_share >= 1:
        return np.ones(features, bool)
    chosen = np.random.default_rng([settings.seed, tree]).permutation(features)[: max(1, math.ceil(settings.column_share * features))]
    return np.isin(np.arange(features), chosen)


@dataclass(frozen=True)
class _Growing:
    """A model that is boosted: ``table`` has predictions ``told`` after its first ``done`` trees."""

    table: DataFrame
    model: HistogramModel
    settings: Boosting
    scale: float
    unit: float
    done: int = 0

    @property
    def number(self) -> int:
        return len(self.model.trees)

    @property
    def newer(self) -> HistogramModel:
        return replace(self.model, base=0.0, trees=self.model.trees[self.done :])

    def and_one(self, tree: Tree | LevelTree) -> _Growing:
        return replace(self, model=replace(self.model, trees=[*self.model.trees, tree]))


def _histograms(growing: Sequence[_Growing], trees: Mapping[int, Tree | LevelTree], most: int | None = None) -> DataFrame:
    """(part, node, feature, bin, n, g): rows and gradients, as whole numbers, at the open nodes of each part's tree; of the first ``most`` features drawn.

    Parts of the same rows share a pass over them, as many as have ``CELLS_IN_TASK`` cells together.
    """
    passes: list[tuple[DataFrame, list[int], int]] = []
    for part, tree in trees.items():
        cells = int(np.isnan(tree.value).sum()) * sum(len(e) + 1 for e in growing[part].model.edges)
        at = next((i for i, (table, _, held) in enumerate(passes) if table is growing[part].table and held + cells <= CELLS_IN_TASK), None)
        if at is None:
            passes.append((growing[part].table, [part], cells))
        else:
            table, parts, held = passes[at]
            passes[at] = (table, [*parts, part], held + cells)
    made = reduce(DataFrame.unionAll, [_pass(table, [(p, growing[p], trees[p]) for p in parts], most) for table, parts, _ in passes])
    # Dealt out as the running sums need them; a task has one row for each cell.
    return made.repartition("part", "node", "feature").groupBy("part", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))


def _pass(table: DataFrame, parts: Sequence[tuple[int, _Growing, Tree | LevelTree]], most: int | None) -> DataFrame:
    """Cells of the trees of several models of the same rows, by task."""
    sent = []
    for part, state, tree in parts:
        allowed = np.flatnonzero(drawn_columns(len(state.model.features), state.number, state.settings))[:most]
        sent.append((part, state.newer, state.number, state.settings, state.scale, tree, allowed))
    held = to_tasks(table.sparkSession, sent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = in_task(held), []
        for _, newer, _, _, _, tree, _ in known:
            is_open = np.isnan(tree.value)
            first = np.cumsum([0, *[len(e) + 1 for e in newer.edges]])
            n = np.zeros(int(is_open.sum()) * first[-1], np.int64)
            sums.append((is_open, (np.cumsum(is_open) - 1) * first[-1], first, n, np.zeros_like(n)))
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _bins_of(batch, len(known[0][1].features))
            draw, y, told, times = (batch.column(c).to_numpy() for c in ("draw", "y", "told", "n"))
            for (_, newer, number, settings, scale, tree, allowed), (is_open, place, first, n, g) in zip(known, sums, strict=True):
                for more in newer.stages(bins):  # noqa: B007
                    pass
                at = tree.leaves(bins)
                mine = np.flatnonzero(is_open[at] & drawn(draw, number, settings.subsample, settings.seed))
                count = times[mine]
                gradient = np.rint((told[mine] + more[mine] - y[mine]) * scale).astype(np.int64) * count
                node = place[at[mine]]
                for f in allowed:
                    cell = node + first[f] + bins[mine, f]
                    np.add.at(n, cell, count)
                    np.add.at(g, cell, gradient)
        for (part, *_), (is_open, _, first, n, g) in zip(known, sums, strict=True):
            found = np.flatnonzero(n)
            node, cell = np.divmod(found, first[-1])
            feature = np.searchsorted(first, cell, side="right") - 1
            columns = [np.full(len(found), part), np.flatnonzero(is_open)[node], feature, cell - first[feature], n[found], g[found]]
            for start in range(0, len(found), CELLS_IN_BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(c[start : start + CELLS_IN_BATCH]) for c in columns], names=["part", "node", "feature", "bin", "n", "g"])

    return table.mapInArrow(run, "part bigint, node bigint, feature bigint, bin bigint, n bigint, g bigint")


def _of_part(values: Sequence[float]) -> Column:
    """A number of each part as a column."""
    if len(set(values)) == 1:
        return F.lit(float(values[0]))
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("part") + 1).cast("int"))


def _gains(histograms: DataFrame, growing: Sequence[_Growing]) -> DataFrame:
    """(part, node, feature, bin, n_left, g_left, n, g, gain): every split of a node after a bin that it has rows in; the gain is NULL where one side has none."""
    upto = W.partitionBy("part", "node", "feature").orderBy("bin")
    everything = W.partitionBy("part", "node", "feature")
    sums = histograms.select("part", "node", "feature", "bin", F.sum("n").over(upto).alias("n_left"), F.sum("g").over(upto).alias("g_left"), F.sum("n").over(everything).alias("n"), F.sum("g").over(everything).alias("g"))
    scale, l2 = _of_part([s.scale for s in growing]), _of_part([s.settings.l2 for s in growing])

    def score(g, n):
        whole = g.cast("double") / scale
        return whole * whole / (n + l2)

    gain = score(F.col("g_left"), F.col("n_left")) + score(F.col("g") - F.col("g_left"), F.col("n") - F.col("n_left")) - score(F.col("g"), F.col("n"))
    fits = (F.col("n_left") >= LEAST_ROWS) & (F.col("n") - F.col("n_left") >= LEAST_ROWS)
    return sums.withColumn("gain", F.when(fits, gain))


def _best_splits(histograms: DataFrame, growing: Sequence[_Growing]) -> list:
    """For each open node its rows and gradients, and the split of the largest gain (of equal ones that of the first feature and bin), if any gains."""
    sums = _gains(histograms, growing)
    split = F.struct(F.when(F.col("gain") > 0, F.col("gain")).alias("gain"), (-F.col("feature")).alias("feature"), (-F.col("bin")).alias("bin"), "n_left", "g_left")
    return sums.groupBy("part", "node").agg(F.max(split).alias("s"), F.first("n").alias("n"), F.first("g").alias("g")).collect()


def grow(growing: Sequence[_Growing]) -> list[Tree | None]:
    """One more tree of each model, level by level, or None where no row is drawn."""
    # An open node's value is NaN until it is split or becomes a leaf.
    nodes: list[list[list]] = [[[-1, 0, 0, 0, float("nan"), 0.0]] for _ in growing]
    left, depth = set(range(len(growing))), 0
    while left:
        found = _best_splits(_histograms(growing, {p: _tree(nodes[p]) for p in sorted(left)}), growing)
        if not depth:
            left &= {r.part for r in found}
        for r in sorted(found, key=lambda r: (r.part, r.node)):
            of, settings = nodes[r.part], growing[r.part].settings
            if depth < settings.depth and r.s.gain is not None:
                of[r.node] = [-r.s.feature, -r.s.bin, len(of), len(of) + 1, 0.0, r.s.gain]
                of += [[-1, 0, 0, 0, float("nan"), 0.0] for _ in range(2)]
            else:
                of[r.node][4] = -settings.rate * (r.g / growing[r.part].scale) / (r.n + settings.l2)
        depth += 1
        left = {p for p in left if depth <= growing[p].settings.depth and any(math.isnan(n[4]) for n in nodes[p])}
    return [None if math.isnan(n[0][4]) else _tree(n) for n in nodes]


def best_levels(histograms: DataFrame, growing: Sequence[_Growing]) -> dict[int, tuple[float, int, int]]:
    """By part the split that gains most over all its nodes together (of equal ones that of the first feature and bin), as (gain, feature, bin), if any gains.

    A node without rows in a bin gains there what it does at its bin before, so its gains are added up as steps from bin to bin. They are
    decimals, in squares of the largest target: exact sums do not depend on their order.
    """
    units = [s.unit * s.unit for s in growing]
    node = W.partitionBy("part", "node", "feature").orderBy("bin")
    exact = F.coalesce(F.col("gain") / _of_part(units), F.lit(0.0)).cast("decimal(36,16)")
    steps = _gains(histograms, growing).select("part", "feature", "bin", "node", exact.alias("gain"))
    steps = steps.select("part", "feature", "bin", (F.col("gain") - F.lag("gain", 1, 0).over(node)).alias("step"))
    whole = steps.groupBy("part", "feature", "bin").agg(F.sum("step").alias("step"))
    gained = F.sum("step").over(W.partitionBy("part", "feature").orderBy("bin")).alias("gain")
    split = F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"))
    found = whole.select("part", "feature", "bin", gained).groupBy("part").agg(F.max(split).alias("s")).collect()
    return {r.part: (float(r.s.gain) * units[r.part], -r.s.f, -r.s.b) for r in found if r.s.gain > 0}


def grow_levels(growing: Sequence[_Growing]) -> list[LevelTree | None]:
    """One more symmetric tree of each model, as :func:`grow`; it ends at the level that no split gains at. Leaves without rows are 0."""
    splits: list[list[tuple[float, int, int]]] = [[] for _ in growing]

    def tree(part: int, value: np.ndarray) -> LevelTree:
        return LevelTree(*[np.array([s[i] for s in splits[part]], np.int64) for i in (1, 2)], value, np.array([s[0] for s in splits[part]], float))

    def open_trees(parts) -> dict[int, LevelTree]:
        return {p: tree(p, np.full(1 << len(splits[p]), np.nan)) for p in parts}

    left = [p for p, s in enumerate(growing) if s.settings.depth > 0]
    while left:
        best = best_levels(_histograms(growing, open_trees(left)), growing)
        for part, split in best.items():
            splits[part].append(split)
        left = [p for p in left if p in best and len(splits[p]) < growing[p].settings.depth]
    sums = _histograms(growing, open_trees(range(len(growing))), most=1).groupBy("part", "node").agg(F.sum("n").alias("n"), F.sum("g").alias("g")).collect()
    values = {r.part: np.zeros(1 << len(splits[r.part])) for r in sums}
    for r in sums:
        values[r.part][r.node] = -growing[r.part].settings.rate * (r.g / growing[r.part].scale) / (r.n + growing[r.part].settings.l2)
    return [tree(p, values[p]) if p in values else None for p in range(len(growing))]


def _told(table: DataFrame, model: HistogramModel, done: int) -> DataFrame:
    """The table with predictions after all trees; those after the first ``done`` are in it."""
    held, features = to_tasks(table.sparkSession, replace(model, base=0.0, trees=model.trees[done:])), len(model.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        newer = in_task(held)
        for batch in batches:
            if batch.num_rows:
                for more in newer.stages(_bins_of(batch, features)):  # noqa: B007
                    pass
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(batch.column("told").to_numpy() + more)], names=batch.schema.names)

    return stable(table.mapInArrow(run, table.schema))


def stage_errors(table: DataFrame, model: HistogramModel, done: int = 0) -> dict[int, float]:
    """Sum of squared errors after each number of trees from ``done`` on, of a table with predictions after ``done``; all in one pass."""
    held, features = to_tasks(table.sparkSession, replace(model, base=0.0, trees=model.trees[done:])), len(model.features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        newer = in_task(held)
        sums = np.zeros(len(newer.trees) + 1)
        for batch in batches:
            if batch.num_rows:
                left, n = batch.column("y").to_numpy() - batch.column("told").to_numpy(), batch.column("n").to_numpy()
                for i, more in enumerate(newer.stages(_bins_of(batch, features))):
                    sums[i] += (n * (left - more) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)) + done), pa.array(sums)], names=["trees", "error"])

    found = table.mapInArrow(run, "trees bigint, error double").groupBy("trees").agg(F.sum("error").alias("error")).collect()
    return {r.trees: r.error for r in found}


def best_stage(errors: dict[int, float]) -> int:
    """The number of trees of the least error; of equal ones the fewest."""
    return min(sorted(errors), key=errors.get)


@dataclass(frozen=True)
class Binned:
    """Training rows as bytes with the prediction that models begin with: all that models of the same rows share.

    ``model`` has no trees yet; ``unit`` is the largest target, and gradients are whole multiples of 1 / ``scale``. The table has ``rows``
    that stand for ``count``, by their ``weight`` if they have one.
    """

    model: HistogramModel
    table: DataFrame
    count: int
    unit: float
    scale: float
    rows: int
    weight: str | None = None

    def of(self, rows: DataFrame, target: str = TARGET) -> DataFrame:
        """Other rows in the same bins, written."""
        made = byte_table(rows, self.model, target, self.weight)
        started = stable(made.withColumn("told", F.lit(self.model.base)))
        release(made)
        return started


def bin_rows(train: DataFrame, features: Sequence[str], target: str = TARGET, weight: str | None = None) -> Binned:
    """The complete rows of ``train`` in bins, written; released by the caller. Equal rows may be one with their number as its ``weight``."""
    features = list(features)
    # Cuts and bins are several passes over the rows.
    rows = stable(train.select(KEY if weight is None else weight, *[f"`{c}`" for c in features], f"`{target}`").dropna("any"))
    model = HistogramModel(features, column_edges(rows, features), 0.0, [])
    made = byte_table(rows, model, target, weight)
    release(rows)
    held, count, largest = made.agg(F.count(F.lit(1)), F.sum("n"), F.max(F.abs("y"))).first()
    count = count or 0
    scale = 1.0
    if count:
        # A gradient is at most about twice the largest target; the sum of all has room.
        scale = 2.0 ** math.floor(SUM_BITS - math.log2(count * 4 * max(largest, 1e-300)))
        model = replace(model, base=made.agg(F.sum(F.rint(F.col("y") * scale).cast("bigint") * F.col("n"))).first()[0] / scale / count)
    started = stable(made.withColumn("told", F.lit(model.base)))
    release(made)
    return Binned(model, started, count, largest or 1.0, scale, held, weight)


def _another(growing: Sequence[_Growing]) -> Sequence[Tree | LevelTree | None]:
    return (grow_levels if growing[0].settings.symmetric else grow)(growing)


def boost_all(jobs: Sequence[tuple[Binned, Boosting]]) -> list[HistogramModel]:
    """What :func:`boost` makes of each without test rows, grown side by side; all or none are symmetric."""
    growing = [_Growing(b.table, b.model, s, b.scale, b.unit) for b, s in jobs]
    left = [i for i, (b, s) in enumerate(jobs) if b.count and s.iterations > 0]
    while left:
        for i, tree in zip(left, _another([growing[i] for i in left]), strict=True):
            growing[i] = growing[i] if tree is None else growing[i].and_one(tree)
            state = growing[i]
            if tree is None or state.number >= state.settings.iterations:
                left = [j for j in left if j != i]
            elif state.number - state.done >= TREES_A_STAGE:
                growing[i] = replace(state, table=_after(state.table, state.model, state.done, state.table is jobs[i][0].table), done=state.number)
    for state, (binned, _) in zip(growing, jobs, strict=True):
        if state.table is not binned.table:
            release(state.table)
    return [state.model for state in growing]


def boost(binned: Binned, settings: Boosting, test: DataFrame | None = None) -> HistogramModel:
    """Boosted trees for squared error; ``test`` has rows in the same bins. Neither table is released."""
    if test is None or not binned.count:
        return boost_all([(binned, settings)])[0]
    state, held = _Growing(binned.table, binned.model, settings, binned.scale, binned.unit), test
    errors = stage_errors(held, state.model)
    while state.number < settings.iterations:
        while state.number < min(settings.iterations, state.done + TREES_A_STAGE) and (tree := _another([state])[0]):
            state = state.and_one(tree)
        if state.number == state.done:
            break
        errors |= stage_errors(held, state.model, state.done)
        if state.number >= settings.iterations or state.number - best_stage(errors) >= settings.patience:
            break
        held = _after(held, state.model, state.done, held is test)
        state = replace(state, table=_after(state.table, state.model, state.done, state.table is binned.table), done=state.number)
    for written, given in ((state.table, binned.table), (held, test)):
        if written is not given:
            release(written)
    return replace(state.model, trees=state.model.trees[: best_stage(errors)])


def _after(table: DataFrame, model: HistogramModel, done: int, keep: bool) -> DataFrame:
    """The table after all trees, in place of the one after ``done``, which goes unless it is to ``keep``."""
    newer = _told(table, model, done)
    if not keep:
        release(table)
    return newer


def train_histogram(train: DataFrame, settings: Boosting = Boosting(), test: DataFrame | None = None, target: str = TARGET, features: Sequence[str] = ()) -> HistogramModel:
    """Boosted trees for squared error on the complete rows of ``train``.

    With ``test`` the model is cut at the number of trees of its least error there, and training ends once
    ``settings.patience`` trees came after that. Without complete rows the model is 0 everywhere.
    """
    from skyload.operators import boosting_whole as whole

    binned = bin_rows(train, features, target)
    held = binned.of(test, target) if test is not None else None
    sent = whole.send(binned, held)
    try:
        if sent is None:
            return boost(binned, settings, held)
        [(model, errors)] = whole.boost_whole([(sent, settings)], TREES_A_STAGE, patient=held is not None)
        return model if held is None else replace(model, trees=model.trees[: best_stage(dict(enumerate(errors)))])
    finally:
        whole.unsend(sent)
        release(binned.table)
        release(held)

"""Isolation trees on one small sample, grown level by level (Liu, Ting and Zhou, 2008).

Per-task helper: the samples come from Spark and hold at most 256 rows per tree. A
tree is three arrays in heap order (children of i are 2i+1 and 2i+2): split
feature (-1 in a leaf), threshold, and path length of a row that ends there.

Nothing here depends on how rows lie in tasks: what a row draws follows from its identity
alone, and what a node draws from its tree and place.
"""

from __future__ import annotations

import math

import numpy as np

TREES = 100
SAMPLE_ROWS = 256
# Candidates per tree are drawn with a margin, then cut to the sample size.
CANDIDATE_ROWS = SAMPLE_ROWS * 1.5
EULER_GAMMA = 0.5772156649015329


def scatter(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _next(x: np.ndarray, step: np.ndarray | int) -> np.ndarray:
    return scatter(x + (np.atleast_1d(step).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from 64 bits."""
    return ((x >> np.uint64(11)).astype("float64") + 1.0) * 2.0**-53


def candidates(identity: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows stand for which trees: (place, tree, order).

    ``identity`` tells ``rows`` distinct rows apart, here some or all of them. Each stands for each tree with the same
    chance, and a tree takes those of the least ``order``. A row skips from one of its trees to the
    next, so it draws about as many numbers as it has trees.
    """
    chance = min(1.0, CANDIDATE_ROWS / max(rows, 1))
    if chance == 1.0:
        place = np.repeat(np.arange(len(identity)), TREES)
        tree = np.tile(np.arange(TREES), len(identity))
    else:
        at, active, step, found = np.full(len(identity), -1), np.arange(len(identity)), 0, []
        while len(active):
            skip = np.floor(np.log(uniform(_next(identity[active], step))) / math.log1p(-chance))
            at[active] += 1 + np.minimum(skip, TREES).astype(int)
            active = active[at[active] < TREES]
            found.append((active, at[active]))
            step += 1
        place, tree = (np.concatenate(parts) for parts in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2
    return place, tree, _next(scatter(identity[place]), tree)


def tree_seeds(group: int) -> np.ndarray:
    """A seed for each tree of a forest; ``group`` tells forests apart."""
    return _next(np.full(TREES, group, dtype=np.uint64), np.arange(TREES))


def average_path(rows: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``rows`` rows."""
    rows = np.asarray(rows, dtype="float64")
    many = np.maximum(rows, 3.0)
    mean = 2.0 * (np.log(many - 1.0) + EULER_GAMMA) - 2.0 * (many - 1.0) / many
    return np.where(rows <= 1, 0.0, np.where(rows == 2, 1.0, mean))


def depth_limit(rows: int) -> int:
    return math.ceil(math.log2(max(rows, 2)))


def _ranges(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.minimum.reduceat(values, starts, axis=0)
    return low, np.maximum.reduceat(values, starts, axis=0) - low


def grow(samples: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Grow one tree per entry of ``samples`` (trees x rows x features) at once, each from its seed."""
    trees, rows, width = samples.shape
    limit = depth_limit(rows)
    size = 2 ** (limit + 1) - 1
    feature = np.full((trees, size), -1, dtype="int32")
    threshold = np.zeros((trees, size))
    path = np.zeros((trees, size))
    points = samples.reshape(-1, width)
    row = np.arange(trees * rows)
    slot = np.repeat(np.arange(trees) * size, rows)
    for depth in range(limit + 1):
        if not len(row):
            break
        order = np.argsort(slot, kind="stable")
        row, slot = row[order], slot[order]
        starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        counts = np.diff(np.r_[starts, len(slot)])
        nodes = slot[starts]
        path.flat[nodes] = depth + average_path(counts)
        if depth == limit:
            break
        drawn = _next(seeds[nodes // size], nodes % size)
        group = np.repeat(np.arange(len(starts)), counts)
        chosen = (_next(drawn, 0) % np.uint64(width)).astype(int)
        low, spread = _ranges(points[row, chosen[group]], starts)
        # A feature without spread cannot split: draw again among those with spread.
        flat = np.flatnonzero((spread <= 0) & (counts > 1))
        if len(flat):
            flat_counts = counts[flat]
            inside = np.isin(group, flat)
            flat_starts = np.r_[0, np.cumsum(flat_counts)[:-1]]
            all_low, all_spread = _ranges(points[row[inside]], flat_starts)
            chances = uniform(_next(drawn[flat][:, None], 2 + np.arange(width)))
            again = np.where(all_spread > 0, chances, -1.0).argmax(axis=1)
            at = np.arange(len(flat))
            chosen[flat], low[flat], spread[flat] = again, all_low[at, again], all_spread[at, again]
        cut = low + (1.0 - uniform(_next(drawn, 1))) * spread
        splits = spread > 0
        feature.flat[nodes[splits]] = chosen[splits]
        threshold.flat[nodes[splits]] = cut[splits]
        right = points[row, chosen[group]] > cut[group]
        base = slot - slot % size
        slot = base + 2 * (slot - base) + 1 + right
        row, slot = row[splits[group]], slot[splits[group]]
    return feature, threshold, path


def forest(trees: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Arrays of all trees, each grown by itself, padded to one width."""
    if len(trees) != TREES:
        raise ValueError(f"{len(trees)} trees instead of {TREES}")
    width = max(len(t[0]) for t in trees)
    fills = (-1, 0.0, 0.0)
    return tuple(
        np.stack([np.pad(t[k], (0, width - len(t[k])), constant_values=fill) for t in trees])
        for k, fill in enumerate(fills)
    )


def scores(
    points: np.ndarray, forest: tuple[np.ndarray, ...], sample_rows: int, batch: int = 128
) -> np.ndarray:
    """Anomaly score in (0, 1]; the higher, the easier a row is to isolate."""
    feature, threshold, path = forest
    trees, size = feature.shape
    slots = np.arange(trees * size).reshape(trees, size)
    leaf = feature < 0
    # A leaf leads to itself: no value is above its threshold.
    below = np.where(leaf, slots, 2 * slots - slots[:, :1] + 1).ravel()
    column = np.where(leaf, 0, feature).ravel()
    limit = np.where(leaf, np.inf, threshold).ravel()
    length = path.ravel()
    width = points.shape[1]
    found = np.empty(len(points))
    for start in range(0, len(points), batch):
        values = np.ascontiguousarray(points[start : start + batch]).ravel()
        first = np.arange(0, len(values), width)[:, None]
        at = np.repeat(slots[:, 0][None, :], len(first), axis=0)
        for _ in range(depth_limit(sample_rows)):
            above = values.take(first + column.take(at)) > limit.take(at)
            at = below.take(at) + above
        found[start : start + batch] = length.take(at).mean(axis=1)
    return np.exp2(-found / max(float(average_path(sample_rows)), 1e-12))


def shared_scores(points: np.ndarray, rows: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Anomaly scores of rows of which each tree holds all, forest after forest; a forest has ``rows`` of them and a row of ``seeds``.

    A row's path ends where it is when the trees have grown, so nothing is looked up afterwards. Trees and scores are those
    of :func:`grow` and :func:`scores`, to the bit, for rows of at most ``SAMPLE_ROWS``.
    """
    width, mean = points.shape[1], average_path(np.arange(SAMPLE_ROWS + 1))
    first = np.cumsum(rows) - rows
    row = np.concatenate([np.tile(np.arange(start, start + n), TREES) for start, n in zip(first, rows, strict=True)])
    paths = np.empty((len(points), TREES))
    flat_points = np.ascontiguousarray(points).ravel()
    # Of each node: its tree, forest, place in its tree, and number of rows; its rows lie together.
    tree, of = np.tile(np.arange(TREES), len(rows)), np.repeat(np.arange(len(rows)), TREES)
    place, counts = np.zeros(len(of), np.int64), rows[of]
    limits = np.array([depth_limit(n) for n in rows.tolist()])

    def end(which: np.ndarray, group: np.ndarray) -> None:
        done = which[group]
        paths[row[done], tree[group[done]]] = (depth + mean[counts])[group[done]]

    depth = 0
    while len(row):
        group = np.repeat(np.arange(len(counts)), counts)
        open_ = (counts > 1) & (limits[of] > depth)
        if not open_.all():
            end(~open_, group)
            row = row[open_[group]]
            tree, of, place, counts = tree[open_], of[open_], place[open_], counts[open_]
            if not len(row):
                break
            group = np.repeat(np.arange(len(counts)), counts)
        starts = np.cumsum(counts) - counts
        drawn = _next(seeds[of, tree], place)
        chosen = (_next(drawn, 0) % np.uint64(width)).astype(int)
        values = flat_points.take(row * width + chosen[group])
        low, spread = _ranges(values, starts)
        # As in growing: a feature without spread cannot split.
        flat = np.flatnonzero(spread <= 0)
        if len(flat):
            inside = (spread <= 0)[group]
            flat_starts = np.cumsum(counts[flat]) - counts[flat]
            all_low, all_spread = _ranges(points[row[inside]], flat_starts)
            chances = uniform(_next(drawn[flat][:, None], 2 + np.arange(width)))
            again = np.where(all_spread > 0, chances, -1.0).argmax(axis=1)
            at = np.arange(len(flat))
            chosen[flat], low[flat], spread[flat] = again, all_low[at, again], all_spread[at, again]
            values = flat_points.take(row * width + chosen[group])
        cut = low + (1.0 - uniform(_next(drawn, 1))) * spread
        splits = spread > 0
        if not splits.all():
            end(~splits, group)
            left = splits[group]
            row, values = row[left], values[left]
            tree, of, place, counts, cut = tree[splits], of[splits], place[splits], counts[splits], cut[splits]
            if not len(row):
                break
            group = np.repeat(np.arange(len(counts)), counts)
            starts = np.cumsum(counts) - counts
        right = values > cut[group]
        above = np.add.reduceat(right, starts, dtype=np.int64)
        # Rows keep their order within the halves of their node: below first.
        halves = np.stack([counts - above, above], axis=1).ravel()
        begin = (np.cumsum(halves) - halves).reshape(-1, 2)
        moved = np.empty_like(row)
        for side, mine in enumerate((~right, right)):
            which = np.flatnonzero(mine)
            number = halves[side::2]
            moved[(begin[:, side] - (np.cumsum(number) - number))[group[which]] + np.arange(len(which))] = row[which]
        row, counts = moved, halves
        tree, of = np.repeat(tree, 2), np.repeat(of, 2)
        place = (2 * place[:, None] + np.array([1, 2])).ravel()
        # Rounding can put a cut on the highest value, so that nothing lies above.
        kept = counts > 0
        tree, of, place, counts = tree[kept], of[kept], place[kept], counts[kept]
        depth += 1
    scale = np.maximum(average_path(rows), 1e-12)
    return np.exp2(-paths.mean(axis=1) / np.repeat(scale, rows))


def quantile(values: np.ndarray, probability: float) -> float:
    """Linearly interpolated, to the bit as Spark's ``percentile``."""
    ordered, position = np.sort(values), (len(values) - 1) * probability
    low, high = math.floor(position), math.ceil(position)
    if ordered[low] == ordered[high]:
        return float(ordered[low])
    return float((high - position) * ordered[low] + (position - low) * ordered[high])

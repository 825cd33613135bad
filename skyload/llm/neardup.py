"""Near duplicates by ProbMinHash: weighted shingles, bands of their signatures, verified links.

A text is its runs of five words, each with a weight of 1 + ln(how often it occurs). Every shingle is a
Poisson process whose rate is its weight, and each of its arrivals falls to one component of the signature; a
component keeps the shingle that arrives first. Two texts agree in a component with the probability Jaccard of
their weights. A shingle is dropped once it arrives later than all components have been reached, so most
shingles draw one number.

Texts equal word for word are one node. Nodes that agree in a band of components are candidates, and those are
verified on all their shingles. Texts with repeated shingles have a second signature with all weights 1, as a plain
Jaccard can be far above the probability Jaccard there. Instead of all pairs in a bucket, its members are compared with one centre, and
then, where they are still in different classes, with further ones in each round, until none is left to compare.
In large buckets most pairs are left out beforehand: by a bound, as shingles that a text shares with
none of the others there count against every partner, and by how many components of the signatures agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyload.llm.graphs import components
from skyload.llm.texts import Words, free_name, key_filter, map_texts, may_hold, mix, one_by_one, pieces, row_key, run_hashes
from skyload.session import release, stable

WORDS, LEAST_SIMILARITY = 5, 0.8
# Forty bands of seven components miss eight pairs in 100,000 of Jaccard 0.8, of either kind, and bring together
# one pair in sixteen of 0.4, such as texts that share a long passage.
BANDS, ROWS = 40, 7
# Buckets of at most so many members are finished in one round.
SMALL_BUCKET = 32
# Centres of a larger bucket in the second round, about; each further round has twice as many.
CENTRES = 256
# In large buckets, pairs of texts without repeated shingles whose signatures agree in a share this much below the
# threshold are no candidates: over four standard deviations. Signatures keep four bits of each component there.
MARGIN = 0.1
NIBBLES = 16
# Parts of a large bucket, or of a large class, that are worked on apart.
SALTS = 32
# Elements whose arrivals are drawn at once, and bytes of shingles that are laid out at once.
DRAWN, SET_BYTES = 1 << 16, 1 << 21
# Shingles of one range, about, when those that occur once are looked for.
RANGE_SHINGLES = 1 << 20


def shingles(words: Words, size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of ``size`` words of each text: (row, hash, count), by row and hash. A shorter text is one run."""
    hashes, rows, grams = words.hashes(), [], []
    if len(words.counts) == 1 and words.counts[0] >= size:  # a long text is alone
        gram = run_hashes(hashes, size)
        del hashes
        gram.sort()
        first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        return np.zeros(len(first), np.int64), gram[first], np.diff(np.r_[first, len(gram)])
    for n in range(1, size + 1):
        at = words.starts_of(n) if n == size else words.first[:-1][words.counts == n]
        if len(at):
            rows.append(words.row[at])
            grams.append(run_hashes(hashes, n)[at])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    row, gram = np.concatenate(rows), np.concatenate(grams)
    order = np.lexsort((gram, row))
    row, gram = row[order], gram[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])]
    return row[new], gram[new], np.diff(np.r_[np.flatnonzero(new), len(row)])


def prob_minhash(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, size: int) -> np.ndarray:
    """Signatures (rows x size): in each component the element that arrives there first; 0 for a row without elements."""
    first, winner, latest = np.full(rows * size, np.inf), np.zeros(rows * size, np.uint64), np.full(rows, np.inf)
    for at in range(0, len(element), DRAWN):
        _arrivals(row[at : at + DRAWN], element[at : at + DRAWN], weight[at : at + DRAWN], size, first, winner, latest)
    return winner.reshape(rows, size)


def _arrivals(row: np.ndarray, element: np.ndarray, weight: np.ndarray, size: int, first: np.ndarray, winner: np.ndarray, latest: np.ndarray) -> None:
    """Draw arrivals of some elements until all are later than what their rows have; ``first``, ``winner`` and ``latest`` are brought up to date."""
    time, active, draws = np.zeros(len(element)), np.arange(len(element)), 0
    while len(active):
        # Few elements draw several numbers at a time; one that is too late changes nothing.
        some = max(1, min(size, 16384 // len(active)))
        steps = np.arange(draws + 1, draws + 1 + some, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)
        seeds = mix(element[active][:, None] + steps)
        gaps = -np.log(((seeds >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / weight[active][:, None]
        times = np.cumsum(np.concatenate([time[active][:, None], gaps], axis=1), axis=1)[:, 1:]
        time[active] = times[:, -1]
        at, _ = early = np.nonzero(times < latest[row[active]][:, None])
        which, when = active[at], times[early]
        place = row[which] * size + (mix(seeds[early] ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, place, when)
        won = first[place] == when
        winner[place[won]] = element[which[won]]
        touched = np.unique(row[which])
        latest[touched] = first.reshape(-1, size)[touched].max(axis=1)
        active = active[time[active] < latest[row[active]]]
        draws += some


def probability_jaccard(x: np.ndarray, y: np.ndarray) -> float:
    """Of two weight vectors over the same elements: the sum over d of 1 / sum over e of max(x[e]/x[d], y[e]/y[d])."""
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    below = np.r_[0.0, np.cumsum(y)]
    above = np.r_[np.cumsum(x[::-1])[::-1], 0.0]
    both = (x > 0) & (y > 0)
    at = np.searchsorted(ratio, ratio[both], side="left")
    return float((x[both] / (above[at] + ratio[both] * below[at])).sum())


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of Jaccard and probability Jaccard of two texts, each given by sorted shingles and their counts."""
    union = np.union1d(a[0], b[0])
    if not len(union):
        return 0.0
    plain = (len(a[0]) + len(b[0]) - len(union)) / len(union)
    if (a[1] == 1).all() and (b[1] == 1).all():
        return plain
    x, y = np.zeros(len(union)), np.zeros(len(union))
    x[np.searchsorted(union, a[0])] = 1 + np.log(a[1])
    y[np.searchsorted(union, b[0])] = 1 + np.log(b[1])
    return max(plain, probability_jaccard(x, y))


def _word_digests(words: Words) -> list[str | None]:
    """Digest of each text's words; None without words."""
    out: list[str | None] = []
    inside = np.zeros(len(words.data) + 1, np.int8)
    inside[words.start] = 1
    closing = np.zeros(len(words.data) + 1, np.int8)
    closing[words.end] = 1
    # Depth is 1 within words; adjoining texts end and start a word at one byte.
    kept = np.cumsum(inside.astype(np.int64) - closing)[:-1] > 0
    letters = words.data[kept]
    lengths = words.end - words.start
    ends = np.r_[0, np.cumsum(lengths)]
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if first == last:
            out.append(None)
            continue
        digest = hashlib.md5(letters[ends[first] : ends[last]].tobytes())
        digest.update(lengths[first:last].tobytes())
        out.append(digest.hexdigest())
    return out


def signatures(documents: DataFrame, id: str, text: str) -> DataFrame:
    """(id, key, digest, bands, signature); digest and bands are NULL for texts without words.

    A text with repeated shingles has the bands of two signatures, with its weights and with all weights 1: the first
    meet texts of a like probability Jaccard, the second of a like plain one. Without repeats both are the same.
    ``signature`` is the first, with four bits of each component, sixteen components in a number.
    """
    size = BANDS * ROWS

    def compute(texts: pa.Array) -> list[pa.Array]:
        words = Words(texts)
        row, gram, count = shingles(words)
        made = prob_minhash(row, gram, 1 + np.log(count), len(texts), size)
        bands = banded(made)
        listed = [b if h else None for b, h in zip(bands.tolist(), words.counts > 0, strict=True)]
        repeats = np.unique(row[count > 1])
        if len(repeats):
            mine = np.isin(row, repeats)
            even = banded(prob_minhash(np.searchsorted(repeats, row[mine]), gram[mine], np.ones(mine.sum()), len(repeats), size))
            for r, more in zip(repeats.tolist(), even, strict=True):
                listed[r] += more[more != bands[r]].tolist()
        return [
            pa.array(_word_digests(words), pa.string()),
            pa.array(listed, pa.list_(pa.int64())),
            pa.array(packed(made).view(np.int64).tolist(), pa.list_(pa.int64())),
        ]

    carry = [F.col(f"`{id}`").alias("__id"), row_key(id, text).alias("key")]
    return stable(map_texts(documents, compute, {"digest": "string", "bands": "array<bigint>", "signature": "array<bigint>"}, text, carry))


def banded(made: np.ndarray) -> np.ndarray:
    """The bands of signatures: a hash of the components of each, and of its place."""
    bands = np.zeros((len(made), BANDS), np.uint64)
    for i in range(ROWS):
        bands = mix(bands * np.uint64(0x9E3779B97F4A7C15) + made[:, i::ROWS])
    return mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)).view(np.int64)


def packed(made: np.ndarray) -> np.ndarray:
    """The highest four bits of each component, sixteen to a number; the last number is filled up with zeros."""
    bits = made >> np.uint64(60)
    bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % NIBBLES))).reshape(len(made), -1, NIBBLES)
    return (bits << (np.arange(NIBBLES, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64)


def differing(x: Column, y: Column) -> Column:
    """How many components of two packed signatures differ."""

    def of_number(a: Column, b: Column) -> Column:
        apart = a.bitwiseXOR(b)
        apart = apart.bitwiseOR(F.shiftrightunsigned(apart, 1))
        apart = apart.bitwiseOR(F.shiftrightunsigned(apart, 2))
        return F.bit_count(apart.bitwiseAND(F.lit(0x1111111111111111)))

    return F.aggregate(F.zip_with(x, y, of_number), F.lit(0), lambda total, n: total + n)


def _members(nodes: DataFrame) -> DataFrame:
    """(bucket, node) of buckets that at least two nodes are in."""
    buckets = nodes.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    shared = stable(buckets.where("n > 1").select("bucket"))
    held = nodes.sparkSession.sparkContext.broadcast(key_filter(shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            bands = batch.column(1)
            bucket, node = bands.flatten(), batch.column(0).take(pc.list_parent_indices(bands))
            kept = pa.array(may_hold(held.value, bucket.to_numpy()))
            yield pa.RecordBatch.from_arrays([bucket.filter(kept), node.filter(kept)], names=["bucket", "node"])

    likely = nodes.select("node", "bands").mapInArrow(run, "bucket bigint, node bigint")
    return stable(likely.join(shared, "bucket", "left_semi"))


def _shingle_sets(documents: DataFrame, wanted: DataFrame, id: str, text: str) -> DataFrame:
    """(node, grams, counts) of the nodes wanted (key, node): sorted shingles, by 32 bits of their hashes, and counts."""
    held = documents.sparkSession.sparkContext.broadcast(key_filter(wanted.select(F.xxhash64("key"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            likely = batch.filter(pa.array(may_hold(held.value, batch.column(0).to_numpy())))
            for piece in pieces(likely):
                row, gram, count = shingles(Words(piece.column(2)))
                cuts = np.searchsorted(row, np.arange(1, piece.num_rows))
                grams = [(g >> np.uint64(32)).astype(np.uint32).tobytes() for g in np.split(gram, cuts)]
                counts = [c.astype(np.uint32).tobytes() if (c > 1).any() else b"" for c in np.split(count, cuts)]
                yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(grams, pa.binary()), pa.array(counts, pa.binary())], names=["key", "grams", "counts"])

    key = row_key(id, text)
    sent = documents.select(F.xxhash64(key).alias("hash"), key.alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    made = sent.mapInArrow(run, "key string, grams binary, counts binary")
    return stable(made.join(wanted, "key").select("node", "grams", "counts").dropDuplicates(["node"]))


def _one(grams: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    held = np.frombuffer(grams, np.uint32)
    return held, np.frombuffer(counts, np.uint32) if counts else np.ones(len(held), np.uint32)


def _bounds(sets: DataFrame) -> DataFrame:
    """What bounds the similarity of nodes with each other: (node, n, own, mass, own_mass, heaviest).

    ``n`` shingles of weight ``mass``; ``own`` of them, of weight ``own_mass``, are in no other node here; ``heaviest`` is the
    largest weight of one. Shingles go to ranges of their hashes. Those that repeat within a batch go there once, so a shingle
    of very many nodes does not fill its range.
    """
    held = sets.agg(F.sum(F.octet_length("grams"))).first()[0] or 0
    ranges = max(64, held // 4 // RANGE_SHINGLES)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in one_by_one(batches) for p in pieces(b.select(["node", "counts", "grams"]), SET_BYTES)):
            each = [_one(g.as_py(), c.as_py()) for g, c in zip(part.column("grams"), part.column("counts"), strict=True)]
            gram = np.concatenate([g for g, _ in each])
            node = np.repeat(part.column("node").to_numpy(), [len(g) for g, _ in each])
            weight = 1 + np.log(np.concatenate([c for _, c in each]))
            order = np.argsort(gram, kind="stable")
            gram, node, weight = gram[order], node[order], weight[order]
            first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
            often = np.diff(np.r_[first, len(gram)]) > 1
            gram, node, weight = gram[first], np.where(often, -1, node[first]), weight[first]
            place = (gram.astype(np.uint64) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            met = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
            split = [[values[a:b].tobytes() for a, b in zip(met, [*met[1:], len(place)], strict=True)] for values in (gram, node, weight)]
            yield pa.RecordBatch.from_arrays([pa.array(place[met]), *[pa.array(s, pa.binary()) for s in split]], names=["range", "grams", "nodes", "weights"])

    def single(parts: pd.DataFrame) -> pd.DataFrame:
        gram, node, weight = (np.frombuffer(b"".join(parts[c]), kind) for c, kind in (("grams", np.uint32), ("nodes", np.int64), ("weights", np.float64)))
        _, first, count = np.unique(gram, return_index=True, return_counts=True)
        own = first[count == 1]
        own = own[node[own] >= 0]
        return pd.DataFrame({"node": node[own], "weight": weight[own]}).groupby("node", as_index=False).agg(own=("weight", "size"), own_mass=("weight", "sum"))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            found = []
            for g, c in zip(batch.column("grams"), batch.column("counts"), strict=True):
                weights = 1 + np.log(_one(g.as_py(), c.as_py())[1])
                found.append((len(weights), weights.sum(), weights.max(initial=1.0)))
            made = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *made], names=["node", "n", "mass", "heaviest"])

    parts = sets.mapInArrow(spread, "range bigint, grams binary, nodes binary, weights binary")
    found = parts.groupBy("range").applyInPandas(single, "node bigint, own bigint, own_mass double")
    own = found.groupBy("node").agg(F.sum("own").alias("own"), F.sum("own_mass").alias("own_mass"))
    zero = [F.coalesce("own", F.lit(0).cast("bigint")).alias("own"), F.coalesce("own_mass", F.lit(0.0)).alias("own_mass")]
    return stable(sets.mapInArrow(totals, "node bigint, n bigint, mass double, heaviest double").join(own, "node", "left").select("node", "n", "mass", "heaviest", *zero))


def _possible(x: Column, y: Column, least: float) -> Column:
    """Whether two nodes with these bounds can be similar enough.

    What x shares with y is without x's own shingles, and their union has those of y besides x; likewise for weights.
    """
    slack = least - 1e-9
    plain = (x["n"] - x["own"]) >= slack * (x["n"] + y["own"])
    weighed = (x["mass"] - x["own_mass"]) >= slack * (x["mass"] + y["own_mass"] / y["heaviest"])
    return plain | weighed


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Pairs whose similarity reaches the threshold."""
    of = lambda name: sets.select(F.col("node").alias(name), F.col("grams").alias(f"grams_{name}"), F.col("counts").alias(f"counts_{name}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            sides = [batch.column(c) for c in ("grams_a", "counts_a", "grams_b", "counts_b")]
            near = [similarity(_one(w[0].as_py(), w[1].as_py()), _one(w[2].as_py(), w[3].as_py())) >= least for w in zip(*sides, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    met = pairs.join(of("b"), "b").join(of("a"), "a")
    return stable(met.select("a", "b", "grams_a", "counts_a", "grams_b", "counts_b").mapInArrow(run, "a bigint, b bigint"))


def _next_pairs(members: DataFrame, turn: int, least: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) to compare now, and members of buckets that need a further round.

    ``members`` has (bucket, node, bounds, degree, class), ``degree`` the number of a node's buckets. In buckets of more than one class the centres of this round are paired with members of
    other classes, and are through: in the first round the node that is in most buckets, as the others of a group of copies
    are most like that one, then some that a hash chooses from all but the largest class, whose members need no comparison with each other. Small
    buckets are finished. Pairs that their bounds rule out are none.
    """
    parts = members.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"), F.max("degree").alias("degree"))
    sizes = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes"), F.max("n").alias("most"), F.max_by("class", F.struct("n", "degree", "class")).alias("largest"))
    met = members.join(sizes.where("classes > 1"), "bucket")
    outside = F.col("class") != F.col("largest")
    if turn:
        drawn = outside & (F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 30)) < F.lit(float(CENTRES << 29 + turn)) / (F.col("n") - F.col("most")))
    else:
        drawn = ~outside
    chosen = stable(met.select("bucket", "node", "bounds", "degree", "class", F.when(F.col("n") <= SMALL_BUCKET, outside).otherwise(drawn).alias("centre"), (F.col("n") > SMALL_BUCKET).alias("large")))
    # The members of a large bucket go to several tasks, and its centres to each of them.
    salt = F.when(F.col("large"), F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(0)
    salts = F.explode(F.sequence(F.lit(0), F.when(F.col("large"), SALTS - 1).otherwise(0)))
    centres = chosen.where("centre").select(F.col("bucket").alias("other_bucket"), salts.alias("other_salt"), F.col("node").alias("other"), F.col("class").alias("other_class"), F.col("bounds").alias("other_bounds"))
    x, y = F.col("bounds"), F.col("other_bounds")
    # So many components may differ in the four bits kept; one in sixteen of those that differ does not there.
    most = (1 - (least - MARGIN)) * 15 / 16 * BANDS * ROWS
    repeats = (x["heaviest"] > 1) | (y["heaviest"] > 1)
    alike = repeats | (differing(x["signature"], y["signature"]) <= most)
    possible = F.coalesce(_possible(x, y, least) & _possible(y, x, least) & alike, F.lit(True))
    apart = (F.col("class") != F.col("other_class")) & (~F.col("centre") | (F.col("node") < F.col("other")))
    met = chosen.withColumn("salt", salt).join(centres, (F.col("bucket") == F.col("other_bucket")) & (F.col("salt") == F.col("other_salt")) & apart & possible)
    pairs = met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    return pairs, chosen.where("large and not centre").select("bucket", "node", "bounds", "degree")


def _merged(members: DataFrame) -> DataFrame:
    """Large buckets with the same largest class as one, so that two nodes meet in it once."""
    parts = members.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"))
    largest = parts.groupBy("bucket").agg(F.max_by("class", F.struct("n", "class")).alias("largest"))
    named = members.join(largest, "bucket").groupBy(F.col("largest").alias("bucket"), "node")
    return stable(named.agg(F.any_value("bounds").alias("bounds"), F.any_value("degree").alias("degree"), F.any_value("class").alias("class")))


def _bounded(members: DataFrame, nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Members (bucket, node, bounds, degree) without those that no other member of a large bucket can be similar to.

    Bounds hold among the nodes of large buckets, and are NULL in the others.
    """
    sizes = members.groupBy("bucket").agg((F.count(F.lit(1)) > SMALL_BUCKET).alias("wide"))
    marked = stable(members.join(sizes, "bucket"))
    crowded = marked.where("wide").select("node").distinct()
    found = _bounds(sets.join(crowded, "node", "left_semi")).join(nodes.select("node", "signature"), "node")
    named = found.select("node", F.struct("n", "own", "mass", "own_mass", "heaviest", "signature").alias("found"))
    bounds = F.when(F.col("wide"), F.col("found"))
    alone = F.struct(F.lit(0).alias("own"), F.lit(0.0).alias("own_mass"), F.lit(1.0).alias("heaviest"))
    degrees = members.groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    out = marked.join(named, "node", "left").join(degrees, "node").select("bucket", "node", bounds.alias("bounds"), "degree")
    return stable(out.where(F.coalesce(_possible(F.col("bounds"), alone, least), F.lit(True))))


def _joined(classes: DataFrame | None, links: DataFrame) -> DataFrame:
    """Classes (node, class) after further links; a node without a row is a class of its own."""
    if classes is None:
        return stable(components(links).withColumnRenamed("least", "class"))
    of = lambda name: classes.select(F.col("node").alias(name), F.col("class").alias(f"class_{name}"))
    lifted = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("class_a", "a").alias("a"), F.coalesce("class_b", "b").alias("b"))
    moved = stable(components(lifted))
    kept = classes.join(moved.withColumnRenamed("node", "class"), "class", "left").select("node", F.coalesce("least", "class").alias("class"))
    # Nodes that had no row so far are those of the new links that were classes themselves.
    new = moved.withColumnRenamed("least", "class").join(classes.select("node"), "node", "left_anti")
    return stable(kept.unionByName(new))


def near_duplicate_classes(documents: DataFrame, id: str = "doc_id", text: str = "text", least: float = LEAST_SIMILARITY) -> DataFrame:
    """For each document row: (id, key, class_id, n_class, first_key).

    ``class_id`` is the smallest id of the documents that links connect, ``n_class`` their number and ``first_key`` the key (see
    :func:`row_key`) of one with that id. Two documents are linked if they have the same words, or if their probability Jaccard or their
    plain Jaccard of five-word shingles is ``least`` or more. Words are lower-cased runs of digits, letters and characters
    beyond ASCII; a text of fewer than five is one shingle. NULL, empty and other texts without words are each a class of their own.
    NULL ids come last: a class of such documents has a NULL id. An empty table gives no rows; other columns are not looked at.
    """
    read = signatures(documents, id, text)
    nodes = stable(
        read.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min("key").alias("key"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    members = _members(nodes)
    sets = _shingle_sets(documents, nodes.join(members.select("node").distinct(), "node", "left_semi").select("key", "node"), id, text)

    classes = tested = None
    waiting, turn = _bounded(members, nodes, sets, least), 0
    while not waiting.isEmpty():
        # Which class a member is in so far.
        if classes is None:
            known = waiting.withColumn("class", F.col("node"))
        else:
            known = waiting.join(classes, "node", "left").select("bucket", "node", "bounds", "degree", F.coalesce("class", "node").alias("class"))
        pairs, rest = _next_pairs(_merged(known) if turn == 1 else known, turn, least)
        pairs = stable(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        if not pairs.isEmpty():
            links = _verified(pairs, sets, least)
            tested = pairs if tested is None else tested.union(pairs)
            if not links.isEmpty():
                classes = _joined(classes, links)
        old, waiting, turn = waiting, stable(rest), turn + 1
        release(old)
    named = nodes.select("digest", "node")
    if classes is not None:
        named = named.join(classes, "node", "left").select("digest", F.coalesce("class", "node").alias("node"))
    placed = read.select("__id", "key", "digest").join(named, "digest", "left")
    # Rows without words have a class each.
    group = F.when(F.col("node").isNotNull(), F.col("node").cast("string")).otherwise(F.concat(F.lit("empty "), F.monotonically_increasing_id()))
    placed = stable(placed.select("__id", "key", group.alias("group")))
    firsts = stable(placed.groupBy("group").agg(F.min(F.struct(F.col("__id").isNull().alias("last"), "__id", "key")).alias("first"), F.count(F.lit(1)).alias("n_class")))
    # A class with more than a thousandth of all rows, of which there are fewer than a thousand, is joined in several tasks.
    large = F.col("n_class") > placed.count() // 1000 + SMALL_BUCKET
    salts = F.explode(F.sequence(F.lit(0), F.when(large, SALTS - 1).otherwise(0)))
    spread = F.when(F.col("large"), F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).otherwise(0)
    named = F.broadcast(firsts.where(large).select("group", F.lit(True).alias("large")))
    salted = placed.join(named, "group", "left").withColumn("salt", spread)
    return salted.join(firsts.withColumn("salt", salts), ["group", "salt"]).select(F.col("__id").alias(id), "key", F.col("first.__id").alias("class_id"), "n_class", F.col("first.key").alias("first_key"))


def keep_one_of_each(documents: DataFrame, id: str = "doc_id", text: str = "text", least: float = LEAST_SIMILARITY) -> DataFrame:
    """The document of the smallest id of each class, all columns as they were; of rows equal in id and text one."""
    classes = near_duplicate_classes(documents, id, text, least)
    key, n = free_name(documents, "__key"), free_name(documents, "__n")
    same = W.partitionBy(key).orderBy(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in documents.columns]))
    firsts = classes.select(F.col("first_key").alias(key)).distinct()
    kept = documents.withColumn(key, row_key(id, text)).join(firsts, key, "left_semi").withColumn(n, F.row_number().over(same))
    return kept.where(F.col(n) == 1).select(*[f"`{c}`" for c in documents.columns])

"""Removal of repeated runs of lines, by a suffix array over sequences of line ids.

The corpus is one long sequence of lines, in the order of document ids, with a gap after each document.
Prefix doubling ranks all suffixes by their first line, then by their first two, four, eight lines and so
on: a rank for 2k lines comes from the ranks of a suffix and of the one k lines on. Suffixes whose
first lines occur once are put aside at once, so a round works on what is repeated. Intervals of suffixes with a
common prefix are then followed from the longest doubling down to single lines: each suffix is
led into the longest interval that also holds an earlier one. That prefix is the longest run of lines from there
that the corpus has before, and such later copies are deleted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyload.llm.texts import free_name, map_texts, pieces, row_key
from skyload.session import release, stable

# A run of fewer words is left in place.
LEAST_WORDS = 50


def line_positions(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines that hold a word, as (key, at, pos, line): ``at`` counts them in a document, ``pos`` in the corpus.

    Documents go by id, NULL last, those of one id by their digest; rows that agree in id and text are one here.
    Positions follow this order, those of a document without gaps, and a gap comes after each document.
    """

    def compute(texts: pa.Array) -> list[pa.Array]:
        out = []
        for body in texts.to_pylist():
            lines = (body or "").encode().split(b"\n")
            # The last entry stands for the gap.
            out.append([hashlib.md5(line).digest() for line in lines if line.strip()] + [None])
        return [pa.array(out, pa.list_(pa.binary()))]

    read = map_texts(documents, compute, {"lines": "array<binary>"}, text, [F.col(f"`{id}`").alias("__id"), row_key(id, text).alias("key")])
    order = [F.col("__id").asc_nulls_last(), F.col("key")]
    line = read.dropDuplicates(["key"]).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = line.select("key", F.posexplode("lines").alias("at", "line")).withColumn("pos", F.monotonically_increasing_id())
    return stable(placed.where(F.col("line").isNotNull()))


def _ranked(groups: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys with a rank: numbers in the order of the keys."""
    return stable(groups.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*keys, F.monotonically_increasing_id().alias("rank")))


def _repeated(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)


def suffix_ranks(lines: DataFrame) -> list[DataFrame]:
    """Ranks of suffixes (pos, rank) by their first 1, 2, 4, ... lines, of those that share these lines with another one.

    Equal ranks mean equal lines, and ranks compare as the lines' ids do.
    """
    ids = _ranked(_repeated(lines, "line"), "line")
    levels = [stable(lines.join(ids, "line").select("pos", "rank"))]
    release(ids)
    while not levels[-1].isEmpty():
        last, reach = levels[-1], 2 ** (len(levels) - 1)
        on = last.select((F.col("pos") - reach).alias("pos"), F.col("rank").alias("second"))
        pairs = stable(last.withColumnRenamed("rank", "first").join(on, "pos"))
        ranks = _ranked(_repeated(pairs, "first", "second"), "first", "second")
        levels.append(stable(pairs.join(ranks, ["first", "second"]).select("pos", "rank")))
        release(pairs)
        release(ranks)
    return levels[:-1]


def earlier_runs(levels: list[DataFrame]) -> DataFrame:
    """For each position the longest run of lines from there that also starts earlier: (pos, length).

    An interval (length, first) is all suffixes that share ``length`` lines, named by its first position. Going down
    the doublings, the members of an interval that agree in the next lines move into a longer one. The
    first of them is no copy there: it goes on in the old interval, and its second row only stands as the earlier
    copy in the new one. All the members that moved need no other row in the old interval, since
    the first of them shares as many lines with anything left there.
    """
    state = stable(levels[0].select("pos", F.lit(0).cast("bigint").alias("length"), F.lit(-1).cast("bigint").alias("first"), F.lit(False).alias("stands")))
    for k in reversed(range(len(levels))):
        next_lines = levels[k].select(F.col("pos").alias("__next"), "rank")
        met = stable(state.join(next_lines, F.col("pos") + F.col("length") == F.col("__next"), "left").drop("__next"))
        group = ["length", "first", "rank"]
        longer = met.where(F.col("rank").isNotNull()).groupBy(*group).agg(F.min("pos").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        # Rows that share no further lines stay as they are, and would be one key of the join.
        both = met.where(F.col("rank").isNotNull()).join(longer, group, "left").unionByName(met.where(F.col("rank").isNull()).withColumn("least", F.lit(None).cast("bigint")))
        stays = F.struct("pos", "length", "first", "stands")
        new_length = (F.col("length") + 2**k).alias("length")
        moves = F.struct("pos", new_length, F.col("least").alias("first"), (F.col("pos") == F.col("least")).alias("stands"))
        rows = F.when(F.col("least").isNull(), F.array(stays)).when(F.col("pos") == F.col("least"), F.array(stays, moves)).otherwise(F.array(moves))
        old, state = state, stable(both.select(F.explode(rows).alias("r")).select("r.*"))
        release(old)
        release(met)
    return state.where(~F.col("stands") & (F.col("length") > 0)).select("pos", "length")


def _delete(body: str, runs: list[dict], copy: bool, least_words: int) -> tuple[str, int, int, list[str]]:
    """What is left of a text, how many lines that hold a word it had and lost, and the runs deleted."""
    lines = body.split("\n")
    held = [i for i, line in enumerate(lines) if line.encode().strip()]
    words = [0]
    for i in held:
        words.append(words[-1] + len(lines[i].encode().split()))
    if copy:  # a later row of the same id and text repeats all of it
        runs = [{"at": 0, "length": len(held)}]
    gone: set[int] = set()
    spans = []
    for run in sorted(runs, key=lambda r: r["at"]):
        first, last = run["at"], run["at"] + run["length"]
        if words[last] - words[first] >= least_words:
            gone.update(held[first:last])
            if spans and first <= spans[-1][1]:
                spans[-1][1] = max(last, spans[-1][1])
            else:
                spans.append([first, last])
    left = "\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else body
    return left, len(held), len(gone), [f"{a}:{b}" for a, b in spans]


def drop_repeated_runs(documents: DataFrame, id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Documents with all their columns, later copies of repeated line runs deleted from the text.

    Adds ``n_lines`` and ``n_deleted`` (lines that hold a word) and ``deleted``, the ranges deleted, counted in such lines, as
    first:end. A run is deleted if it has at least ``least_words`` words and starts earlier in the corpus too: in a document of a
    smaller id, or further up in the same one. Lines are equal if all their characters are; those without a word are neither counted
    nor deleted. Of rows that agree in id and text, one is the first and the others are copies of it. NULL and empty
    texts stay as they are, NULL ids come last, an empty table gives an empty one. Added columns get an
    underscore where the name is taken.
    """
    lines = line_positions(documents, id, text)
    levels = suffix_ranks(lines)
    key = free_name(documents, "__key")
    copies = free_name(documents, "__copy")
    found = free_name(documents, "__runs")
    kind = "array<struct<at:bigint,length:bigint>>"
    if levels:
        runs = stable(earlier_runs(levels).join(lines.select("pos", "key", "at"), "pos").groupBy("key").agg(F.collect_list(F.struct(F.col("at").cast("bigint").alias("at"), "length")).alias(found)).withColumnRenamed("key", key))
    else:
        runs = documents.sparkSession.createDataFrame([], f"`{key}` string, `{found}` {kind}")
    for table in (lines, *levels):
        release(table)
    same = W.partitionBy(key).orderBy(F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in documents.columns]))
    met = documents.withColumn(key, row_key(id, text)).join(runs, key, "left").withColumn(copies, F.row_number().over(same) > 1)
    added: dict[str, str] = {}
    for name, of in (("n_lines", "bigint"), ("n_deleted", "bigint"), ("deleted", "string")):
        added[free_name(documents, name)] = of
    names = documents.columns
    types = {f.name: f.dataType.simpleString() for f in documents.schema} | {text: "string"} | added
    at = names.index(text)
    # The text comes last, for the pieces.
    sent = met.select(*[F.col(f"`{c}`") for c in names if c != text], found, copies, F.col(f"`{text}`").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                *carried, marked, copied, bodies = piece.columns
                rows = [
                    (None, 0, 0, []) if body is None else _delete(body, some or [], copy, least_words)
                    for body, some, copy in zip(bodies.to_pylist(), marked.to_pylist(), copied.to_pylist(), strict=True)
                ]
                carried.insert(at, pa.array([r[0] for r in rows], pa.string()))
                made = [pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([",".join(r[3]) for r in rows], pa.string())]
                yield pa.RecordBatch.from_arrays(carried + made, names=list(types))

    return sent.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in types.items()))


def without_emptied(cleaned: DataFrame, deleted: Column, text: str = "text") -> DataFrame:
    """Documents that have a word left, and those that had nothing deleted."""
    return cleaned.where((deleted == 0) | F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"))

"""Benchmark decontamination by winnowing.

A text's fingerprints are the smallest hash of the word k-grams in each window of w neighbouring
k-grams. Two texts that share a span of k + w - 1 words share its window of k-grams, hence its
smallest hash: with k = 6 and w = 5 no shared span of ten words is missed. Fingerprints of documents
are joined with those of benchmark items, and a hit is extended to the ten words around it, which must
be equal word for word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyload.llm.texts import Words, free_name, key_filter, map_texts, may_hold, row_key, run_hashes
from skyload.session import stable

_WINDOWS = "array<struct<size:int,at:bigint,fingerprint:bigint,words:string>>"


def gram_size(span: int) -> int:
    """Words of a k-gram for shared spans of ``span`` words: about three fifths of it, 6 for 10."""
    return (3 * span + 4) // 5


def _fingerprints(words: Words, hashes: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the spans of ``span`` words start, and the fingerprint of each."""
    size = gram_size(span)
    grams, at = run_hashes(hashes, size), words.starts_of(span)
    least = grams[at]
    for i in range(1, span - size + 1):
        least = np.minimum(least, grams[at + i])
    return at, least


def _windows_type() -> pa.DataType:
    return pa.list_(
        pa.struct([("size", pa.int32()), ("at", pa.int64()), ("fingerprint", pa.int64()), ("words", pa.string())])
    )


def benchmark_windows(items: DataFrame, span: int = 10, id: str = "item_id", text: str = "text") -> DataFrame:
    """Windows of benchmark items: (item, size, fingerprint, words).

    A window has ``span`` consecutive words; an item of fewer words, but not none, is one window.
    An item with a NULL id counts as an item with an empty name.
    """

    def compute(texts: pa.Array) -> list[pa.Array]:
        words = Words(texts)
        hashes, out = words.hashes(), [[] for _ in range(len(texts))]
        for size in {min(span, int(n)) for n in np.unique(words.counts) if n}:
            at, least = _fingerprints(words, hashes, size)
            fits = (words.counts[words.row[at]] >= span) if size == span else words.counts[words.row[at]] == size
            for a, f in zip(at[fits].tolist(), least[fits].view(np.int64).tolist(), strict=True):
                row = words.row[a]
                out[row].append((size, a - int(words.first[row]), f, words.run(a, size)))
        return [pa.array(out, _windows_type())]

    item = F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")).alias("item")
    made = map_texts(items, compute, {"windows": _WINDOWS}, text, [item])
    return made.select("item", F.explode("windows").alias("w")).select("item", "w.size", "w.fingerprint", "w.words").distinct()


def document_hits(documents: DataFrame, windows: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents as (id, key, n_words), and benchmark windows in them as (key, size, at, words)."""
    spark = documents.sparkSession
    sizes = [r[0] for r in windows.select("size").distinct().orderBy("size").collect()]  # at most one for each word of a span
    held = spark.sparkContext.broadcast(key_filter(windows.select("fingerprint").distinct()))

    def compute(texts: pa.Array) -> list[pa.Array]:
        words, bitmap = Words(texts), held.value
        hashes, out = words.hashes(), [[] for _ in range(len(texts))]
        for size in sizes:
            at, least = _fingerprints(words, hashes, size)
            known = may_hold(bitmap, least)
            for a, f in zip(at[known].tolist(), least[known].view(np.int64).tolist(), strict=True):
                row = words.row[a]
                out[row].append((size, a - int(words.first[row]), f, words.run(a, size)))
        return [pa.array(words.counts, pa.int64()), pa.array(out, _windows_type())]

    fields = {"n_words": "bigint", "windows": _WINDOWS}
    read = stable(map_texts(documents, compute, fields, text, [F.col(f"`{id}`").alias("__id"), row_key(id, text).alias("key")]))
    likely = read.where(F.size("windows") > 0).dropDuplicates(["key"]).select("key", F.explode("windows").alias("w")).select("key", "w.*")
    known = windows.select("size", "fingerprint", "words").distinct()
    hits = likely.join(known, ["size", "fingerprint", "words"], "left_semi").select("key", "size", "at", "words")
    return read.select("__id", "key", "n_words"), stable(hits)


def _covered(spans: Column) -> Column:
    """Words under at least one of the spans (at, size)."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto"))

    def add(state: Column, span: Column) -> Column:
        end = span["at"] + span["size"]
        new = F.greatest(F.lit(0).cast("bigint"), end - F.greatest(span["at"], state["upto"]))
        return F.struct((state["n"] + new).alias("n"), F.greatest(end, state["upto"]).alias("upto"))

    return F.aggregate(F.array_sort(spans), start, add, lambda s: s["n"])


def contamination(
    documents: DataFrame, items: DataFrame, span: int = 10, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """For each document: n_words, n_hit, n_items, items_sha256, contaminated.

    Words are lower-cased runs of digits, letters and characters beyond ASCII. A word is hit if it lies
    in an occurrence of a window of an item. ``items_sha256`` is of the sorted, comma-joined names of the
    items found. NULL and empty texts have no words; documents that repeat give a row each; a NULL id is
    kept. Without items, or without documents, nothing is hit. Other columns are not looked at.
    """
    windows = stable(benchmark_windows(items, span, item_id, item_text))
    read, hits = document_hits(documents, windows, id, text)
    covered = hits.groupBy("key").agg(_covered(F.collect_set(F.struct(F.col("at"), F.col("size")))).alias("n_hit"))
    found = (
        hits.select("key", "size", "words").distinct().join(windows.select("size", "words", "item"), ["size", "words"])
        .select("key", "item").distinct().groupBy("key").agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    out = read.join(covered, "key", "left").join(found, "key", "left")
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        F.col("__id").alias(id),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.size(items_found).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, items: DataFrame, span: int = 10, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with no word of a benchmark window, all columns as they were, whatever their names.

    NULL and empty texts have no words, so they stay, as do rows with a NULL id and without a hit; rows that repeat go or stay together.
    Without items all documents stay; an empty table gives no rows.
    """
    _, hits = document_hits(documents, stable(benchmark_windows(items, span)), id, text)
    key = free_name(documents, "__key")
    keyed = documents.withColumn(key, row_key(id, text))
    return keyed.join(hits.select(F.col("key").alias(key)).distinct(), key, "left_anti").select(*[f"`{c}`" for c in documents.columns])

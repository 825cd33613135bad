"""Whole texts as arrays: pieces of batches, words, hashes of words and of word runs."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A byte of a word after A-Z is lower-cased: a digit, a letter, or any byte of a character beyond ASCII.
_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IN_WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
WORD = rb"[0-9a-z\x80-\xff]+"

# Texts are worked on in pieces of at most about so many bytes and so many rows, so memory does not grow with a batch.
PIECE_BYTES, PIECE_ROWS = 1 << 18, 1 << 11
# A long text's words are looked for and hashed in steps of so many bytes.
STEP_BYTES = 1 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def row_key(id_column: str, text_column: str) -> Column:
    """Digest of id and text: rows that agree in both are one document."""
    name = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("null"))
    return F.md5(F.concat(name, F.lit("\x00"), F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task; what is free after each goes back to the system, so a worker that waits for its next task holds little."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if trim is not None:
            trim(0)


def map_texts(
    df: DataFrame,
    compute: Callable[[pa.Array], list[pa.Array]],
    fields: dict[str, str],
    text: str,
    carry: list[Column | str],
    text_as: str | None = None,
) -> DataFrame:
    """The columns ``carry`` and what ``compute`` makes of each piece of whole texts, row by row.

    ``fields`` names the columns made, with their types; ``text_as`` carries the text as well, under that name.
    """
    named = df.select(*carry, F.col(f"`{text}`").cast("string").alias(text_as or "__text"))
    types = {f.name: f.dataType.simpleString() for f in (named.schema if text_as else named.schema[:-1])} | fields
    schema = ", ".join(f"`{name}` {kind}" for name, kind in types.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            for piece in pieces(batch):
                made = compute(piece.column(piece.num_columns - 1))
                yield pa.RecordBatch.from_arrays((piece.columns if text_as else piece.columns[:-1]) + made, names=list(types))

    return named.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, limit: int = PIECE_BYTES, rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut a batch, whose last column holds texts, where ``limit`` bytes of text or ``rows`` rows are reached; rows stay whole."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy())
    first = 0
    while first < batch.num_rows:
        done = ends[first - 1] if first else 0
        last = max(first + 1, min(first + rows, int(np.searchsorted(ends, done + limit, side="right"))))
        yield batch.slice(first, last - first)
        first = last


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of some texts, and where each text starts (with a last entry for the end); NULL is empty."""
    column = pc.fill_null(texts, "").cast(pa.large_binary())
    _, starts, data = column.buffers()
    starts = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts - starts[0]


class Words:
    """Words of some texts, as byte ranges: ``first[r]`` to ``first[r + 1]`` are the words of row ``r``."""

    def __init__(self, texts: pa.Array):
        data, starts = text_bytes(texts)
        self.data = LOWER[data]
        begins, ends = [], []
        edge = starts[(starts > 0) & (starts < len(data))]
        for low in range(0, len(data), STEP_BYTES):
            high = min(low + STEP_BYTES, len(data))
            inside = np.zeros(high - low + 2, bool)  # with the neighbours on either side
            inside[1:-1] = IN_WORD[self.data[low:high]]
            inside[0] = low > 0 and IN_WORD[self.data[low - 1]]
            inside[-1] = high < len(data) and IN_WORD[self.data[high]]
            first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
            # Where one text ends and the next one begins, a word does.
            here = edge[np.searchsorted(edge, low) : np.searchsorted(edge, high)] - low
            first[here] = inside[1:-1][here]
            here = edge[np.searchsorted(edge, low + 1) : np.searchsorted(edge, high, side="right")] - low - 1
            last[here] = inside[1:-1][here]
            begins.append((np.flatnonzero(first) + low).astype(np.int32))
            ends.append((np.flatnonzero(last) + low + 1).astype(np.int32))
        self.start = np.concatenate([np.zeros(0, np.int32), *begins])
        self.end = np.concatenate([np.zeros(0, np.int32), *ends])
        self.first = np.searchsorted(self.start, starts)
        self.counts = np.diff(self.first)
        self.row = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same in every process."""
        out = np.zeros(len(self.start), np.uint64)
        at = 0
        while at < len(out):
            low = int(self.start[at])
            upto = max(at + 1, int(np.searchsorted(self.end, low + STEP_BYTES, side="right")))
            some = self.data[low : int(self.end[upto - 1])]
            sums = np.zeros(len(some) + 1, np.uint64)
            np.cumsum((some.astype(np.uint64) + np.uint64(1)) * np.cumprod(np.full(len(some), BASE)), out=sums[1:])
            inverse = np.cumprod(np.full(len(some), BASE_INVERSE))
            start = self.start[at:upto] - low
            out[at:upto] = mix((sums[self.end[at:upto] - low] - sums[start]) * inverse[start])
            at = upto
        return out

    def starts_of(self, size: int) -> np.ndarray:
        """Words at which a run of ``size`` words of one text starts."""
        at = np.arange(max(0, len(self.start) - size + 1))
        return at[at + size <= self.first[self.row[at] + 1]]

    def run(self, at: int, size: int) -> str:
        """The words from ``at`` on, with single blanks."""
        return b" ".join(
            self.data[s:e].tobytes() for s, e in zip(self.start[at : at + size], self.end[at : at + size], strict=True)
        ).decode("utf-8", "replace")


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbours, across texts as well."""
    count = max(0, len(hashes) - size + 1)
    out = np.zeros(count, np.uint64)
    for i in range(size):
        out = out * BASE + hashes[i : i + count]
    return mix(out)


# Bits of a filter of 64-bit keys that tasks get, at most: 16 MB. Sixteen bits are taken for each key up
# to there; beyond, more rows pass the filter than need to, and the join after it sorts them out.
FILTER_BITS = 1 << 27
LEAST_BITS = 1 << 16


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    spread = mix(keys)
    return spread & np.uint64(bits - 1), (spread >> np.uint64(32)) & np.uint64(bits - 1)


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bitmap with two bits for each key of a table of one bigint column, as 64-bit words."""
    bits = LEAST_BITS
    while bits < min(FILTER_BITS, 16 * keys.count()):
        bits *= 2

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_by_one(batches):
            places = np.concatenate(_places(batch.column(0).to_numpy().view(np.uint64), bits))
            bit = np.uint64(1) << (places & np.uint64(63))
            yield pa.RecordBatch.from_arrays([(places >> np.uint64(6)).view(np.int64), bit.view(np.int64)], names=["block", "bit"])

    held = keys.mapInArrow(blocks, "block bigint, bit bigint").groupBy("block").agg(F.bit_or("bit").alias("bit")).toArrow()
    bitmap = np.zeros(bits // 64, np.uint64)
    bitmap[held.column("block").to_numpy()] = held.column("bit").to_numpy().view(np.uint64)
    return bitmap


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a filter may hold; never leaves one out that it does."""
    held = np.ones(len(keys), bool)
    for place in _places(keys.view(np.uint64), len(bitmap) * 64):
        held &= (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return held

"""Quality rules: counts of words, symbols and repeats, and bands of zstandard compression ratios.

Text that repeats itself compresses far better than prose, and noise far worse. How well prose
compresses depends on its length, so each length has its own band of ratios (raw bytes over compressed
bytes). Whole texts and each of their fixed chunks are compressed; chunks show a repetitive or
random stretch inside a long text that is fine on the whole.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyload.llm.texts import map_texts, text_bytes

# Ratios of raw to compressed size that prose of at most so many bytes keeps to: (bytes, least, most).
BANDS = (
    (256, 0.80, 2.0),
    (512, 1.05, 2.3),
    (1024, 1.15, 2.6),
    (2048, 1.25, 3.0),
    (4096, 1.35, 3.5),
    (16384, 1.45, 4.2),
    (float("inf"), 1.50, 5.0),
)
CHUNK_BYTES = 4096
# Share of a text's chunks that may lie outside the band before the text is rejected.
BAD_CHUNKS = 0.25
LEVEL = 3

FIELDS = {
    "n_words": "bigint",
    "word_chars": "bigint",
    "n_symbols": "bigint",
    "n_dup_lines": "bigint",
    "n_repeat_words": "bigint",
    "ratio": "double",
    "n_chunks": "bigint",
    "n_bad_chunks": "bigint",
    "base_failed": "boolean",
    "kept": "boolean",
}


def repeated_words(words: list[bytes]) -> int:
    """Words in a window of three that occurs at least twice, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    often = Counter(windows)
    if len(often) == len(windows):
        return 0
    inside = np.zeros(len(words), bool)
    for i, window in enumerate(windows):
        if often[window] > 1:
            inside[i : i + 3] = True
    return int(inside.sum())


def in_band(size: int, ratio: float, bands=BANDS) -> bool:
    """Whether a ratio is one of prose of that many bytes."""
    least, most = next((low, high) for upto, low, high in bands if size <= upto)
    return least <= ratio <= most


def quality(documents: DataFrame, id: str = "doc_id", text: str = "text", bands=BANDS, chunk_bytes: int = CHUNK_BYTES, bad_chunks: float = BAD_CHUNKS) -> DataFrame:
    """A row for each document: the counts, ``ratio`` of the whole text, its chunks, base_failed, kept.

    Words are runs of anything but blank, tab, line ends, vertical tab and form feed. Base rules fail
    texts under 50 words, or with more than half of their words in repeated windows of three. Of the others
    a text is kept if its whole ratio lies in the band of its length and at most ``bad_chunks`` of its
    chunks do not. A last chunk shorter than half a chunk counts with the one before. NULL and empty texts have no words and
    a ratio of 0, and fail; repeated rows give a row each; a NULL id is kept; other columns are not looked at.
    """
    def compute(texts: pa.Array) -> list[pa.Array]:
        space, symbol = np.zeros(256, bool), np.zeros(256, bool)
        space[[0x20, *range(0x09, 0x0E)]] = True
        symbol[list(b"#*$%&|<>")] = True
        press = zstandard.ZstdCompressor(level=LEVEL)
        data, starts = text_bytes(texts)
        out: list[tuple] = []
        for first, last in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            part = data[first:last]
            raw = part.tobytes()
            words = raw.split()
            lines = [line for line in raw.split(b"\n") if line.strip()]
            repeats = repeated_words(words)
            failed = len(words) < 50 or 100 * repeats > 50 * len(words)
            ratio = len(raw) / len(press.compress(raw)) if raw else 0.0
            cuts = [*range(0, len(raw), chunk_bytes)]
            if len(cuts) > 1 and len(raw) - cuts[-1] < chunk_bytes // 2:
                cuts.pop()
            chunks = [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)], strict=False)]
            bad = 0
            for chunk in chunks if len(chunks) > 1 else []:
                bad += not in_band(len(chunk), len(chunk) / len(press.compress(chunk)), bands)
            fine = bool(raw) and in_band(len(raw), ratio, bands) and bad <= bad_chunks * len(chunks)
            characters = (part & 0xC0) != 0x80
            out.append(
                (len(words), int((characters & ~space[part]).sum()), int(symbol[part].sum()), len(lines) - len(set(lines)), repeats,
                 ratio, len(chunks), bad, failed, not failed and fine)
            )
        types = (pa.int64(),) * 5 + (pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
        return [pa.array([row[i] for row in out], kind) for i, kind in enumerate(types)]

    return map_texts(documents, compute, FIELDS, text, [F.col(f"`{id}`")])

"""Packing by sum of squares: documents become sequences of equal length with hardly any padding.

A task places its documents one after the other, as they come. A document goes into the open window, or a new one,
that leaves the smallest sum of squares over the counts of open windows by fill level: levels with many windows
give some up, and levels that are rare do not gain any without need. The counts are an array with one entry per level, so the
choice is one pass over it. Windows that get full are written.

A bounded number of windows is open. Beyond it, and at a task's end, the emptiest are taken apart, and their pieces
fill the others up; what is left over at the end goes to sequences whose lengths are powers of two, which
need no padding.
"""

from __future__ import annotations

import json
import os
import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyload.llm.texts import one_by_one, pieces
from skyload.session import stable

WINDOW = 2048
END_OF_DOCUMENT = 1
VOCABULARY = "word_bpe_49k.json"
# Open windows of a task, at most: with 2048 tokens of four bytes each 16 MB.
MOST_OPEN = 2048
# Words whose ids a task remembers, twice: when there are so many new ones, those not met since the last time are forgotten.
REMEMBERED = 1 << 17
# A text is cut at white space after so many characters, so that memory does not grow with its length.
BLOCK_CHARS = 1 << 18
# Bytes and rows of texts whose words are looked up at once: a word is looked up once for each of these.
PIECE_BYTES, PIECE_ROWS = 1 << 22, 4096
# Words of letters that go through the tokenizer as one text.
JOINED = 128
# Pieces of one batch that a task hands over.
BATCH_PIECES = 1024


# What a byte is: a blank, an ASCII letter or digit, the second byte of a Latin letter whose first byte is 0xC3, that byte, a mark.
_BLANKS = b" \t\n\r"
_BLANK, _ALNUM, _LATIN, _FIRST, _MARK = 1, 2, 4, 8, 16
_KINDS = bytearray(256)
for _kind, _chars in (
    (_BLANK, _BLANKS), (_ALNUM, bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B))),
    (_LATIN, bytes(b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7))), (_FIRST, b"\xc3"), (_MARK, b".,;:!?"),
):
    for _char in _chars:
        _KINDS[_char] = _kind
_KINDS = bytes(_KINDS)


class WordIds:
    """Token ids of texts, word by word, from a tokenizer whose words end with a suffix and do not reach across white space."""

    _LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
    _CUT = re.compile(r"[ \t\n\r]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        # A task has one core; threads of its own would also hold memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        suffix = self.tokenizer.model.end_of_word_suffix
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(names.values()) + 1, bool)
        # Words of Latin letters, in lower case, need the model and its bytes only; where one ends is told by the suffix.
        self.plain = None
        with open(path, encoding="utf-8") as file:
            steps = json.load(file)
        kinds = [[s["type"] for s in (steps[k] or {}).get(many, [])] for k, many in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        if suffix and kinds == [["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]]:
            self.ends[[i for name, i in names.items() if name.endswith(suffix)]] = True
            self.plain = Tokenizer(self.tokenizer.model)
            letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), letters])
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        known, joined = self.known, JOINED
        known.update((w, self.before[w]) for w in words if w in self.before)
        words = [w for w in words if w not in known]
        plain = {w: w.lower() for w in words if self._LETTERS.fullmatch(w)} if self.plain else {}
        new = [w for w in dict.fromkeys(plain.values()) if w not in known]
        texts = [new[at : at + joined] for at in range(0, len(new), joined)]
        for some, made in zip(texts, self.plain.encode_batch_fast([" ".join(t) for t in texts], add_special_tokens=False) if texts else [], strict=True):
            ids = np.array(made.ids, "<u4")
            cuts, flat = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist(), ids.tobytes()
            if len(cuts) == len(some):
                known.update(zip(some, [flat[a:b] for a, b in zip([0, *cuts], cuts, strict=False)], strict=True))
        known.update((w, known[low]) for w, low in plain.items() if low in known)
        rest = [w for w in words if w not in known]
        for word, made in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[word] = np.array(made.ids, "<u4").tobytes()

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text.

        Texts are cut at white space, and between a letter or digit and a mark, where the tokenizer splits anyway.
        """
        parts = [text.encode() for text in texts]
        data = b"\n".join(parts)
        # Each byte is of one kind; strings translate and drop bytes faster than arrays do.
        kind = np.frombuffer(data.translate(_KINDS), np.uint8)
        inside = kind != _BLANK
        alone = np.r_[True, ~inside[:-1]]
        alnum = kind == _ALNUM
        alnum[1:] |= (kind[1:] == _LATIN) & (kind[:-1] == _FIRST)
        alone[1:] |= alnum[:-1] & (kind[1:] == _MARK)
        start = np.flatnonzero(alone[: len(kind)] & inside)
        before = np.cumsum(inside, dtype=np.int32)
        offsets = np.r_[before[start] - 1, before[-1:]].astype(np.int32)
        letters = pa.py_buffer(data.translate(None, _BLANKS))
        words = pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(offsets), letters]).dictionary_encode()
        kinds, which = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy()
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        self._learn([w for w in kinds if w not in self.known])
        made = [self.known[w] for w in kinds]
        length = np.array([len(m) // 4 for m in made], np.int64)
        first = np.cumsum(length) - length
        size = length[which]
        ends = np.cumsum(size)
        ids = np.frombuffer(b"".join(made), "<u4")[np.repeat(first[which] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        text_ends = np.cumsum([len(p) + 1 for p in parts])
        upto = np.r_[0, ends][np.searchsorted(start, text_ends[:-1])]
        return np.split(ids, upto)

    def blocks(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a very long text, in parts."""
        at = 0
        while at < len(text):
            end = self._CUT.search(text, at + BLOCK_CHARS)
            last = end.start() if end else len(text)
            yield self.of([text[at:last]])[0]
            at = last


@dataclass
class Piece:
    """Some neighbouring tokens of a document; ``total`` holds the document's length once that is known."""

    id: object
    start: int
    tokens: np.ndarray
    total: list[int]

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return Piece(self.id, self.start, self.tokens[:length], self.total), Piece(self.id, self.start + length, self.tokens[length:], self.total)


class Packer:
    """Windows of ``size`` tokens, filled one document after the other; ``done`` holds the sequences that are complete."""

    def __init__(self, size: int = WINDOW, most_open: int = MOST_OPEN):
        self.size, self.most_open = size, most_open
        # How many windows are open at each fill level; neither empty nor full windows count.
        self.levels = np.zeros(size + 1, np.int64)
        self.open: list[deque[list[Piece]]] = [deque() for _ in range(size)]
        self.done: list[list[Piece]] = []

    def level_for(self, length: int) -> int:
        """Fill level, 0 for a new window, at which ``length`` tokens leave the least sum of squares; of equal ones the fullest."""
        before, after = self.levels[: self.size - length + 1], self.levels[length:]
        change = np.where(before > 0, 2 * (after - before) + 2, np.iinfo(np.int64).max)
        change[0] = 2 * after[0] + 1
        if length < self.size and before[-1]:
            change[-1] = 1 - 2 * before[-1]
        return len(change) - 1 - int(change[::-1].argmin())

    def place(self, piece: Piece) -> None:
        """Put a piece of 1 to ``size`` tokens into a window."""
        length = len(piece.tokens)
        if length == self.size:
            self.done.append([piece])
            return
        level = self.level_for(length)
        window = self.open[level].popleft() if level else []
        self.levels[level] -= level > 0
        window.append(piece)
        self._put(window, level + length)
        if self.levels.sum() > self.most_open:
            self.settle(last=False)

    def _put(self, window: list[Piece], level: int) -> None:
        if level == self.size:
            self.done.append(window)
        elif level:
            self.open[level].append(window)
            self.levels[level] += 1

    def settle(self, last: bool = True) -> None:
        """Take the emptiest windows apart to fill up the others; the rest stays open or, at the ``last``, is cut into powers of two."""
        level_of = np.repeat(np.arange(self.size, 0, -1), self.levels[:0:-1])
        windows = [w for level in range(self.size - 1, 0, -1) for w in self.open[level]]
        total = int(level_of.sum())
        full = total // self.size
        loose = deque(p for w in windows[full:] for p in w)

        def take(length: int) -> list[Piece]:
            out = []
            while length:
                piece = loose.popleft()
                if len(piece.tokens) > length:
                    piece, rest = piece.cut(length)
                    loose.appendleft(rest)
                out.append(piece)
                length -= len(piece.tokens)
            return out

        for window, level in zip(windows[:full], level_of[:full].tolist(), strict=True):
            self.done.append(window + take(self.size - level))
        self.levels[:] = 0
        self.open = [deque() for _ in range(self.size)]
        rest = total - full * self.size
        if not last:
            self._put(take(rest), rest)
            return
        for bit in range(rest.bit_length() - 1, -1, -1):
            if rest >> bit & 1:
                self.done.append(take(1 << bit))


def pack(
    documents: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: int = WINDOW,
    vocabulary: str | None = None,
    end: int = END_OF_DOCUMENT,
    most_open: int = MOST_OPEN,
) -> DataFrame:
    """Pieces of all documents: (id, start, length, tokens, doc_tokens, sequence_id, offset).

    A document is the ids of its whole text by the tokenizer in the file ``vocabulary`` and the id ``end``; NULL is empty, so it
    is ``end`` alone. ``tokens`` are the piece's ids, four bytes each, lowest byte first; ``start`` counts the document's ids before it, and
    ``offset`` those before it in its sequence, which has no gaps. Documents longer than ``size`` fill sequences of their own, and the rest of
    them is placed like a shorter document. All sequences have ``size`` tokens but at most one of each lower power of two for
    each task. Each row is a document of its own, whether its id repeats or is NULL; a table without rows gives
    none; other columns are not looked at. Of a very long text, blocks of some 200,000 characters are in memory at a time.
    The rows are stored, as their sequences depend on how the table was partitioned.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = documents.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset"]
    schema = f"id {kind}, start bigint, length bigint, tokens binary, doc_tokens bigint, sequence_id bigint, offset bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, ids = Packer(size, most_open), WordIds(path)
        written, type_of_id = TaskContext.get().partitionId() << 40, pa.null()
        out: list[tuple] = []

        def flush(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal written
            for sequence in packer.done:
                offset = 0
                for p in sequence:
                    out.append((p.id, p.start, len(p.tokens), p.tokens.tobytes(), p.total[0], written, offset))
                    offset += len(p.tokens)
                written += 1
            packer.done = []
            while out and len(out) >= least:
                some = out[:BATCH_PIECES]
                del out[:BATCH_PIECES]
                kinds = [type_of_id, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*some, strict=True), kinds, strict=True)], names=names)

        for batch in one_by_one(batches):
            type_of_id = batch.schema.field(0).type
            for piece in pieces(batch, PIECE_BYTES, PIECE_ROWS):
                names_of, texts = piece.column(0).to_pylist(), [t or "" for t in piece.column(1).to_pylist()]
                if len(texts) == 1 and len(texts[0]) > BLOCK_CHARS:
                    _pack_one(packer, names_of[0], ids.blocks(texts[0]), size, end)
                else:
                    for name, made in zip(names_of, ids.of(texts), strict=True):
                        _pack_one(packer, name, [made], size, end)
                yield from flush(BATCH_PIECES)
        packer.settle()
        yield from flush(1)

    made = stable(rows.mapInArrow(run, schema))
    return made.select(F.col("id").alias(id), *names[1:])


def _pack_one(packer: Packer, id: object, parts: Iterable[np.ndarray], size: int, end: int) -> None:
    total, start, held = [0], 0, np.zeros(0, "<u4")
    for part in parts:
        held = np.concatenate([held, part])
        while len(held) > size:
            packer.place(Piece(id, start, held[:size], total))
            start, held = start + size, held[size:]
    held = np.append(held, np.uint32(end))
    total[0] = start + len(held)
    while len(held):
        packer.place(Piece(id, start, held[:size], total))
        start, held = start + len(held[:size]), held[size:]

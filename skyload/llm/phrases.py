"""Phrase collocations, counted in HAT-tries.

Words become 64-bit ids. A task counts phrases in a trie that branches on the ids of their first words and keeps what
follows in hash containers; a container that gets large bursts into a branch for each next word. When a task holds many phrases, its
largest subtrees are written as sorted runs and dropped. Runs are dealt into buckets by prefix, which is the phrase but for most bits of its last
word, so that what follows a very frequent word is spread, and the counts of equal phrases are added up there.

Words are counted first. No phrase is more frequent than a part of it, so pairs are only looked at where both words are frequent enough, and
longer phrases where all pairs are. Most of them are rare still, and a row for each would be most of the work. So it is first counted
how often phrases fall into each of 2^40 slots, pairs and then those of three to five words: a task writes its slots as sorted gaps of a few
bytes. Only phrases whose slots are frequent are counted in tries. A filter of bounded size tells those; one that it or its slot lets
through in error is found rare when it is counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyload.llm.texts import LOWER, key_filter, may_hold, mix, one_by_one, pieces
from skyload.session import in_task, release, stable, to_tasks

LONGEST = 5
LEAST_COUNT = 100
UNKNOWN = "und"
FIRST = 2000
# Entries of a container that bursts, and of a trie whose largest subtrees are written.
BURST, MOST_ENTRIES = 1 << 13, 1 << 19
ID = 8  # bytes of a word's id
# Bytes of text whose phrases are counted before they go into the trie.
BLOCK_BYTES = 1 << 20
# Copies of the table of words, and parts of each language's phrases.
SALTS = 16
# Bits of a phrase's key that are its slot, slots that a task collects before it writes them, and words of text for a bucket of slots.
SLOT_BITS, MOST_SLOTS, BUCKET_WORDS = 40, 1 << 21, 1 << 20
# Slots are counted up to here in a task.
MOST_COUNT = 255

# A byte is of a word, a blank within a piece, or ends a piece.
_WORD, _BLANK, _END = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _END


@dataclass
class Branch:
    """A node of the trie below which containers go by one more word."""

    below: dict[bytes, dict[bytes, int]] = field(default_factory=dict)


class HatTrie:
    """Counts of phrases, which are word ids of ``ID`` bytes one after the other."""

    def __init__(self, burst: int = BURST, most: int = MOST_ENTRIES):
        self.burst, self.most = burst, most
        self.root: dict[bytes, dict[bytes, int] | Branch] = {}

    def add(self, phrases: list[bytes], counts: list[int]) -> None:
        root = self.root
        for phrase, n in zip(phrases, counts, strict=True):
            node = root.get(phrase[:ID])
            if node is None:
                node = root[phrase[:ID]] = {}
            rest = phrase[ID:]
            if type(node) is Branch:
                rest, next_word, node = phrase[2 * ID :], phrase[ID : 2 * ID], node.below
                node = node.get(next_word) if next_word in node else node.setdefault(next_word, {})
            node[rest] = node.get(rest, 0) + n

    def _burst(self) -> None:
        for word, node in self.root.items():
            if type(node) is dict and len(node) > self.burst:
                grown = Branch()
                for rest, n in node.items():
                    grown.below.setdefault(rest[:ID], {})[rest[ID:]] = n
                self.root[word] = grown

    def _sizes(self) -> dict[bytes, int]:
        return {w: sum(map(len, node.below.values())) if type(node) is Branch else len(node) for w, node in self.root.items()}

    def _run(self, word: bytes) -> Iterator[tuple[bytes, int]]:
        node = self.root.pop(word)
        for path, container in sorted(node.below.items()) if type(node) is Branch else [(b"", node)]:
            for rest in sorted(container):
                yield word + path + rest, container[rest]

    def spill(self, all: bool = False) -> Iterator[tuple[list[bytes], list[int]]]:
        """Burst large containers; then, if there are too many entries, drop the largest subtrees until half are left, as sorted runs."""
        self._burst()
        sizes = self._sizes()
        held, limit = sum(sizes.values()), 0 if all else self.most // 2
        if not all and held <= self.most:
            return
        phrases: list[bytes] = []
        counts: list[int] = []
        for word in sorted(sizes, key=sizes.get, reverse=True):
            if held <= limit:
                break
            held -= sizes[word]
            for phrase, n in self._run(word):
                phrases.append(phrase)
                counts.append(n)
            if len(phrases) >= 1 << 17:
                yield phrases, counts
                phrases, counts = [], []
        if phrases:
            yield phrases, counts


@dataclass
class Block:
    """Words of some text: ``code`` of each into the distinct ones, and the piece that it is in.

    A distinct word is the language ``langs[lang]`` and the bytes of ``known`` at ``word``. Phrases that start at one of the first ``own`` words
    are this block's; others are the next one's.
    """

    langs: list[str]
    known: pa.Array
    lang: np.ndarray
    word: np.ndarray
    code: np.ndarray
    piece: np.ndarray
    own: int

    @cached_property
    def words(self) -> list[tuple[str, str]]:
        """Language and word of each distinct one."""
        text = [w.decode("utf-8", "replace") for w in self.known.to_pylist()]
        return [(self.langs[k], text[w]) for k, w in zip(self.lang.tolist(), self.word.tolist(), strict=True)]

    def ids(self, seed: int) -> np.ndarray:
        """A 64-bit id of each distinct word in its language."""
        return _ids(self.langs, self.lang, self.known.to_pylist(), self.word, seed)


def _ids(langs: list[str], lang: np.ndarray, known: list[bytes], word: np.ndarray, seed: int) -> np.ndarray:
    heads, digest = [f"{name}\0".encode("utf-8", "replace") for name in langs], xxhash.xxh3_64_intdigest
    return np.array([digest(heads[k] + known[w], seed) for k, w in zip(lang.tolist(), word.tolist(), strict=True)], np.uint64)


def _block(data: bytes, row_starts: np.ndarray, langs: list[str], own_bytes: int) -> Block | None:
    """Words of rows joined by line ends."""
    raw = np.frombuffer(data, np.uint8)
    kind = _KIND[raw]
    inside = kind == _WORD
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return None
    offsets = np.r_[0, np.cumsum(end - start)].astype(np.int32)
    letters = LOWER[raw[inside]]
    words = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    kinds, which = np.unique(np.array(langs, object), return_inverse=True)
    row = np.searchsorted(row_starts, start, side="right") - 1
    size = len(words.dictionary)
    both = which[row] * size + words.indices.to_numpy()
    if len(kinds) * size <= 8 * len(both):
        met = np.zeros(len(kinds) * size, bool)
        met[both] = True
        pair, code = np.flatnonzero(met), (np.cumsum(met) - 1)[both]
    else:
        pair, code = np.unique(both, return_inverse=True)
    piece = np.cumsum(kind == _END, dtype=np.int32)[start]
    return Block(kinds.tolist(), words.dictionary, pair // size, pair % size, code, piece, int(np.searchsorted(start, own_bytes)))


_CUT = re.compile(rb"[\x20\x09.,;:!?\n\x0b\x0c\r]")


def blocks(batch: pa.RecordBatch, limit: int = BLOCK_BYTES, longest: int = LONGEST) -> Iterator[Block]:
    """Words of a batch (lang, text), in blocks of ``limit`` bytes about; a longer text is cut into blocks that overlap."""
    for part in pieces(batch, limit):
        langs = [lang if lang is not None else UNKNOWN for lang in part.column(0).to_pylist()]
        texts = [(text or "").encode() for text in part.column(1).to_pylist()]
        if len(texts) == 1 and len(texts[0]) > limit:
            yield from _long(texts[0], langs, limit, longest)
            continue
        starts = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
        data = b"\n".join(texts)
        if (made := _block(data, starts, langs, len(data))) is not None:
            yield made


def _long(text: bytes, langs: list[str], limit: int, longest: int) -> Iterator[Block]:
    start = 0
    while start < len(text):
        found = _CUT.search(text, start + limit)
        own = end = found.start() if found else len(text)
        # As many words more as a phrase that starts at the block's last word can reach.
        for _ in range(longest - 1):
            while end < len(text) and _KIND[text[end]] == _BLANK:
                end += 1
            found = _CUT.search(text, end)
            end = found.start() if found else len(text)
        if (made := _block(text[start:end], np.zeros(1, np.int64), langs, own - start)) is not None:
            yield made
        start = max(own, start + 1)


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def slot(key: np.ndarray) -> np.ndarray:
    return key >> np.uint64(64 - SLOT_BITS)


@dataclass
class Frequent:
    """Filters of what may be frequent: ids of words, slots of pairs and of longer phrases; None lets all through."""

    words: np.ndarray
    pairs: np.ndarray | None = None
    longer: np.ndarray | None = None


def _phrases(block: Block, ids: np.ndarray, frequent: Frequent, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, first words, keys) of the block's phrases of two words, three and so on that may be frequent."""
    known, word = may_hold(frequent.words, ids)[block.code], ids[block.code]
    goes_on = np.zeros(len(word), bool)
    goes_on[:-1] = known[:-1] & known[1:] & (block.piece[:-1] == block.piece[1:])
    at = np.flatnonzero(goes_on)
    key = pair_key(word[at], word[at + 1])
    if frequent.pairs is not None:
        may = may_hold(frequent.pairs, slot(key))
        goes_on[at[~may]] = False
        at, key = at[may], key[may]
    for size in range(2, longest + 1):
        if size > 2:
            # Phrases one word shorter that go on in the same piece with a known pair.
            may = goes_on[at + size - 2]
            at, key = at[may], key[may]
            key = pair_key(key, word[at + size - 1])
            if frequent.longer is not None:
                may = may_hold(frequent.longer, slot(key))
                at, key = at[may], key[may]
        own = int(np.searchsorted(at, block.own))
        yield size, at[:own], key[:own]


def _counted(block: Block, held: np.ndarray, size: int, at: np.ndarray, key: np.ndarray) -> tuple[list[bytes], list[int]]:
    """Distinct phrases and their counts; ``held`` has the id of each word as it is stored."""
    _, first, which, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    spelt = block.code[at[:, None] + np.arange(size)]
    if not (spelt == spelt[first][which]).all():  # two phrases with one key
        first, count = np.arange(len(at)), np.ones(len(at), np.int64)
    flat = held[spelt[first]].tobytes()
    step = size * ID
    return [flat[i : i + step] for i in range(0, len(flat), step)], count.tolist()


def _bucket_bits(phrases: int) -> int:
    """Bits of a bucket's number, so that a bucket holds ``BUCKET_WORDS`` phrases at most on average."""
    return min(SLOT_BITS - 10, max(8, (phrases // BUCKET_WORDS).bit_length()))


def _packed(slots: np.ndarray, bits: int) -> pa.RecordBatch:
    """Slots, with repetitions, as rows (bucket, gaps, counts): a bucket has those that agree in ``bits`` bits, each as its gap to the one before."""
    slots = np.sort(slots)
    first = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]])
    counts = np.minimum(np.diff(np.r_[first, len(slots)]), MOST_COUNT).astype(np.uint8)
    slots = slots[first]
    bucket = slots >> np.uint64(SLOT_BITS - bits)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    gaps = np.diff(slots, prepend=slots[:1])
    gaps[starts] = slots[starts] & np.uint64((1 << (SLOT_BITS - bits)) - 1)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    flat = np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    offsets = np.r_[starts, len(slots)].astype(np.int32)
    cut = lambda data, step: pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets * np.int32(step)), pa.py_buffer(data)])
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts].astype(np.int32)), cut(flat, width), cut(counts, 1)], names=["bucket", "gaps", "counts"])


def _unpacked(bucket: int, gaps: bytes, counts: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots and counts of a row of :func:`_packed`."""
    raw = np.frombuffer(gaps, np.uint8).reshape(len(counts), -1)
    wide = np.zeros((len(counts), 8), np.uint8)
    wide[:, : raw.shape[1]] = raw
    return np.cumsum(wide.view("<u8")[:, 0], dtype=np.uint64) + np.uint64(bucket << (SLOT_BITS - bits)), np.frombuffer(counts, np.uint8)


def frequent_slots(documents: DataFrame, frequent: Frequent, shortest: int, longest: int, least: int, seed: int, words: int) -> DataFrame:
    """Slots (bigint) into which phrases of ``shortest`` to ``longest`` words fall ``least`` times or more, of some ``words`` words of text."""
    held = to_tasks(documents.sparkSession, frequent)
    bits = _bucket_bits((longest - shortest + 1) * words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size, told = [], 0, in_task(held)
        for batch in one_by_one(batches):
            for block in blocks(batch):
                for length, _, key in _phrases(block, block.ids(seed), told, longest):
                    if length >= shortest and len(key):
                        found.append(slot(key))
                        size += len(key)
                if size > MOST_SLOTS:
                    slots, found, size = np.concatenate(found), [], 0
                    yield _packed(slots, bits)
        if found:
            yield _packed(np.concatenate(found), bits)

    def merge(rows: pa.Table) -> pa.Table:
        parts = [_unpacked(*row, bits) for row in zip(*(c.to_pylist() for c in rows.columns), strict=True)]
        slots, counts = (np.concatenate(p) for p in zip(*parts, strict=True))
        # Slot and count in one number, so that one sort brings equal slots together.
        both = np.sort((slots << np.uint64(8)) | counts)
        slots = both >> np.uint64(8)
        first = np.flatnonzero(np.r_[True, slots[1:] != slots[:-1]])
        total = np.add.reduceat((both & np.uint64(255)).astype(np.int64), first)
        return pa.table({"slot": pa.array(slots[first[total >= min(least, MOST_COUNT)]].view(np.int64))})

    packed = documents.mapInArrow(run, "bucket int, gaps binary, counts binary")
    merged = stable(packed.groupBy("bucket").applyInArrow(merge, "slot bigint"))
    held.destroy()
    return merged


def count_words(documents: DataFrame, seed: int = 0, most: int = MOST_ENTRIES) -> DataFrame:
    """(lang, word, id, n) of all words of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        held: list[pa.Table] = []
        rows = 0

        def added() -> pa.Table:
            return pa.concat_tables(held).group_by(["lang", "word"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["lang", "word", "n"])

        def told(table: pa.Table) -> pa.RecordBatch:
            lang, word, n = (c.combine_chunks() for c in table.columns)
            ids = _ids(list(langs), lang.to_numpy(), word.to_pylist(), np.arange(len(word)), seed)
            named = pa.array(list(langs), pa.string()).take(lang)
            return pa.RecordBatch.from_arrays([named, word.cast(pa.string()), pa.array(ids.view(np.int64)), n], names=["lang", "word", "id", "n"])

        for batch in one_by_one(batches):
            for block in blocks(batch):
                counts = np.bincount(block.code[: block.own], minlength=len(block.word))
                met = np.flatnonzero(counts)
                lang = np.array([langs.setdefault(name, len(langs)) for name in block.langs])[block.lang[met]]
                held.append(pa.table({"lang": lang, "word": block.known.take(pa.array(block.word[met])), "n": counts[met]}))
                rows += len(met)
                if rows > most:
                    held = [added()]
                    rows = held[0].num_rows
                    if rows > most // 2:
                        yield told(held[0])
                        held, rows = [], 0
        if held:
            yield told(added())

    made = documents.mapInArrow(run, "lang string, word string, id bigint, n bigint")
    return stable(made.groupBy("lang", "word").agg(F.first("id").alias("id"), F.sum("n").alias("n")))


def _dealt(phrases: list[bytes], counts: list[int], bits: int) -> pa.RecordBatch:
    """A run as rows (bucket, phrases, counts), each as sorted as the run; a bucket has whole prefixes."""
    mask = (1 << bits) - 1
    bucket = np.array([xxhash.xxh3_64_intdigest(p[: 1 - ID]) & mask for p in phrases], np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    offsets = pa.array(np.r_[starts, len(bucket)].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(v, k).take(pa.array(order))) for v, k in ((phrases, pa.binary()), (counts, pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *lists], names=["bucket", "phrases", "counts"])


def count_phrases(documents: DataFrame, frequent: Frequent, longest: int, least: int, seed: int, words: int) -> DataFrame:
    """(phrase, n) of phrases of word ids, two to ``longest``, that occur at least ``least`` times in some ``words`` words of text."""
    held = to_tasks(documents.sparkSession, frequent)
    bits = _bucket_bits((longest - 1) * words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, told = HatTrie(), in_task(held)

        def runs(all: bool) -> Iterator[pa.RecordBatch]:
            for phrases, counts in trie.spill(all):
                yield _dealt(phrases, counts, bits)

        for batch in one_by_one(batches):
            for block in blocks(batch):
                ids = block.ids(seed)
                stored = ids.astype(">u8")
                for size, at, key in _phrases(block, ids, told, longest):
                    if len(at):
                        trie.add(*_counted(block, stored, size, at, key))
                yield from runs(all=False)
        yield from runs(all=True)

    def merge(runs: pa.Table) -> pa.Table:
        both = pa.table({"phrase": runs["phrases"].combine_chunks().flatten(), "n": runs["counts"].combine_chunks().flatten()})
        added = both.group_by("phrase", use_threads=False).aggregate([("n", "sum")]).rename_columns(["phrase", "n"])
        return added.filter(pc.greater_equal(added["n"], least))

    dealt = documents.mapInArrow(run, "bucket int, phrases array<binary>, counts array<bigint>")
    merged = stable(dealt.groupBy("bucket").applyInArrow(merge, "phrase binary, n bigint"))
    held.destroy()
    return merged


def _part(first: Column | int, size: Column | int) -> Column:
    """``size`` words of a phrase from word ``first`` on, counted from 0."""
    return F.substring(F.col("phrase"), F.lit(first) * ID + 1, F.lit(size) * ID)


def phrase_scores(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """(phrase, size, lang, a, l, r, n, score) of all phrases of two words or more; ``frequent`` has those of one as well (phrase, size, lang, n)."""
    counts = lambda name: frequent.select(F.col("phrase").alias(f"{name}_part"), F.col("n").alias(name))
    cuts = (
        frequent.where("size > 1").select("phrase", "size", "lang", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
        .select("*", _part(0, F.col("k")).alias("l_part"), _part(F.col("k"), F.col("size") - F.col("k")).alias("r_part"))
    )
    met = cuts.join(counts("l"), "l_part").join(counts("r"), "r_part").join(F.broadcast(totals) if totals.count() <= 100_000 else totals, "lang")
    wide = lambda name: F.col(name).cast("decimal(18,0)")
    # Up to 38 digits: the counts of a corpus of 10^16 words have room, and the quotient is at most 1000 n.
    exact = met.select("phrase", "size", "lang", "a", "k", "l", "r", "n", (F.lit(1000).cast("decimal(4,0)") * wide("a")).cast("decimal(20,0)").alias("up"), (wide("l") * wide("r")).cast("decimal(38,0)").alias("down"))
    scored = exact.withColumn("score", F.expr("(up * cast(n as decimal(17,0))) div down"))
    worst = scored.groupBy("phrase").agg(F.min(F.struct("score", "k", "size", "lang", "a", "l", "r", "n")).alias("w"))
    return worst.select("phrase", "w.size", "w.lang", "w.a", "w.l", "w.r", "w.n", "w.score")


def _not_inside(scored: DataFrame, percent: int) -> DataFrame:
    """Phrases that lie in no longer one that is about as frequent.

    One word more is enough to look at: where a phrase lies in a much longer one, those between are at least as frequent as that one.
    """
    longer = scored.where("size > 2").select("a", F.explode(F.array(_part(0, F.col("size") - 1), _part(1, F.col("size") - 1))).alias("phrase"))
    most = longer.groupBy("phrase").agg(F.max("a").alias("longer"))
    return scored.join(most, "phrase", "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * percent, F.lit(True))).drop("longer")


def _named(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Phrases with their words, space-joined, as ``text``."""
    place = F.posexplode(F.transform(F.sequence(F.lit(0), F.col("size") - 1), lambda i: F.conv(F.hex(F.substring(F.col("phrase"), i * ID + 1, F.lit(ID))), 16, -10).cast("bigint"))).alias("i", "id")
    # The word that a third of all phrases have goes to several tasks.
    spread = phrases.select("phrase", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"), place)
    copies = words.select("id", "word", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"))
    told = spread.join(copies, ["id", "salt"]).groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("told"))
    return phrases.join(told.select("phrase", F.array_join(F.transform("told", lambda t: t["word"]), " ").alias("text")), "phrase")


def collocations(
    documents: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST_COUNT, longest: int = LONGEST, percent: int = 100, first: int = FIRST
) -> DataFrame:
    """The ``first`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    Texts, with A-Z in lower case, are split at ``.,;:!?`` and line ends into pieces, and those at blanks and tabs into words. ``n`` counts a
    language's words, ``a`` the occurrences of a phrase of 2 to ``longest`` words within pieces, which must be ``least`` or more. A cut
    into a first and a last part, which occur ``l`` and ``r`` times, scores floor(1000 a n / (l r)); the lowest score counts, of equal ones that of the
    shortest first part. Phrases inside a longer one that has ``percent`` per cent of their occurrences are left out. Ranked by score
    and ``a``, descending, then by phrase in the order of its bytes.

    NULL is the language ``und``; NULL and empty texts have no words; a repeated row counts again; a table without rows, or without
    frequent phrases, gives none; other columns are not looked at. A text longer than ``BLOCK_BYTES`` is read in
    blocks that overlap by the words a phrase can reach. Counts below 10^16 are exact.
    """
    read = documents.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    seed = 0
    counted = count_words(read, seed)
    # Ids must tell all words apart; they practically always do.
    while counted.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        seed += 1
        release(counted)
        counted = count_words(read, seed)
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    words = stable(counted.where(F.col("n") >= least))
    key = F.expr(f"unhex(lpad(hex(id), {2 * ID}, '0'))")
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    told = Frequent(key_filter(words.select("id")))
    told.pairs = key_filter(frequent_slots(read, told, 2, 2, least, seed, n_words))
    if longest > 2:
        told.longer = key_filter(frequent_slots(read, told, 3, longest, least, seed, n_words))
    found = count_phrases(read, told, longest, least, seed, n_words)
    sized = found.select("phrase", (F.octet_length("phrase") / ID).cast("int").alias("size"), F.substring("phrase", 1, ID).alias("head"), "n")
    copies = words.select(key.alias("head"), "lang", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    spread = sized.withColumn("salt", F.pmod(F.hash("phrase"), F.lit(SALTS)))
    frequent = words.select(key.alias("phrase"), F.lit(1).alias("size"), "lang", "n").unionByName(
        spread.join(copies, ["head", "salt"]).select("phrase", "size", "lang", "n")
    )
    scored = stable(phrase_scores(stable(frequent), totals))
    kept = _named(_not_inside(scored, percent), words)
    order = [F.desc("score"), F.desc("a"), F.asc("text")]
    # The best of each part of a language first, so that no language's phrases meet in one task.
    part = F.pmod(F.xxhash64("phrase"), F.lit(4 * SALTS))
    best = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= first)
    ranked = best.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= first)
    return ranked.select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from skyload.llm import phrases
from skyload.llm.phrases import HatTrie, blocks, collocations

SCHEMA = "lang string, text string, phrase string, n int"
_LOW = {c: c + 32 for c in range(65, 91)}


def _pieces(text):
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(_LOW)):
        yield re.findall("[^ \t]+", piece)


def _plain(rows, least, longest=5, percent=100, first=2000):
    totals, counts = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in _pieces(text):
            totals[lang] += len(w)
            counts.update((lang, *w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    found = {}
    for (lang, *w), a in counts.items():
        if len(w) > 1 and a >= least:
            cuts = [(1000 * a * totals[lang] // (l * r), k, l, r) for k in range(1, len(w)) for l, r in [(counts[lang, *w[:k]], counts[lang, *w[k:]])]]
            score, _, l, r = min(cuts)
            found[lang, *w] = (" ".join(w), a, l, r, totals[lang], score)

    def inside(lang, w):
        a = counts[lang, *w]
        return any(o[0] == lang and len(o) > len(w) + 1 and 100 * counts[o] >= percent * a and any(list(o[i : i + len(w)]) == w for i in range(1, len(o))) for o in found)

    out = []
    for lang in totals:
        kept = [v for (name, *w), v in found.items() if name == lang and not inside(lang, w)]
        kept.sort(key=lambda v: (-v[5], -v[1], v[0].encode()))
        out += [(lang, i + 1, *v) for i, v in enumerate(kept[:first])]
    return sorted(out)


def _rows():
    draw = random.Random(11)
    words = ["the", "of", "New", "york", "city", "é", "Ünder", "x1", "a-b", "日本"]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(draw.randint(0, 60)):
            parts.append(draw.choice(["New York City", "x1 a-b x1 a-b x1", draw.choice(words), draw.choice(words)]) + draw.choice([" ", " ", "\t", ". ", ",", "\n"]))
        rows.append((draw.choice(["en", "en", "de", None]), " ".join(parts)))
    return rows + [("en", None), ("fr", ""), ("fr", " \t.\n"), rows[0], rows[0]]


def _got(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in collocations(table, **options).collect())


@pytest.mark.parametrize(("least", "percent", "first"), [(12, 100, 2000), (4, 80, 25)])
def test_same_as_plain_version(spark, monkeypatch, least, percent, first):
    wanted = _plain(_rows(), least, percent=percent, first=first)
    assert len(wanted) > 40
    assert _got(spark, _rows(), least=least, percent=percent, first=first) == wanted


def test_trie_bursts_spills_and_counts_exactly():
    draw, trie, wanted, merged = random.Random(1), HatTrie(burst=20, most=300), Counter(), Counter()
    runs = 0
    for _ in range(200):
        some = Counter(b"".join(bytes([draw.choice([1, 1, 2, 3])]) * 8 for _ in range(draw.randint(2, 5))) for _ in range(50))
        some.update(b"".join(bytes([draw.randint(0, 255)]) * 8 for _ in range(3)) for _ in range(20))
        wanted.update(some)
        trie.add(list(some), list(some.values()))
        for run, counts in trie.spill():
            runs += 1
            heads = [p[:8] for p in run]
            # Whole subtrees, each in order.
            assert all(run[i] < run[i + 1] for i in range(len(run) - 1) if heads[i] == heads[i + 1]) and not set(heads) & set(trie.root)
            merged.update(dict(zip(run, counts)))
        assert sum(trie._sizes().values()) <= 300
    assert runs > 2 and any(type(n) is phrases.Branch for n in trie.root.values())
    for run, counts in trie.spill(all=True):
        merged.update(dict(zip(run, counts)))
    assert merged == wanted and not trie.root


@pytest.mark.parametrize("limit", [7, 40, 1 << 20])
def test_blocks_of_long_texts_lose_and_repeat_no_phrase(limit):
    text = " ".join(t for _, t in _rows() if t) + " end"
    wanted = Counter(tuple(w[i : i + n]) for w in _pieces(text) for n in range(1, 6) for i in range(len(w) - n + 1))
    got = Counter()
    for block in blocks(pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], names=["lang", "text"]), limit):
        words = [block.words[c][1] for c in block.code]
        for i in range(block.own):
            for n in range(1, 6):
                if i + n <= len(words) and block.piece[i] == block.piece[i + n - 1]:
                    got[tuple(words[i : i + n])] += 1
    assert got == wanted


def test_ids_that_clash_are_drawn_again(spark, monkeypatch):
    made = phrases.count_words
    seeds = []

    def clashing(documents, seed):
        seeds.append(seed)
        counted = made(documents, seed)
        return counted if seed else counted.selectExpr("lang", "word", "cast(1 as bigint) as id", "n")

    monkeypatch.setattr(phrases, "count_words", clashing)
    rows = [("en", "one two three. " * 5)]
    assert _got(spark, rows, least=3) == _plain(rows, 3) and seeds == [0, 1]


def test_nothing_frequent_and_no_rows(spark):
    assert _got(spark, [("en", "one two three"), (None, None)]) == []
    assert _got(spark, []) == []


def test_rare_phrases_of_frequent_words_reach_no_trie(spark, monkeypatch, tmp_path):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = [("en", " ".join(draw.choice([*words, "at the very end"]) for _ in range(2000)) + ".") for _ in range(4)]
    folder = str(tmp_path)

    class Noted(HatTrie):
        def add(self, found, counts):
            with open(f"{folder}/added", "a") as file:
                file.write(f"{len(found)}\n")
            super().add(found, counts)

    monkeypatch.setattr(phrases, "HatTrie", Noted)
    wanted = _plain(rows, 60)
    assert _got(spark, rows, least=60) == wanted and "at the very end" in [r[2] for r in wanted]
    # Some 1,600 pairs of frequent words in each of three parts, but hardly more frequent phrases than six.
    assert sum(map(int, (tmp_path / "added").read_text().split())) < 100


@pytest.mark.parametrize("bits", [6, 13, 30])
def test_packed_slots_come_back(bits):
    draw = random.Random(2)
    slots = [draw.randrange(1 << phrases.SLOT_BITS) for _ in range(500)] + [0, (1 << phrases.SLOT_BITS) - 1] + [7] * 300 + [1 << 39] * 3
    got = {}
    for row in zip(*(c.to_pylist() for c in phrases._packed(np.array(slots, np.uint64), bits).columns)):
        found, counts = phrases._unpacked(*row, bits)
        assert {s >> (phrases.SLOT_BITS - bits) for s in found.tolist()} == {row[0]}
        got |= dict(zip(found.tolist(), counts.tolist(), strict=True))
    assert got == {s: min(n, phrases.MOST_COUNT) for s, n in Counter(slots).items()}


def test_phrases_with_one_key_are_told_apart():
    (block,) = blocks(pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(["a b a b c d"])], names=["lang", "text"]))
    ids = block.ids(0).astype(">u8")
    got = Counter()
    for phrase, n in zip(*phrases._counted(block, ids, 2, np.array([0, 2, 4]), np.zeros(3, np.uint64)), strict=True):
        got[phrase] += n
    assert sorted(got.values()) == [1, 2]

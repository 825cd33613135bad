import functools
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skyload.llm import packing
from skyload.llm.packing import Packer, Piece, WordIds, pack

SCHEMA = "doc_id bigint, text string, tokens string, start int"
PATH = public_tokenizers.path(packing.VOCABULARY)


def _texts():
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("etaoinshrdluéß", k=draw.randint(1, 9)))
    prose = lambda n: " ".join(word() + draw.choice(["", "", ".", ",\n", "!?", "'s"]) for _ in range(n))
    odd = "áb.̸c = ̸ don't 'S x\x1cy z\x85q İstanbul. ΑΣ.   12.5% 日本。テ スト, ok!!?..   x́"
    return [None, "", " \n\t", odd, odd * 50, "x" * 5000, *[prose(draw.randint(1, 900)) for _ in range(150)], prose(30000), prose(3), prose(3)]


@functools.cache
def _tokenizer():
    return Tokenizer.from_file(PATH)


@functools.cache
def _ids(text):
    return [*_tokenizer().encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("chars", [1 << 18, 40])
def test_word_by_word_ids_are_those_of_the_whole_text(monkeypatch, chars):
    monkeypatch.setattr(packing, "BLOCK_CHARS", chars)
    monkeypatch.setattr(packing, "REMEMBERED", 500)
    ids = WordIds(PATH)
    texts = [t or "" for t in _texts()]
    for text, together in zip(texts, ids.of(texts), strict=True):
        assert [*together.tolist(), 1] == _ids(text)
        assert [*[i for part in ids.blocks(text) for i in part.tolist()], 1] == _ids(text)


def test_level_is_that_of_the_least_sum_of_squares():
    draw = np.random.default_rng(2)
    packer, size = Packer(32, 1 << 30), 32
    for _ in range(4000):
        length = int(draw.integers(1, size))
        counts = packer.levels[1:size].copy()
        assert [len(w) for w in packer.open[1:]] == counts.tolist()

        def total(level, counts=counts, length=length):
            after = np.r_[0, counts, 0]
            after[level] -= level > 0
            after[level + length] += 1
            return (after[1:size] ** 2).sum()

        fits = [0, *[h for h in range(1, size - length + 1) if counts[h - 1]]]
        least = min(map(total, fits))
        assert packer.level_for(length) == max(h for h in fits if total(h) == least)
        packer.place(Piece(0, 0, np.zeros(length, "<u4"), [length]))


def _check(rows, texts, size):
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r["length"] == len(r["tokens"]) // 4 > 0
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, text in enumerate(texts):
        mine, wanted = sorted(by_doc[i], key=lambda r: r["start"]), _ids(text)
        assert np.frombuffer(b"".join(r["tokens"] for r in mine), "<u4").tolist() == wanted
        assert [r["start"] for r in mine] == np.cumsum([0, *[r["length"] for r in mine]])[:-1].tolist()
        assert {r["doc_tokens"] for r in mine} == {len(wanted)}
    lengths = []
    for mine in by_sequence.values():
        mine.sort(key=lambda r: r["offset"])
        ends = np.cumsum([0, *[r["length"] for r in mine]])
        assert [r["offset"] for r in mine] == ends[:-1].tolist()
        lengths.append(int(ends[-1]))
    assert all(n == size or n & (n - 1) == 0 for n in lengths)
    return lengths


@pytest.mark.parametrize("most_open", [2048, 3])
def test_all_ids_are_packed_once_without_padding(spark, most_open):
    texts = _texts()
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    lengths = _check(pack(table, most_open=most_open).collect(), texts, 2048)
    # Each of three tasks has at most one sequence of each lower power of two.
    assert all(lengths.count(1 << i) <= 3 for i in range(11))


def test_documents_that_fit_are_cut_only_to_end_a_task(spark):
    texts = [" ".join(["the"] * n) for n in [1023, 700, 322] * 40]
    rows = pack(spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA).coalesce(1)).collect()
    assert len(_check(rows, texts, 2048)) == 40 and len(rows) <= 130


def test_repeated_and_null_ids_and_no_rows(spark):
    rows = pack(spark.createDataFrame([(None, "a b", "x", 1), (7, "c", "x", 1), (7, "c", "x", 1)], SCHEMA).coalesce(1)).collect()
    assert sorted((str(r["doc_id"]), r["doc_tokens"]) for r in rows if r["start"] == 0) == [("7", 2), ("7", 2), ("None", 3)]
    assert sum(r["length"] for r in rows) == 7
    assert pack(spark.createDataFrame([], SCHEMA)).collect() == []

import random

import numpy as np
import pytest

from skyload.llm.graphs import components
from skyload.llm.neardup import keep_one_of_each, near_duplicate_classes, prob_minhash, probability_jaccard, similarity
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, node string, key int"


def _docs():
    draw = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    docs = []
    for _ in range(25):
        base = draw.choices(vocabulary, k=draw.randint(8, 120))
        docs.append(" ".join(base))
        for _ in range(draw.randint(0, 5)):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 40))):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            docs.append(draw.choice([" ", ", "]).join(copy).title())
    loop = "red green blue cyan teal " * 30
    docs += [loop, loop + "end of it all", "one two", "One, two!", "one two three", "x " * 5000, "x " * 6000]
    draw.shuffle(docs)
    return docs


def test_same_classes_as_brute_force(spark):
    texts = _docs()
    rows = [(i, t, "n", 1) for i, t in enumerate(texts)]
    got = {r["doc_id"]: (r["class_id"], r["n_class"]) for r in near_duplicate_classes(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    wanted = brute.near_duplicates(texts)
    assert {d: c for d, (c, _) in got.items()} == dict(enumerate(wanted))
    assert all(n == wanted.count(c) for c, n in got.values())


def _repeats():
    """Pairs of a plain Jaccard of 0.8 or more and a far lower probability Jaccard, and some below both."""
    run = lambda name, n: [f"{name}v{k}" for k in range(n)]
    texts = []
    for i in range(24):
        loop, rest = run(f"a{i}", 20), run(f"b{i}", 100)
        texts += [" ".join(loop * n + loop[:4] + rest) for n in (1, 100)]
        shared = run(f"c{i}", 224)
        texts += [" ".join(loop * 50 + loop[:4] + shared) for loop in (run(f"d{i}", 18), run(f"e{i}", 18))]
        texts += [" ".join(loop * 50 + loop[:4] + run(f"f{i}", 40)) for loop in (run(f"g{i}", 18), run(f"h{i}", 18))]
    return texts


def test_plain_similarity_of_repeats_as_brute_force(spark):
    texts = _repeats()
    got = {r["doc_id"]: r["class_id"] for r in near_duplicate_classes(spark.createDataFrame([(i, t, "n", 1) for i, t in enumerate(texts)], SCHEMA)).collect()}
    wanted = brute.near_duplicates(texts)
    assert got == dict(enumerate(wanted))
    assert len(set(wanted)) == 24 * 4


def test_large_group_and_chain(spark):
    """A bucket of many members, and links that only a chain connects."""
    base = [f"t{i}" for i in range(200)]
    texts = []
    for i in range(60):
        copy = list(base)
        copy[3 * i] = f"u{i}"
        texts.append(" ".join(copy))
    chain = [" ".join(f"c{k}" for k in range(4 * i, 4 * i + 100)) for i in range(25)]
    rows = [(i, t, None, 1) for i, t in enumerate(texts + chain)]
    got = {r["doc_id"]: r["class_id"] for r in near_duplicate_classes(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: 0 if i < 60 else 60 for i in range(85)}


def test_odd_rows(spark):
    rows = [(1, None, "a", 1), (2, "", "a", 1), (2, "", "b", 1), (None, "...", "a", 1), (4, "q r s t u v", "a", 1), (None, "Q r s t u v", "a", 1), (4, "q r s t u v", "c", 2), (None, "lone words here", "a", 1)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r["doc_id"], r["class_id"], r["n_class"]) for r in near_duplicate_classes(table).collect()), key=str)
    assert got == sorted([(1, 1, 1), (2, 2, 1), (2, 2, 1), (None, None, 1), (4, 4, 3), (None, 4, 3), (4, 4, 3), (None, None, 1)], key=str)
    kept = keep_one_of_each(table)
    assert kept.columns == ["doc_id", "text", "node", "key"]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect() if r["text"] is not None) == [(0, "..."), (0, "lone words here"), (2, ""), (4, "q r s t u v")]
    assert near_duplicate_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_signatures_estimate_probability_jaccard():
    draw = np.random.default_rng(1)
    elements = draw.integers(1, 2**63, 150).astype(np.uint64)
    x, y = np.zeros(150), np.zeros(150)
    x[:120], y[30:] = draw.uniform(0.5, 4, 120), draw.uniform(0.5, 4, 120)
    size = 4000
    row = np.repeat([0, 1], 120)
    made = prob_minhash(row, np.r_[elements[:120], elements[30:]], np.r_[x[:120], y[30:]], 2, size)
    named = lambda v: {i: w for i, w in enumerate(v) if w}
    wanted = brute.probability_jaccard(named(x), named(y))
    assert probability_jaccard(x, y) == pytest.approx(wanted)
    assert abs((made[0] == made[1]).mean() - wanted) < 5 * np.sqrt(wanted * (1 - wanted) / size)


def test_similarity_of_counts():
    one = (np.array([1, 2, 3], np.uint32), np.array([1, 1, 1], np.uint32))
    assert similarity(one, one) == 1 and similarity(one, (one[0][:0], one[1][:0])) == 0
    assert similarity(one, (np.array([2, 3, 4], np.uint32), np.array([1, 1, 1], np.uint32))) == 0.5


def test_components(spark):
    links = [(9, 8), (8, 7), (7, 6), (6, 5), (1, 2), (2, 1), (3, 3)] + [(20, i) for i in range(21, 60)]
    got = {r["node"]: r["least"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {9: 5, 8: 5, 7: 5, 6: 5, 2: 1} | {i: 20 for i in range(21, 60)}

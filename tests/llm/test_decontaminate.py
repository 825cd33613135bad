import random

import pytest
from pyspark.sql import functions as F

from skyload.llm.decontaminate import contamination, drop_contaminated, gram_size
from tests.llm import brute

DOCS = "doc_id bigint, text string"
ITEMS = "item_id bigint, text string"


def _case():
    draw = random.Random(3)
    vocabulary = ["the", "Of", "naïve", "42", "x", "y", "zeta"]
    text = lambda n: draw.choice([" ", ", ", "\n"]).join(draw.choices(vocabulary, k=n))
    items = [(i, text(draw.randint(0, 16))) for i in range(12)] + [(None, text(12)), (5, text(11)), (20, None), (21, "..."), (22, "x x")]
    docs = [(i, text(draw.randint(0, 60))) for i in range(60)]
    docs += [(100 + i, f"{text(3)} {t.upper()}! {text(4)}") for i, (_, t) in enumerate(items) if t]
    docs += [(200, None), (201, ""), (202, " .. "), (None, text(30)), (203, text(5)), (203, text(5)), (204, items[0][1] * 4000)]
    return docs + docs[5:8], items


def test_same_as_brute_force(spark):
    docs, items = _case()
    table = spark.createDataFrame(docs, DOCS).withColumn("key", F.lit(1)).withColumn("n_words", F.lit("x")).repartition(5)
    got = sorted(map(tuple, contamination(table, spark.createDataFrame(items, ITEMS).withColumn("size", F.lit(0))).collect()), key=str)
    wanted = [(d, *row) for (d, _), row in zip(docs, brute.contamination([t for _, t in docs], items), strict=True)]
    assert got == sorted(wanted, key=str)
    assert any(w[5] for w in wanted) and not all(w[5] for w in wanted)


def test_no_shared_span_is_missed(spark):
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(words[i : i + 10])) for i in range(0, 390, 7)]
    docs = [(i, f"a b {' '.join(words[i : i + 10])} c") for i in range(390)]
    got = contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).where("n_hit >= 10").select("doc_id").collect()
    assert sorted(r[0] for r in got) == list(range(0, 390, 7))


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([], [])])
def test_empty_tables(spark, docs, items):
    got = contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert [tuple(r)[:4] for r in got] == [(1, 2, 0, 0)][: len(docs)]


def test_drop_keeps_columns_and_clean_rows(spark):
    docs = [(1, "one two", "k"), (2, "three", None), (2, "three", None), (None, None, "z")]
    got = drop_contaminated(spark.createDataFrame(docs, "doc_id bigint, text string, key string"), spark.createDataFrame([(1, "two")], ITEMS))
    assert got.columns == ["doc_id", "text", "key"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([docs[1], docs[2], docs[3]], key=str)


def test_fingerprints_cover_a_span():
    assert all(1 <= gram_size(n) <= n for n in range(1, 30)) and gram_size(10) == 6

import random

import pytest
from pyspark.sql import functions as F

from skyload.llm.lineruns import drop_repeated_runs, line_positions, suffix_ranks, without_emptied
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, n_lines string"


def test_same_as_brute_force(spark):
    draw = random.Random(5)
    lines = ["a b c", "d e", "f g h i", "a b c d", "z", "é ß", "", "  ", " "]
    docs = [(i, "\n".join(draw.choice(lines[: draw.choice([2, 3, 9])]) for _ in range(draw.randint(0, 14))), "x") for i in range(50)]
    docs += [(100, "\n".join(["a b c"] * 21), "x"), (101, None, "x"), (102, "", None), (103, docs[0][1], "y"), (None, docs[1][1] + "\nd e", "y")]
    table = spark.createDataFrame(docs, SCHEMA).repartition(5)
    got = {r["doc_id"]: (r["text"], r["n_lines_"], r["n_deleted"]) for r in drop_repeated_runs(table, least_words=9).collect()}
    wanted = brute.line_runs([d[:2] for d in docs], 9)
    assert got == {d[0]: w for d, w in zip(docs, wanted, strict=True)}
    assert sum(w[2] for w in wanted) > 50


def test_repeated_rows_and_ties(spark):
    long = "one two three four five six"
    docs = [(1, long, "a"), (1, long, "b"), (1, "x y", "c"), (1, "x y", "d"), (None, long, "e")]
    got = sorted((r["doc_id"], r["text"], r["n_deleted"]) for r in drop_repeated_runs(spark.createDataFrame(docs, SCHEMA), least_words=4).collect() if r["doc_id"])
    assert got == [(1, "", 1), (1, long, 0), (1, "x y", 0), (1, "x y", 0)]


def test_very_long_text(spark):
    body = "\n".join(f"line {i} of many" for i in range(20000))
    got = drop_repeated_runs(spark.createDataFrame([(2, "head\n" + body, None), (1, body, None)], SCHEMA)).collect()
    assert {r["doc_id"]: (r["text"], r["n_deleted"]) for r in got} == {1: (body, 0), 2: ("head", 20000)}


def test_empty_table_and_nothing_repeated(spark):
    assert drop_repeated_runs(spark.createDataFrame([], SCHEMA)).count() == 0
    got = drop_repeated_runs(spark.createDataFrame([(1, "a\nb", None)], SCHEMA)).collect()
    assert [(r["text"], r["n_lines_"], r["n_deleted"], r["deleted"]) for r in got] == [("a\nb", 2, 0, "")]


def test_ranks_order_suffixes(spark):
    draw = random.Random(2)
    docs = [(i, "\n".join(draw.choices("pqr", k=12)), None) for i in range(6)]
    lines = line_positions(spark.createDataFrame(docs, SCHEMA))
    rows = {r["pos"]: bytes(r["line"]) for r in lines.collect()}
    for k, level in enumerate(suffix_ranks(lines)):
        ranks = {r["pos"]: r["rank"] for r in level.collect()}
        prefix = {p: tuple(rows[p + i] for i in range(2**k)) for p in ranks}
        by_rank = sorted(ranks, key=lambda p: ranks[p])
        assert [prefix[p] for p in by_rank] == sorted(prefix.values())
        assert len(set(ranks.values())) == len(set(prefix.values()))


@pytest.mark.parametrize("deleted, text, kept", [(0, "", True), (0, None, True), (2, "a", True), (2, "\n ", False)])
def test_emptied(spark, deleted, text, kept):
    table = spark.createDataFrame([(text, deleted)], "text string, n int")
    assert without_emptied(table, F.col("n")).count() == kept

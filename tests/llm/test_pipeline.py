"""Each stage against a plain version, on its own input."""

import random

import duckdb
import pytest

import corpus_pipeline
from checks.compare import differences, frame, rows
from skyload.llm.queries import ORACLES
from skyload.session import stable
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(11)
    words = [f"{a}{b}{c}" for a in "bcdfgl" for b in "aeiou" for c in ("n", "rt", "st", "")]
    line = lambda n: " ".join(draw.choices(words, k=n))
    passage, items = [line(30), line(25)], [(i, line(14)) for i in range(6)]
    docs = []
    for i in range(90):
        lines = [line(draw.randint(3, 20)) for _ in range(draw.randint(2, 9))]
        if i % 9 == 0:
            lines[1:1] = passage
        if i % 10 == 0:
            lines.append(f"{line(3)} {draw.choice(items)[1].upper()}")
        docs.append((i, "\n".join(lines)))
    for i in range(90, 120):
        copy = draw.choice(docs[:90])[1].split(" ")
        copy[draw.randrange(len(copy))] = "changed"
        docs.append((i, " ".join(copy)))
    docs += [(120, docs[3][1]), (121, docs[3][1]), (122, "12 - 34"), (123, ""), (124, None), (None, line(40)), (125, line(4000))]
    out = str(tmp_path_factory.mktemp("tables"))
    table = [(i, t, draw.choice(["en", "fr"]) if t else None, draw.choice(["s1", "s1", "s5", "s8", None]), len(t or ""), "k") for i, t in docs]
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def _sorted(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    told = stable(stages["language_id"](spark, docs, folder))
    before = {r["doc_id"]: r for r in docs.collect()}
    after = _sorted(told.collect())
    assert told.columns == columns and all(before[r["doc_id"]] == r for r in after)
    gone = set(before) - {r["doc_id"] for r in after}
    assert gone >= {122, 123, 124} and len(gone) < 30

    cleaned = stable(stages["line_dedup"](spark, told, folder))
    assert cleaned.columns == columns
    wanted = {}
    for r, (text, lines, deleted) in zip(after, brute.line_runs([(r["doc_id"], r["text"]) for r in after], 50), strict=True):
        if deleted < lines:
            wanted[r["doc_id"]] = (text, len(text) if deleted else r["n_chars"])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cleaned.collect()}
    assert got == wanted and len(got) < len(after) and any(t != before[i]["text"] for i, (t, _) in got.items())

    once = stable(stages["near_dedup"](spark, cleaned, folder))
    rows_in = _sorted(cleaned.collect())
    firsts = brute.near_duplicates([r["text"] for r in rows_in])
    assert once.columns == columns
    assert _sorted(once.collect()) == [rows_in[i] for i in sorted(set(firsts))] and len(set(firsts)) < len(rows_in)

    clean = stable(stages["decontaminate"](spark, once, folder))
    rows_in = _sorted(once.collect())
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    hit = brute.contamination([r["text"] for r in rows_in], items)
    assert clean.columns == columns and any(h[4] for h in hit)
    assert _sorted(clean.collect()) == [r for r, h in zip(rows_in, hit, strict=True) if not h[4]]

    mixed = stages["mix_sources"](spark, clean, folder)
    assert mixed.columns == [*columns, "n_epochs"]
    clean.write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    wanted = frame(connection, ORACLES["op2_mix_sources"])[["doc_id", "lang", "source", "n_epochs"]]
    assert differences(rows(mixed.select("doc_id", "lang", "source", "n_epochs")), wanted) == ""

    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, mixed.collect()), key=str)


def test_empty_documents(spark, folder, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns[-1] == "n_epochs" and got.count() == 0

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyload.llm import langid
from skyload.llm.langid import BUCKETS, Grams, Model, fit_temperature, follow_the_leader, identify, in_fold, keep_identified, predict_held_out, softmax, tf_idf, train

SCHEMA = "doc_id bigint, text string, lang string, source string, score string"
ALPHABETS = {"aa": "abcdefg", "bb": "efghijk", "cc": "жзиклмн"}


def _rows(n=240):
    draw = random.Random(2)
    rows = []
    for i in range(n):
        lang = draw.choice(list(ALPHABETS))
        text = " ".join("".join(draw.choices(ALPHABETS[lang], k=draw.randint(1, 8))) for _ in range(draw.randint(5, 40)))
        rows.append((i, draw.choice([str.lower, str.upper, str.title])(text), lang, "s", "x"))
    return rows


ODD = [(1000, None, "aa", "s", "x"), (1001, "", "aa", "s", "x"), (1002, " 12 -- !!", "bb", "s", "x"), (None, "abc abc", "cc", "s", "x"), (1003, "abcd gfed", None, "s", "x"), (1003, "abcd gfed", None, "s", "x")]


def test_held_out_accuracy_and_odd_rows(spark):
    rows = _rows() + ODD
    got = predict_held_out(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = {}
    for r in got.collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert len(found[1003]) == 2
    known = {r[0]: r[2] for r in _rows()}
    held = [r for i in known for r in found[i] if r["held_out"]]
    assert 20 < len(held) < 80 and sum(r["lang_pred"] == known[r["doc_id"]] for r in held) >= 0.97 * len(held)
    for name in (1000, 1001, 1002):
        assert (found[name][0]["lang_pred"], found[name][0]["score"]) == ("und", 0.0)
    assert found[None][0]["lang_pred"] == "aa" and not found[None][0]["held_out"]
    assert all(0 <= r["score"] <= 1 for rs in found.values() for r in rs)


def test_only_text_and_training_labels_matter(spark):
    """Other labels of held-out rows, sources and unlabelled rows change no prediction."""
    rows = _rows(120)
    table = spark.createDataFrame(rows, SCHEMA)
    held = {r["doc_id"] for r in table.where(in_fold()).collect()}
    changed = [(i, t, "zz" if i in held else lang, "other", None) for i, t, lang, _, _ in rows]
    one, two = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict_held_out(df).collect()} for df in (table, spark.createDataFrame(changed, SCHEMA).repartition(3)))
    assert one == two and all(lang != "zz" for lang, _ in one.values())


def test_no_labels_and_empty_table(spark):
    got = predict_held_out(spark.createDataFrame([(1, "abc", None, "s", "x")], SCHEMA)).first()
    assert (got["lang_pred"], got["score"]) == ("und", 0.0)
    assert predict_held_out(spark.createDataFrame([], SCHEMA)).count() == 0


def test_stage_keeps_columns(spark):
    rows = _rows(100) + ODD
    got = keep_identified(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "lang", "source", "score"]
    kept = sorted(map(tuple, got.collect()), key=str)
    gone = [r for r in rows if r not in kept]
    assert {r[0] for r in gone} >= {1000, 1001, 1002} and len(gone) <= 6


def test_grams_do_not_depend_on_layout(spark, monkeypatch):
    draw = random.Random(1)
    texts = [None, "", "a", "1a", "Été 12 été", "жук", "語 文", "x" * 3000] + ["".join(draw.choices("ab c.", k=draw.randint(0, 50))) for _ in range(300)]

    def all_counts(block):
        monkeypatch.setattr(langid, "BLOCK", block)
        return {(first + r, b): c for first, row, bucket, count in Grams().counts(texts) for r, b, c in zip(row.tolist(), bucket.tolist(), count.tolist(), strict=True)}

    small, large = all_counts(1), all_counts(128)
    assert small == large
    total = lambda i: sum(c for (r, _), c in small.items() if r == i)
    # One letter, and with the blanks around it two pairs and a triple.
    assert [total(i) for i in range(4)] == [0, 0, 4, 4]


def test_leader_is_sparse_and_right():
    draw = np.random.default_rng(3)
    rows, labels = [], []
    for _ in range(300):
        label = int(draw.integers(3))
        bucket = np.unique(np.r_[label * 10 + draw.integers(0, 5, 3), draw.integers(100, 4000, 6)]).astype(np.int32)
        rows.append((bucket, tf_idf(np.ones(len(bucket)), np.ones(len(bucket)))))
        labels.append(label)
    weights, bias = follow_the_leader(rows, labels, 3)
    told = [int(np.argmax(v @ weights[b] + bias)) for b, v in rows]
    assert weights.shape == (BUCKETS, 3) and (weights != 0).mean() < 0.2
    assert np.mean(np.array(told) == labels) > 0.98


def test_temperature():
    draw = np.random.default_rng(0)
    logits = draw.normal(size=(5000, 4))
    labels = np.array([draw.choice(4, p=p) for p in softmax(logits)])
    assert fit_temperature(logits * 5, labels) == pytest.approx(5, rel=0.15)
    assert fit_temperature(np.eye(3) * 4, np.arange(3)) > 0.02


def test_ties_go_by_name(spark):
    model = Model(["a", "b"], np.ones(BUCKETS), np.zeros((BUCKETS, 2)), np.zeros(2), 1.0)
    got = identify(spark.createDataFrame([("xyz",)], "text string"), model).first()
    assert tuple(got) == ("a", 0.5)


def test_sample_is_bounded(spark):
    rows = [(i, f"abc {i}", "aa", "s", "x") for i in range(900)] + [(i, "efg", "bb", "s", "x") for i in range(5)]
    model = train(spark.createDataFrame(rows, SCHEMA), rows_per_language=50)
    assert model.languages == ["aa", "bb"]


def _plain_grams(text):
    """Hashed n-grams of a text by how often each occurs: words of letters, a blank before, between and after them."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    line = f" {' '.join(words)} " if words else ""
    found = {}
    for n in (1, 2, 3):
        for gram in (line[i : i + n] for i in range(len(line) - n + 1)):
            if gram != " ":
                h = 0
                for c in gram:
                    h = (h * 0x9E3779B97F4A7C15 + ord(c)) % (1 << 64)
                bucket = int(langid.mix(np.array([(h + n) % (1 << 64)], np.uint64))[0]) >> 49
                found[bucket] = found.get(bucket, 0) + 1
    return found


def _plain_values(grams, idf):
    values = {b: (1 + math.log(c)) * idf(b) for b, c in grams.items()}
    size = math.sqrt(sum(v * v for v in values.values()))
    return {b: v / size for b, v in values.items()} | {None: 1.0}


def _plain_weights(rows, languages):
    """One coordinate of one language at a time; the coordinate None is the bias."""
    z, n = {}, {}

    def weight(key):
        if abs(z.get(key, 0.0)) <= langid.L1:
            return 0.0
        return -(z[key] - math.copysign(langid.L1, z[key])) / ((langid.SMOOTH + math.sqrt(n[key])) / langid.STEP + langid.L2)

    def chances(values, temperature=1.0):
        logits = [sum(v * weight((b, k)) for b, v in values.items()) / temperature for k in languages]
        e = [math.exp(x - max(logits)) for x in logits]
        return [x / sum(e) for x in e]

    for _ in range(langid.PASSES):
        for values, label in rows:
            told = chances(values)
            old = {(b, k): weight((b, k)) for b in values for k in languages}
            for k, p in zip(languages, told, strict=True):
                for b, v in values.items():
                    g, before = v * (p - (k == label)), n.get((b, k), 0.0)
                    n[b, k] = before + g * g
                    z[b, k] = z.get((b, k), 0.0) + g - (math.sqrt(n[b, k]) - math.sqrt(before)) / langid.STEP * old[b, k]
    return chances


def _plain_temperature(chances, rows, languages):
    wrong = 1 / (len(rows) + 2)

    def loss(t):
        total = 0.0
        for values, label in rows:
            for k, p in zip(languages, chances(values, t), strict=True):
                total -= (1 - wrong if k == label else wrong / (len(languages) - 1)) * math.log(max(p, 1e-300))
        return total

    low, high = math.log(1 / 50), math.log(50)
    while high - low > 1e-9:
        third = (high - low) / 3
        low, high = (low, high - third) if loss(math.exp(low + third)) <= loss(math.exp(high - third)) else (low + third, high)
    return math.exp((low + high) / 2)


def test_same_as_a_plain_version(spark):
    """Languages and scores of all rows, from dictionaries and loops; the sample takes every row here."""
    rows = _rows(110) + ODD + [(2000, "Été, 語 文 x́y 12ab", "aa", "s", "x"), (2001, "e" * 5000, None, "s", "x")]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    drawn = table.where(F.col("doc_id").isNotNull() & ~in_fold() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = drawn.select(F.xxhash64(F.col("doc_id").cast("string"), "text").alias("draw"), "lang", "text").collect()
    grams = [(r.draw, r.lang, _plain_grams(r.text)) for r in known]
    seen = {}
    for *_, g in grams:
        for b in g:
            seen[b] = seen.get(b, 0) + 1
    idf = lambda b: math.log((1 + len(grams)) / (1 + seen.get(b, 0))) + 1
    languages = sorted({lang for _, lang, _ in grams})
    vectors = [(_plain_values(g, idf), lang) for _, lang, g in sorted(grams, key=lambda r: r[:2]) if g]
    chances = _plain_weights([v for i, v in enumerate(vectors) if i % langid.KEPT_APART], languages)
    temperature = _plain_temperature(chances, [v for i, v in enumerate(vectors) if i % langid.KEPT_APART == 0], languages)
    wanted = []
    for i, text, *_ in rows:
        g = _plain_grams(text)
        told = chances(_plain_values(g, idf), temperature) if g else [0.0]
        wanted.append((str(i), languages[told.index(max(told))] if g else "und", round(max(told), 5)))
    got = [(str(r.doc_id), r.lang_pred, round(r.score, 5)) for r in predict_held_out(table).collect()]
    assert [r[:2] for r in sorted(got)] == [r[:2] for r in sorted(wanted)]
    assert [r[2] for r in sorted(got)] == pytest.approx([r[2] for r in sorted(wanted)], abs=1e-4)

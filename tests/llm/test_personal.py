import random

import pytest
from pyspark.sql import functions as F

from skyload.llm.personal import find_spans, luhn, mod97, personal_data
from tests.llm import brute

FIXED = [
    None,
    "",
    "a@b.c_d@e.f.g +1 (555) 123-45678 1.2.3.4.5.6.7.8 999.1.1.1 é4111 1111-1111 1111x é@x.yé 0001.2.3.4 300.2.3.4",
    "12 " * 3000,
    "1" * 50000 + " " + "a" * 50000 + "@",
    "+49 30 1234567 and +1 and + 12",
    "mail: x@y.z",
    "mail: x@y.z",
]


def test_same_as_brute_force(spark):
    draw = random.Random(1)
    bits = ["a", "b", "@", ".", "1", "4111111111111111", " ", "-", "+", "é", "\n", "25", "(", "%", "😀"]
    texts = FIXED + ["".join(draw.choices(bits, k=draw.randint(1, 40))) for _ in range(400)]
    table = spark.createDataFrame([(i if i != 5 else None, t, "k", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, key string, kind int").repartition(6)
    got = sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in personal_data(table).collect())
    wanted = []
    for i, text in enumerate(texts):
        spans = brute.personal(text)
        count = lambda kind: sum(s.startswith(kind) for s in spans)  # noqa: B023, E731
        wanted.append((str(i if i != 5 else None), *map(count, brute.PRIVATE), brute.sha(",".join(spans))))
    assert got == sorted(wanted)
    assert all(sum(w[i] for w in wanted) for i in range(1, 5))


def test_repeated_rows(spark):
    got = personal_data(spark.createDataFrame([(1, "x@y.z")] * 3, "doc_id bigint, text string")).collect()
    assert [r["spans"] for r in got] == ["email:0:5"] * 3
    assert personal_data(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


@pytest.mark.parametrize(
    "text, spans",
    [
        ("my ssn 123-45-6789 ok", "ssn:7:18"),
        ("part 123-45-6789 of the list", ""),
        ("IBAN GB82 WEST 1234 5698 7654 32.", "iban:5:32"),
        ("IBAN GB83 WEST 1234 5698 7654 32.", ""),
        ("write to a@b.cd, IBAN GB82WEST12345698765432", "email:9:15,iban:22:44"),
    ],
)
def test_spans_of_the_method(spark, text, spans):
    assert personal_data(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()["spans"] == spans


@pytest.mark.parametrize(
    "text, spans",
    [
        ("IBAN BE68 5390 0754 7034 BIC GKCCBEBB", "iban:5:24"),
        ("ES9121000418450200051332 EUR 100", "iban:0:24"),
        ("BE68 5390 0754 7034 ES91 2100 0418 4502 0005 1332 BANK", "iban:0:19,iban:20:49"),
        ("NO93 8601 1117 947 SEK", "iban:0:18"),
        ("BE69 5390 0754 7034 BIC", ""),
    ],
)
def test_words_after_an_account_number(spark, text, spans):
    found = personal_data(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()["spans"]
    assert ",".join(s for s in found.split(",") if s.startswith("iban")) == spans


def test_context_moves_the_score(spark):
    texts = [(1, "at 10.0.0.1"), (2, "server address 10.0.0.1"), (3, "release version 10.0.0.1")]
    got = {r["key"]: r["score"] for r in find_spans(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert sorted(got.values()) == [0.2, 0.6, 1.0]


def test_checksums(spark):
    row = spark.range(1).select(*[luhn(F.lit(n)).alias(n) for n in ("4111111111111111", "4111111111111112", "79927398713")], mod97(F.lit("DE89 3704 0044 0532 0130 00")).alias("iban")).first()
    assert tuple(row) == (True, False, True, True)

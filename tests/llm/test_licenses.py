import random

import pytest
import regex

from skyload.llm.licenses import BASE, NOTICES, Notice, Scanner, license_scan, seeds
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, labels string"


def _base(text):
    w = brute.words(text)
    found = [(i, n.label) for n in BASE for i in range(len(w)) if w[i : i + len(n.words.split())] == n.words.split()]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))


def _labels(text):
    """Labels of notices that the whole text matches, without any seeds."""
    body = " ".join(brute.words(text))
    return ",".join(sorted({n.label for n in BASE + NOTICES if regex.search(rf"(?<![^ ])(?:{n.words}){{e<={n.edits}}}(?![^ ])", body)}))


def _texts():
    draw = random.Random(6)
    filler = lambda n: " ".join("".join(draw.choices("abcdefgh", k=draw.randint(1, 6))) for _ in range(n))
    texts = [None, "", " - ", "MIT License", "the MIT  license, or a mit-license!", "İMIT LICENSE mit license", "Apache\nLicense general public license", "mit licenses submit license"]
    for notice in BASE + NOTICES:
        for edits in (0, 1, notice.edits, notice.edits + 2):
            letters = list(notice.words)
            for _ in range(edits):
                at = draw.randrange(len(letters))
                letters[at] = draw.choice(["", "q", letters[at] + "z"])
            texts.append(f"{filler(draw.randint(0, 9))} {''.join(letters).title()} {filler(draw.randint(0, 9))}")
    texts.append(filler(20000) + " Released under the MIT Licence. " + filler(20000))
    return texts + texts[3:5]


def test_same_as_brute_force(spark):
    texts = _texts()
    table = spark.createDataFrame([(None if i == 9 else i, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(4)
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]) for r in license_scan(table).collect())
    wanted = sorted((str(None if i == 9 else i), *_base(t), _labels(t)) for i, t in enumerate(texts))
    assert got == wanted


def test_spans_and_score(spark):
    rows = license_scan(spark.createDataFrame([(1, "Notice: released under teh MIT license!", ""), (2, "none here", "")], SCHEMA)).collect()
    one, two = sorted(rows, key=lambda r: r["doc_id"])
    assert [(s["label"], s["first"], s["last"], s["edits"], s["base"]) for s in one["spans"]] == [("mit", 1, 5, 2, False), ("mit", 4, 5, 0, True)]
    assert one["score"] == 1 and two["score"] == 0 and two["spans"] == []


@pytest.mark.parametrize("notice", BASE + NOTICES)
def test_seeds_make_up_the_notice(notice):
    pieces = seeds(notice)
    assert len(pieces) == notice.edits + 1 and all(p for p, _ in pieces)
    assert "".join(p for p, _ in pieces) == notice.words and all(notice.words[a:].startswith(p) for p, a in pieces)


def test_any_edit_within_the_limit_is_found():
    notice, draw = Notice("n", "permission is hereby granted free of charge", 4), random.Random(8)
    scanner = Scanner((notice,))
    for _ in range(300):
        letters = list(notice.words)
        for _ in range(4):
            at = draw.randrange(1, len(letters) - 1)
            letters[at] = draw.choice(["", "q", letters[at] + "z"])
        text = "".join(letters)
        assert scanner.scan(f"so {text} so"), text


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        before, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(before[j + 1] + 1, row[j] + 1, before[j] + (x != y)))
    return row[-1]


def _spans(notice, text):
    """All runs of words near a notice, those of fewest edits first, without any that overlap them."""
    starts = [0] + [k + 1 for k, c in enumerate(text) if c == " "]
    ends = [k - 1 for k in starts[1:]] + [len(text)]
    near = [(a, b) for a in starts for b in ends if abs(b - a - len(notice.words)) <= notice.edits]
    out = []
    for edits, a, b in sorted((_edits(notice.words, text[a:b]), a, b) for a, b in near):
        if edits <= notice.edits and all(b <= c or a >= d for c, d, _ in out):
            out.append((a, b, edits))
    return sorted(out)


@pytest.mark.parametrize("text", ["gnu leser general public license and gnu lesser general public license", "x all rihts reserved foo all rights reserved"])
def test_worse_match_before_a_better_one(text):
    scanner = Scanner(NOTICES)
    assert [m[3] for m in sorted(scanner.scan(text), key=lambda m: m[1]) if NOTICES[m[0]].label in ("lgpl", "all-rights-reserved")] == [1, 0]


@pytest.mark.parametrize("notice", [n for n in NOTICES if n.label in ("lgpl", "all-rights-reserved", "cc0", "mpl")])
def test_copies_in_a_row_as_brute_force(notice):
    draw, scanner = random.Random(9), Scanner((notice,))
    for _ in range(40):
        words = []
        for _ in range(draw.randint(2, 5)):
            letters = list(notice.words)
            for _ in range(draw.randint(0, notice.edits)):
                at = draw.choice([k for k in range(1, len(letters) - 1) if letters[k].isalpha()])
                letters[at] = draw.choice(["q", letters[at] + "z"])
            words += ["".join(letters)] + ["xkj"] * draw.randint(1, 8)
        text = " ".join(words)
        assert sorted(m[1:] for m in scanner.scan(text)) == _spans(notice, text), text


def test_empty_table(spark):
    assert license_scan(spark.createDataFrame([], SCHEMA)).count() == 0

import random
import re
from collections import Counter

import pytest
import zstandard

from skyload.llm.quality import BANDS, BAD_CHUNKS, CHUNK_BYTES, LEVEL, in_band, quality

SCHEMA = "doc_id bigint, text string, kept string"


def _plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed)


def _verdict(text):
    raw = text.encode()
    press = lambda part: len(part) / len(zstandard.ZstdCompressor(level=LEVEL).compress(part))
    size = max(1, (len(raw) + CHUNK_BYTES // 2) // CHUNK_BYTES)
    chunks = [raw[i * CHUNK_BYTES : (i + 1) * CHUNK_BYTES if i + 1 < size else None] for i in range(size)]
    bad = sum(not in_band(len(c), press(c)) for c in chunks) if size > 1 else 0
    return in_band(len(raw), press(raw)) and bad <= BAD_CHUNKS * size


def _texts():
    draw = random.Random(9)
    prose = lambda n: " ".join("".join(draw.choices("etaoinshrdlu", k=draw.randint(1, 9))) for _ in range(n))
    noise = lambda n: "".join(chr(draw.randint(0x21, 0x2FFF)) + " " * (draw.random() < 0.2) for _ in range(n))
    texts = [None, "", " \n\t", "one two three", "a b c", "x" * 300000]
    texts += [prose(n) for n in (49, 50, 51, 400, 900, 3000, 20000)] + [noise(n) for n in (300, 3000)]
    texts += [prose(60) + "\n" + "a # b * c\n" * 3 + "\n \n" + prose(10), (prose(8) + ". ") * 40, prose(500) + " ab" * 9000 + prose(500)]
    return texts + texts[-3:]


def test_same_as_plain_version(spark):
    texts = _texts()
    table = spark.createDataFrame([(None if i == 8 else i, t, "x") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["kept"]) for r in quality(table).collect())
    wanted = []
    for i, text in enumerate(texts):
        base = _plain(text)
        wanted.append((str(None if i == 8 else i), *base, not base[-1] and _verdict(text)))
    assert got == sorted(wanted)


def test_bands_reject_noise_and_repeats_only(spark):
    draw = random.Random(4)
    random_text = " ".join("".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(6)) for _ in range(500))
    dull = "\n".join(f"{i} {i} aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" for i in range(400))
    prose = " ".join("".join(draw.choices("etaoinshrdlu", k=draw.randint(1, 9))) for _ in range(500))
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality(spark.createDataFrame([(1, random_text, ""), (2, dull, ""), (3, prose, "")], SCHEMA)).collect()}
    assert got == {1: (False, False), 2: (False, False), 3: (False, True)}


def test_empty_table(spark):
    assert quality(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("size, ratio, fine", [(100, 1.0, True), (100, 5.0, False), (10**7, 1.2, False), (10**7, 3.0, True)])
def test_bands(size, ratio, fine):
    assert in_band(size, ratio) == fine
    assert [b[0] for b in BANDS] == sorted(b[0] for b in BANDS)

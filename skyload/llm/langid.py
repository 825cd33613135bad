"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

N-grams of one to three letters, words set apart by a blank, are hashed into buckets. Document frequencies cover all
labelled rows. The weights are learned on a bounded sample of them by follow-the-regularised-leader with
an L1 and an L2 penalty, which leaves most weights at zero; a temperature fitted on labelled rows that were kept
apart then makes the scores probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyload.llm.texts import free_name, map_texts, mix, one_by_one, pieces
from skyload.session import release, stable

BUCKETS = 1 << 15
LONGEST = 3
UNKNOWN = "und"
# Labelled rows per language that the weights are fitted on, about; all rows count for document frequencies.
ROWS_PER_LANGUAGE = 2000
# Weights are held for each bucket and language: of more labels than this the most frequent are learned, the others are left out.
MOST_LANGUAGES = 500
# Rows of all languages that the weights are fitted on, about; fewer for each language if there are many.
ROWS_IN_ALL = 100_000
# Characters of a text from which on it is counted in blocks of so many; products of counts and weights worked out at once.
LONG_TEXT, PRODUCTS = 1 << 20, 1 << 22
# Follow-the-regularised-leader: step size, its smoothing, the two penalties, passes over the sample.
STEP, SMOOTH, L1, L2, PASSES = 2.0, 1.0, 0.02, 0.02, 3
# One in so many rows of the sample is kept apart for the temperature.
KEPT_APART = 8
# Rows whose counts are laid out densely at once.
BLOCK = 32
_WHITE = re.compile(r"\s")


@dataclass(frozen=True)
class Model:
    """Languages, inverse document frequencies by bucket, weights (buckets x languages), biases, temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


class Grams:
    """N-grams of some texts: how often each bucket occurs in each row."""

    def __init__(self) -> None:
        # Letters of the scripts below this code; others are asked for one by one.
        self.table = np.array([chr(i).isalpha() for i in range(0x3000)])

    def letters(self, codes: np.ndarray) -> np.ndarray:
        low = codes < len(self.table)
        out = np.zeros(len(codes), bool)
        out[low] = self.table[codes[low]]
        if not low.all():
            kinds, which = np.unique(codes[~low], return_inverse=True)
            out[~low] = np.array([chr(c).isalpha() for c in kinds.tolist()])[which]
        return out

    def counts(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of rows as (first row, row in the block, bucket, count); rows without a letter have none."""
        if len(texts) == 1 and len(texts[0] or "") > LONG_TEXT:
            yield from self._counts_of_long(texts[0])
            return
        blank = np.array([32], np.uint32)
        parts = []
        for text in texts:
            parts += [blank, np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32), blank]
        sizes = np.array([len(p) for p in parts[1::3]], np.int64) + 2
        codes, row = np.concatenate(parts), np.repeat(np.arange(len(texts)), sizes)
        letter = self.letters(codes)
        first = np.zeros(len(codes), bool)
        first[np.cumsum(sizes) - sizes] = True
        after_letter = np.r_[False, letter[:-1]] & ~first
        kept = letter | after_letter | first
        held = np.bincount(row[letter], minlength=len(texts)) > 0
        kept &= held[row]
        codes, row = np.where(letter, codes, 32)[kept].astype(np.uint64), row[kept]
        rows, buckets = [], []
        hashes = np.zeros(len(codes), np.uint64)
        for n in range(1, LONGEST + 1):
            count = len(codes) - n + 1
            if count <= 0:
                break
            hashes = hashes[:count] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
            inside = row[:count] == row[n - 1 :]
            if n == 1:
                inside = inside & (codes != 32)
            rows.append(row[:count][inside])
            buckets.append((mix(hashes + np.uint64(n))[inside] >> np.uint64(49)).astype(np.int64))
        if not rows:
            return
        cuts = [np.searchsorted(r, np.arange(0, len(texts) + BLOCK, BLOCK)) for r in rows]
        for i in range(len(cuts[0]) - 1):
            key = np.concatenate([(r[c[i] : c[i + 1]] - i * BLOCK) * BUCKETS + b[c[i] : c[i + 1]] for r, b, c in zip(rows, buckets, cuts, strict=True)])
            if len(key) * 24 < BLOCK * BUCKETS:
                found, count = np.unique(key, return_counts=True)
            else:
                full = np.bincount(key, minlength=BLOCK * BUCKETS)
                found = np.flatnonzero(full)
                count = full[found]
            yield i * BLOCK, found // BUCKETS, found % BUCKETS, count


    def _counts_of_long(self, text: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Like :meth:`counts` for one text, a block of it at a time."""
        total, before, letters, at = np.zeros(BUCKETS, np.int64), np.array([32], np.uint64), False, 0
        after_letter = False
        while at <= len(text):
            cut = _WHITE.search(text, at + LONG_TEXT // 4)
            last = cut.end() if cut else len(text)
            block = text[at:last].lower() + ("" if cut else " ")
            codes = np.frombuffer(block.encode("utf-32-le", "replace"), np.uint32)
            letter = self.letters(codes)
            kept = letter | np.r_[after_letter, letter[:-1]]
            after_letter, letters = bool(letter[-1]), letters or bool(letter.any())
            line = np.concatenate([before, np.where(letter, codes, 32)[kept].astype(np.uint64)])
            hashes = np.zeros(len(line), np.uint64)
            for n in range(1, LONGEST + 1):
                count = len(line) - n + 1
                if count <= 0:
                    break
                hashes = hashes[:count] * np.uint64(0x9E3779B97F4A7C15) + line[n - 1 :]
                new = max(0, len(before) - n + 1)  # those that end in this block
                inside = hashes[new:] if n > 1 else hashes[new:][line[new:] != 32]
                total += np.bincount((mix(inside + np.uint64(n)) >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
            before, at = line[1 - LONGEST :], last if cut else len(text) + 1
        found = np.flatnonzero(total)
        if letters:
            yield 0, np.zeros(len(found), np.int64), found, total[found]


def _frequencies(labelled: DataFrame, text: str) -> np.ndarray:
    """In how many rows each bucket occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total = Grams(), np.zeros(BUCKETS, np.int64)
        for batch in one_by_one(batches):
            for piece in pieces(batch):
                for _, _, bucket, _ in grams.counts(piece.column(0).to_pylist()):
                    total += np.bincount(bucket, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    found = labelled.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def tf_idf(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Values of one row, of length 1."""
    value = (1 + np.log(count)) * idf
    return value / max(np.sqrt((value * value).sum()), 1e-12)


def follow_the_leader(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], languages: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights (buckets and, last, the bias; x languages) learned from rows of (buckets, values), in order."""
    z, n = np.zeros((BUCKETS + 1, languages)), np.zeros((BUCKETS + 1, languages))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > L1, -(z - np.sign(z) * L1) / ((SMOOTH + np.sqrt(n)) / STEP + L2), 0.0)

    for _ in range(PASSES):
        for (bucket, value), label in zip(rows, labels, strict=True):
            at, x = np.r_[bucket, BUCKETS], np.r_[value, 1.0]
            z_at, n_at = z[at], n[at]
            w = weights(z_at, n_at)
            error = softmax(x @ w)
            error[label] -= 1.0
            g = x[:, None] * error
            n_new = n_at + g * g
            z[at] = z_at + g - (np.sqrt(n_new) - np.sqrt(n_at)) / STEP * w
            n[at] = n_new
    w = weights(z, n)
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least log loss, between 1/50 and 50.

    As if one more row than there are had been labelled wrong: rows that are all told right do not make it certain.
    """
    wrong = 1 / (len(labels) + 2)
    target = np.full(logits.shape, wrong / max(1, logits.shape[1] - 1))
    target[np.arange(len(labels)), labels] = 1 - wrong

    def loss(log_t: float) -> float:
        return float(-(target * np.log(np.maximum(softmax(logits / np.exp(log_t)), 1e-300))).sum(axis=1).mean())

    low, high = -np.log(50.0), np.log(50.0)
    for _ in range(60):
        a, b = low + (high - low) * 0.382, low + (high - low) * 0.618
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(
    labelled: DataFrame, label: str = "lang", id: str = "doc_id", text: str = "text", rows_per_language: int = ROWS_PER_LANGUAGE, rows_in_all: int = ROWS_IN_ALL, most_languages: int = MOST_LANGUAGES
) -> Model:
    """Learn from rows with a label; those whose label or text is NULL are not looked at.

    Document frequencies are of all rows. Weights are fitted in one task on about ``rows_per_language`` rows of each language, and no more than
    about ``rows_in_all`` together, chosen by a hash of id and text, so the task holds no more when the table grows. Of more than ``most_languages`` labels
    those of the most rows are learned, of equal ones the first by name, and never predicted is any other. No rows give a model without languages.
    """
    rows = labelled.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{text}`").isNotNull()).select(F.col(f"`{label}`").cast("string").alias("label"), F.xxhash64(F.col(f"`{id}`").cast("string"), F.col(f"`{text}`")).alias("draw"), F.col(f"`{text}`").alias("text"))
    counted = stable(rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")))
    sizes = {r["label"]: r["n"] for r in counted.orderBy(F.desc("n"), "label").limit(most_languages).collect()}
    languages = sorted(sizes)
    frequency = _frequencies(rows, "text")
    idf = np.log((1 + (counted.agg(F.sum("n")).first()[0] or 0)) / (1 + frequency)) + 1
    release(counted)
    if not languages:
        return Model([], idf, np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    limits = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, min(rows_per_language, rows_in_all / len(languages)) / sizes[k])))])
    # All of the hash's bits but the lowest eight tell whether a row is drawn.
    chosen = rows.where(F.shiftrightunsigned("draw", 8) < limits[F.col("label")] * float(1 << 56))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in one_by_one(batches):
            for piece in pieces(batch):
                for first, row, bucket, n in grams.counts(piece.column(2).to_pylist()):
                    held = np.unique(row)
                    cuts = np.searchsorted(row, held[1:])
                    made = [pa.array([x.astype(np.int32).tobytes() for x in np.split(values, cuts)], pa.binary()) for values in (bucket, n)]
                    at = pa.array(first + held)
                    yield pa.RecordBatch.from_arrays([piece.column(0).take(at), piece.column(1).take(at), *made], names=["label", "draw", "bucket", "n"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = []
        for batch in batches:
            for label, draw, b, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                sample.append((draw, label, b, n))
        sample.sort()
        vectors, labels = [], []
        for _, label, b, n in sample:
            bucket = np.frombuffer(b, np.int32)
            vectors.append((bucket, tf_idf(np.frombuffer(n, np.int32), idf[bucket])))
            labels.append(languages.index(label))
        apart = [i for i in range(len(sample)) if i % KEPT_APART == 0]
        used = [i for i in range(len(sample)) if i % KEPT_APART] or apart
        weights, bias = follow_the_leader([vectors[i] for i in used], [labels[i] for i in used], len(languages))
        temperature = 1.0
        if apart:
            logits = np.array([vectors[i][1] @ weights[vectors[i][0]] + bias for i in apart])
            temperature = fit_temperature(logits, np.array([labels[i] for i in apart]))
        held = np.flatnonzero(weights.any(axis=1))
        names = [*held.tolist(), -1, -2]
        values = [*[weights[i] for i in held], bias, np.array([temperature])]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array([v.tolist() for v in values], pa.list_(pa.float64()))], names=["bucket", "weights"])

    counted = chosen.select("label", "draw", "text").mapInArrow(count, "label string, draw bigint, bucket binary, n binary")
    learned = {r["bucket"]: r["weights"] for r in counted.repartition(1).mapInArrow(fit, "bucket bigint, weights array<double>").collect()}
    weights = np.zeros((BUCKETS, len(languages)))
    for bucket, values in learned.items():
        if bucket >= 0:
            weights[bucket] = values
    return Model(languages, idf, weights, np.array(learned[-1]), float(learned[-2][0]))


def identify(documents: DataFrame, model: Model, text: str = "text", carry: list[Column | str] | None = None, text_as: str | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``carry`` and, for each whole text, its language and the probability given to it.

    A text that is NULL or has no letter gets ``und`` and 0, as does every text if the model has no languages. Languages
    that are equally likely go by name. Repeated rows give a row each; an empty table gives no rows.
    """
    held = documents.sparkSession.sparkContext.broadcast((model.languages, model.idf, model.weights, model.bias, model.temperature))
    made: list[Grams] = []

    def compute(texts: pa.Array) -> list[pa.Array]:
        languages, idf, weights, bias, temperature = held.value
        if not made:
            made.append(Grams())
        language, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for first, row, bucket, count in made[0].counts(texts.to_pylist()) if languages else ():
            if not len(row):
                continue
            value = (1 + np.log(count)) * idf[bucket]
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            norm = np.sqrt(np.add.reduceat(value * value, starts))
            sums, group = np.zeros((len(starts), len(languages))), np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(row)]))
            some = max(1, PRODUCTS // len(languages))
            for low in range(0, len(row), some):
                here = group[low : low + some]
                sums[here[0] : here[-1] + 1] += np.add.reduceat(value[low : low + some, None] * weights[bucket[low : low + some]], np.flatnonzero(np.r_[True, here[1:] != here[:-1]]), axis=0)
            logits = sums / norm[:, None] + bias
            p = softmax(logits / temperature)
            best = p.argmax(axis=1)
            for at, b, s in zip((first + row[starts]).tolist(), best.tolist(), p.max(axis=1).tolist(), strict=True):
                language[at], score[at] = languages[b], s
        return [pa.array(language, pa.string()), pa.array(score)]

    return map_texts(documents, compute, {names[0]: "string", names[1]: "double"}, text, carry or [], text_as)


def in_fold(id: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is held out: the checksum of its id, as text, is a multiple of ``folds``; not for a NULL id."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id}`").cast("string")), F.lit(folds)) == 0, F.lit(False))


def predict_held_out(documents: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from rows that have an id and a label and are not held out."""
    known = documents.where(F.col(f"`{id}`").isNotNull() & ~in_fold(id))
    return identify(documents, train(known, lang, id, text), text, [F.col(f"`{id}`"), in_fold(id).alias("held_out")])


def keep_identified(documents: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", least: float = 0.5) -> DataFrame:
    """Documents whose language is told with a probability of at least ``least``, all columns as they were, whatever their names.

    NULL texts and those without a letter go. Learned is from labelled rows that are not held out, so a table without any loses all
    its documents; rows that repeat go or stay together; a NULL id is kept but not learned from.
    """
    known = documents.where(F.col(f"`{id}`").isNotNull() & ~in_fold(id))
    names = (free_name(documents, "__lang"), free_name(documents, "__score"))
    rest = [F.col(f"`{c}`") for c in documents.columns if c != text]
    told = identify(documents, train(known, lang, id, text), text, rest, text, names)
    return told.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least)).select(*[f"`{c}`" for c in documents.columns])

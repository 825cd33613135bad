"""Personal data, with SQL functions alone.

Regular expressions propose spans, checksums (Luhn for cards, mod 97 for account numbers) and ranges
confirm them, and words near a span raise or lower its score. Matches are found where they stand: the text
is split at the matches, and lengths of gaps and matches are summed up to each match.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyload.llm.texts import row_key

# Characters on either side of a span in which its context words may stand.
NEAR = 40
# A span of the method's own kinds needs this score.
LEAST_SCORE = 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits, from the right every second one doubled, sum up to a multiple of ten."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.try_cast("int")).otherwise(d.try_cast("int") * 2 - F.when(d.try_cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda total, d: total + F.coalesce(d, F.lit(0))) % 10 == 0


def mod97(number: Column) -> Column:
    """Whether an account number, its first four characters moved to the end and letters as 10 to 35, leaves 1."""
    plain = F.regexp_replace(number, " ", "")
    turned = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")

    def step(rest: Column, c: Column) -> Column:
        value = F.when(c.rlike("[A-Z]"), F.ascii(c) - 55).otherwise(c.try_cast("int"))
        return F.when(c == "", rest).otherwise((rest * F.when(value > 9, 100).otherwise(10) + value) % 97)

    return F.aggregate(turned, F.lit(0), step) == 1


def _always(match: Column) -> Column:
    return F.lit(True)


def _small_parts(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _count(least: int, most: int) -> Callable[[Column], Column]:
    return lambda match: F.length(_digits(match)).between(least, most)


def _card(match: Column) -> Column:
    return _count(13, 19)(match) & luhn(_digits(match))


# How long an account number is, by country; others are as long as their groups go on.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban() -> str:
    """Groups of four, or none: of the length that the country has, so that no word after it is taken along, or else of any."""
    four, fixed = r"(?:\x20?[A-Z0-9]{4})", []
    for length, codes in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        tail = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        fixed.append(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}{four}{{{groups}}}{tail}")
    other = rf"[A-Z]{{2}}[0-9]{{2}}{four}{{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join([*fixed, other])})(?![A-Za-z0-9])"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``hint`` must occur in a text for ``pattern`` to have a match, and is quick to look for. ``words`` near a span
    add 0.4 to ``score``, ``against`` take 0.4 off. Spans of a ``base`` kind stay whatever their score.
    """

    name: str
    pattern: str
    hint: str
    valid: Callable[[Column], Column]
    score: float
    words: str
    against: str = "(?!)"
    base: bool = True


# The base patterns, written so that no long run is searched twice: a run is entered at its start or where the match
# before it ended, and what cannot match otherwise is not given back.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@[A-Za-z0-9-]+[.]", _always, 0.8, r"mail|contact|write to"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9][.][0-9]", _small_parts, 0.6, r"\bip\b|host|server|address", r"version|release"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][ -]?[0-9]", _card, 0.6, r"card|visa|credit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"[+][0-9]", _count(9, 15), 0.6, r"phone|call|tel\b|mobile|fax"),
    Kind("iban", _iban(), "[A-Z]{2}[0-9]{2}[ A-Z0-9]", lambda m: F.length(F.regexp_replace(m, " ", "")).between(15, 34) & mod97(m), 0.8, r"iban|account|bank", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", lambda m: ~m.rlike("^(000|666|9)|-00-|-0000$"), 0.2, r"\bssn\b|social security", base=False),
)


def _matches(kind: Kind, text: Column) -> Column:
    """Matches of a kind with the length of the gap before each, and the text around."""
    gaps, found = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    # Element by element, so that the text is split as often as written here and not once a match.
    led = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("match"), F.length(g).alias("gap"), F.substring(g, -NEAR, NEAR).alias("before")))
    both = F.zip_with(
        led,
        F.slice(gaps, 2, F.lit(10**9)),
        lambda x, g: F.struct(x["match"].alias("match"), x["gap"].alias("gap"), F.lower(F.concat_ws(" ", x["before"], F.substring(g, 1, NEAR))).alias("near")),
    )
    rows = F.transform(
        F.filter(both, lambda x: x["match"].isNotNull()),
        lambda x, i: F.struct(F.lit(kind.name).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["match"].alias("match"), x["near"].alias("near")),
    )
    return F.when(text.rlike(kind.hint), rows).otherwise(F.array().cast("array<struct<kind:string,i:int,gap:int,match:string,near:string>>"))


def find_spans(documents: DataFrame, id: str = "doc_id", text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Spans as (key, kind, place, start, end, match, score, base); ``place`` is the kind's place in the list.

    ``start`` and ``end`` count characters of the text, the end exclusive. Proposed matches of a kind do not overlap; those
    that fail its check are dropped and not tried again. A proposal counts as part of the text before
    the next one, so every span stands where it was found. ``key`` is that of :func:`row_key`.
    """
    body = F.col("__text")
    named = documents.select(row_key(id, text).alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"))
    proposed = named.where(body.rlike("|".join(sorted({k.hint for k in kinds})))).select("key", F.explode(F.concat(*[_matches(k, body) for k in kinds])).alias("m")).select("key", "m.*")
    # Rows of one key are copies of a document; one is enough.
    once = proposed.repartition("key", "kind").dropDuplicates(["key", "kind", "i"])
    before = W.partitionBy("key", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.sum((F.col("gap") + F.length("match")).cast("bigint")).over(before)
    placed = once.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))
    place = valid = base = score = None
    for n, kind in enumerate(kinds):
        mine, near = F.col("kind") == kind.name, F.col("near")
        points = F.lit(kind.score) + F.when(near.rlike(kind.words), 0.4).otherwise(0.0) - F.when(near.rlike(kind.against), 0.4).otherwise(0.0)
        columns = [(place, F.lit(n)), (valid, kind.valid(F.col("match"))), (base, F.lit(kind.base)), (score, F.least(F.lit(1.0), F.greatest(F.lit(0.0), points)))]
        place, valid, base, score = [F.when(mine, new) if old is None else old.when(mine, new) for old, new in columns]
    scored = placed.where(valid).select("key", "kind", place.alias("place"), "start", "end", "match", F.round(score, 3).alias("score"), base.alias("base"))
    return scored.where(F.col("base") | (F.col("score") >= LEAST_SCORE))


def personal_data(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document: n_email, n_ip, n_card, n_phone, base_sha256, spans, score.

    ``spans`` lists kind:start:end of all spans, base kinds first and in their order, then by start; ``base_sha256`` is of
    the base ones alone; ``score`` is the highest of a span, 0 without any. NULL and empty texts have no
    spans; repeated rows give a row each; a NULL id is kept; other columns are not looked at.
    """
    name = F.concat_ws(":", "kind", "start", "end")
    row = F.struct("place", "start", name.alias("name"))
    counts = [F.sum((F.col("kind") == k.name).cast("bigint")).alias(f"n_{k.name}") for k in KINDS if k.base]
    found = find_spans(documents, id, text).groupBy("key").agg(
        *counts, F.array_sort(F.collect_list(F.when(F.col("base"), row))).alias("base"), F.array_sort(F.collect_list(row)).alias("all"), F.max("score").alias("score")
    )
    keyed = documents.select(F.col(f"`{id}`"), row_key(id, text).alias("__key"))
    out = keyed.join(found.withColumnRenamed("key", "__key"), "__key", "left")
    listed = [F.array_join(F.transform(F.coalesce(c, F.array().cast("array<struct<place:int,start:bigint,name:string>>")), lambda x: x["name"]), ",") for c in ("base", "all")]
    return out.select(
        f"`{id}`",
        *[F.coalesce(f"n_{k.name}", F.lit(0).cast("bigint")).alias(f"n_{k.name}") for k in KINDS if k.base],
        F.sha2(listed[0], 256).alias("base_sha256"),
        listed[1].alias("spans"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )

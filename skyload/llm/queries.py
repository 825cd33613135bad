"""One query for each operator, over whole tables with the parameters meant for use, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyload.llm.archives import archive_pages
from skyload.llm.chats import conversations_read_back
from skyload.llm.decontaminate import contamination
from skyload.llm.langid import predict_held_out
from skyload.llm.licenses import license_scan
from skyload.llm.lineruns import drop_repeated_runs
from skyload.llm.mixing import mix, token_count
from skyload.llm.neardup import near_duplicate_classes
from skyload.llm.packing import pack
from skyload.llm.personal import personal_data
from skyload.llm.phrases import collocations
from skyload.llm.quality import quality
from skyload.llm.repair import repair_damaged

# The mixture's tree: domains by the last digit of a source's name, and weights of the nodes that differ from 1.
DOMAINS = {"web": "012", "books": "345", "wiki": "67"}
OTHER_DOMAIN = "forum"
WEIGHTS = (("domain", "web", 4), ("domain", "books", 2), ("lang", "en", 5), ("lang", "de", 2), ("lang", "fr", 2))
SHARE, EPOCHS, SEED = 0.5, 2, 17


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain_of(source: Column) -> Column:
    """Domain of a source in the query's tree."""
    out = None
    for name, digits in DOMAINS.items():
        here = F.substring(source, -1, 1).isin(*digits)
        out = F.when(here, name) if out is None else out.when(here, name)
    return out.otherwise(OTHER_DOMAIN)


def mixture(spark: SparkSession, documents: DataFrame) -> DataFrame:
    weights = spark.createDataFrame(list(WEIGHTS), "level string, name string, weight bigint")
    return mix(documents, domain_of(F.col("source")), weights, SHARE, EPOCHS, SEED)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(read(spark, sf_dir, "documents"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first"], s["last"], s["edits"])), ",")
    return found.withColumn("spans", spans)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixture(spark, read(spark, sf_dir, "documents"))
    return chosen.select("doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", token_count(F.col("text")).alias("n_tokens"), "n_epochs")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(read(spark, sf_dir, "pages"))


def op5_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its class: the smallest doc_id that links connect it with."""
    classes = near_duplicate_classes(read(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "n_class", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def op6_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversations_read_back(rows.union(spark.createDataFrame(extra, "conv_id bigint, turn bigint, role string, text string")))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_held_out(read(spark, sf_dir, "documents"))


def op8_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"))


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines deleted from each document, and the digest of the text that is left (NULL for a NULL text)."""
    cleaned = drop_repeated_runs(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_deleted", "deleted", F.length("text").cast("bigint").alias("left_chars"), F.sha2("text", 256).alias("left_sha256"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(read(spark, sf_dir, "documents"))


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_damaged(read(spark, sf_dir, "conversations"))


def op12_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_mix_sources,
        op3_decontaminate,
        op4_warc_zip,
        op5_prob_minhash,
        op6_reply_trees,
        op7_language_id,
        op8_compression_bands,
        op9_line_runs,
        op10_personal_data,
        op11_repair_conversations,
        op12_pack_sequences,
        op13_phrase_collocations,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


_DECONTAMINATE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_words("text")} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win
       FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0) x),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM bw) s WHERE len(w) >= n) x),
h AS (SELECT dw.r, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) x GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) x GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.r = d.r LEFT JOIN t ON t.r = d.r
"""

_WARC = """
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM (SELECT page_id, payload, first, octet_length(encode(payload)) >= 100 AND page_id <> first AS again
      FROM (SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages) p) q
"""

_CONTROL = r"[<\[]\\*(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|SYS>>|/SYS>>|INST\]|/INST\])"
_REPLIES = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '{_CONTROL}'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""


def _level(depth: int, source: str) -> str:
    """SQL that shares out the budgets of one level; as :func:`skyload.llm.mixing.fill`."""
    names = ("domain", "lang", "source")
    name, path = names[depth], ", ".join(names[:depth])
    family, group = f"PARTITION BY {path}" if path else "", f"{path}, {name}" if path else name
    line = f"{family} ORDER BY capacity / CAST(weight AS DOUBLE), {name} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    same = " AND ".join(f"s.{c} IS NOT DISTINCT FROM l.{c}" for c in names[: depth + 1])
    return f"""
n{depth} AS (SELECT {group}, max({name}_weight) AS weight, sum(capacity) AS capacity, max(budget) AS budget FROM {source} GROUP BY {group}),
r{depth} AS (SELECT *, budget - coalesce(sum(capacity) OVER ({line}), 0) AS remaining, sum(weight) OVER ({family}) - coalesce(sum(weight) OVER ({line}), 0) AS open_weight FROM n{depth} WHERE weight > 0),
m{depth} AS (SELECT *, capacity * open_weight <= remaining * weight AS is_full FROM r{depth}),
s{depth} AS (SELECT {group}, CASE WHEN is_full THEN capacity ELSE floor(weight * CAST(budget - coalesce(sum(CASE WHEN is_full THEN capacity END) OVER ({family}), 0) AS DOUBLE)
             / sum(CASE WHEN NOT is_full THEN weight END) OVER ({family})) END AS share FROM m{depth}),
l{depth} AS (SELECT l.* EXCLUDE (budget), coalesce(CAST(s.share AS BIGINT), 0) AS budget FROM {source} l LEFT JOIN s{depth} s ON {same})"""


def _weight(level: str) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {weight}" for at, name, weight in WEIGHTS if at == level)
    return f"CASE {level} {cases} ELSE 1 END" if cases else "1"


_DOMAIN = "CASE " + " ".join(f"WHEN right(source, 1) IN ({', '.join(repr(c) for c in digits)}) THEN '{name}'" for name, digits in DOMAINS.items()) + f" ELSE '{OTHER_DOMAIN}' END"
_SAME_LEAF = " AND ".join(f"{{0}}.{c} IS NOT DISTINCT FROM {{1}}.{c}" for c in ("domain", "lang", "source"))
_MIX = rf"""
WITH d AS (SELECT doc_id, {_DOMAIN} AS domain, lang, source, md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(text, '')) AS digest,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents),
g AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY domain, lang, source),
l AS (SELECT *, {_weight("domain")} AS domain_weight, {_weight("lang")} AS lang_weight, {_weight("source")} AS source_weight, tokens * {EPOCHS} AS capacity,
             (SELECT least(floor(sum(tokens) * {SHARE}), sum(tokens) * {EPOCHS}) FROM g) AS budget FROM g),
{_level(0, "l")},
{_level(1, "l0")},
{_level(2, "l1")},
f AS (SELECT domain, lang, source, tokens, budget AS share, CASE WHEN tokens > 0 THEN CAST(floor(budget / CAST(tokens AS DOUBLE)) AS BIGINT) ELSE 0 END AS n_full FROM l2),
p AS (SELECT d.*, f.tokens, f.share, f.n_full, md5('{SEED}:' || CAST(f.n_full AS VARCHAR) || ':' || d.digest) AS place FROM d JOIN f ON {_SAME_LEAF.format("d", "f")}),
q AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM p),
e AS (SELECT *, CASE WHEN share > 0 THEN n_full + CASE WHEN upto <= share - n_full * tokens THEN 1 ELSE 0 END ELSE 0 END AS n_epochs FROM q)
SELECT doc_id, domain, lang, source, n_tokens, CAST(n_epochs AS BIGINT) AS n_epochs FROM e WHERE n_epochs > 0
"""


def _add(value: str, cost: str, letter: str) -> str:
    return f"lpad(CAST(CAST(left({value}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || '{letter}' || substr({value}, 13)"


# States of the role grammar: the state a kept row leads to by its initial, and that of an inserted or re-roled one.
_KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_GIVEN = (2, 2, 3, 2)


def _base(state: int) -> str:
    keeps = " ".join(f"WHEN lower(y) = '{role}' THEN {_add(f'v{to}', 'cut', 'K')}" for role, to in _KEPT[state].items())
    return f"least({_add(f'v{state}', '3', 'D')}, CASE {keeps} END, CASE WHEN y <> 'x' THEN {_add(f'v{_GIVEN[state]}', '2 + cut', 'R')} END)"


def _with_inserts(state: int) -> str:
    once = _GIVEN[state]
    return f"least(b{state}, {_add(f'b{once}', '2', 'I')}, {_add(f'b{_GIVEN[once]}', '4', 'II')})"


_ZERO = "0" * 12
_SPACES = r"\x20\x09-\x0D"
_REPAIR = rf"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
       xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(unicode(c) AS BIGINT))),
           lambda h, c: list_reduce([xor(h, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS draw FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
             CASE draw WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN draw = 3 THEN [1, 2] ELSE [1] END) AS copy
      FROM o WHERE draw <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text)) AS i,
             regexp_extract(text, '([^{_SPACES}])[{_SPACES}]*$', 1) AS ending FROM d),
f AS (SELECT *, CASE WHEN ending = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN ending NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
             CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM r),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
             count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
             list(CASE WHEN fault IN ('b', 'd') THEN 'x' WHEN fault = 't' THEN upper(initial) ELSE initial END ORDER BY i) AS symbols,
             list(role ORDER BY i) AS roles, list(text ORDER BY i) AS texts FROM f GROUP BY conv_id),
v AS (SELECT conv_id, symbols, len(symbols) AS i, '{_ZERO}' AS v0, '{_ZERO[:-1]}4II' AS v1, '{_ZERO[:-1]}2I' AS v2, '{_ZERO}' AS v3 FROM c
      UNION ALL
      SELECT conv_id, symbols, i - 1, {", ".join(_with_inserts(s) for s in range(4))}
      FROM (SELECT conv_id, symbols, i, {", ".join(f"{_base(s)} AS b{s}" for s in range(4))}
            FROM (SELECT *, symbols[i] AS y, CASE WHEN symbols[i] = upper(symbols[i]) THEN 1 ELSE 0 END AS cut FROM v WHERE i > 0) y) b),
a AS (SELECT c.*, CAST(left(v0, 12) AS BIGINT) AS cost, substr(v0, 13) AS audit FROM c JOIN v ON v.conv_id IS NOT DISTINCT FROM c.conv_id AND v.i = 0),
w AS (SELECT conv_id, audit, roles, texts, 1 AS p, 0 AS i, 0 AS state, CAST([] AS VARCHAR[]) AS lines FROM a
      UNION ALL
      SELECT conv_id, audit, roles, texts, p + 1, CASE WHEN edit = 'I' THEN i ELSE i + 1 END, CASE WHEN edit = 'D' THEN state ELSE to_state END,
             CASE edit WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, roles[i + 1] || ':' || texts[i + 1])
                       ELSE list_append(lines, CASE to_state WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || CASE edit WHEN 'R' THEN texts[i + 1] ELSE '' END) END
      FROM (SELECT *, substr(audit, p, 1) AS edit,
                   CASE WHEN state = 2 THEN 3 WHEN state = 0 AND substr(audit, p, 1) = 'K' AND left(roles[i + 1], 1) = 's' THEN 1 ELSE 2 END AS to_state FROM w WHERE p <= length(audit)) e),
s AS (SELECT conv_id, sha256(array_to_string(lines, chr(10))) AS repaired_sha256 FROM w WHERE p = length(audit) + 1)
SELECT n.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) n LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM n.conv_id
"""

_COLLOCATIONS = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
g AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
      FROM (SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM w CROSS JOIN (SELECT unnest(range(1, 6)) AS size) s WHERE len(w) >= size) x),
f AS (SELECT lang, size, phrase, count(*) AS a FROM g GROUP BY lang, size, phrase HAVING count(*) >= 100),
c AS (SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS tail
      FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM f WHERE size > 1) x),
s AS (SELECT c.lang, c.size, c.phrase, c.a, l.a AS l, r.a AS r, n.n, CAST(1000 AS HUGEINT) * c.a * n.n // (CAST(l.a AS HUGEINT) * r.a) AS score,
             row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY CAST(1000 AS HUGEINT) * c.a * n.n // (CAST(l.a AS HUGEINT) * r.a), k) AS place
      FROM c JOIN f l ON l.lang = c.lang AND l.phrase = c.head JOIN f r ON r.lang = c.lang AND r.phrase = c.tail JOIN n ON n.lang = c.lang),
o AS (SELECT * FROM s WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM f q WHERE q.lang = s.lang AND q.size > s.size AND q.a >= s.a AND contains(' ' || q.phrase || ' ', ' ' || s.phrase || ' '))),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM t WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op2_mix_sources": _MIX,
    "op3_decontaminate": _DECONTAMINATE,
    "op4_warc_zip": _WARC,
    "op6_reply_trees": _REPLIES,
    "op11_repair_conversations": _REPAIR,
    "op13_phrase_collocations": _COLLOCATIONS,
}

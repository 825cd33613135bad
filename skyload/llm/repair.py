"""Conversation structure repair with an automaton that shares suffixes.

A conversation is a string with one symbol a row: the initial of its role, and whether the row ends well, is truncated, or
must be deleted. The strings of all conversations are minimised from the end: conversations that end alike
share the nodes of their common suffix. For each node and state of the role grammar the least cost to go and
the best audit suffix are worked out once, from those of the node behind it.

Strings are put in the order of their reverses and dealt out by ranges of it, so those that share a suffix are
neighbours, and a task needs to hold only the nodes of the string it is at. Conversations longer than ``SEGMENT`` rows are several
strings; those before the last are worked out for each state in which they can end, and their costs are added up from the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyload.session import release, stable

# Rows of one string of the automaton, at most.
SEGMENT = 1024
# Copies of the automaton's values that strings are joined with.
SALTS = 16
BLANK = " \t\n\x0b\x0c\r"
# Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

# States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a. Roles that may follow, with the state then,
# and the one role of these that can be given to a row or inserted.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
FOLLOWS = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
GIVEN = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
NAMES = {AFTER_U: "user", AFTER_A: "assistant"}
MUST_GO = "x"

# A cost with the audit that has it, so that of equal costs the least audit is the smaller.
Best = tuple[int, str] | None


def step(symbol: str, behind: list[Best]) -> list[Best]:
    """Least cost and audit from each state, for a row before a node with the values ``behind``.

    Edits put a row's inserts before it.
    """

    def after(cost: int, letter: str, best: Best) -> Best:
        return None if best is None else (best[0] + cost, letter + best[1])

    left = TRUNCATED if symbol.isupper() else 0
    made: list[Best] = []
    for state in range(4):
        ways = [after(DELETE, "D", behind[state])]
        if symbol != MUST_GO:
            if (to := FOLLOWS[state].get(symbol.lower())) is not None:
                ways.append(after(left, "K", behind[to]))
            ways.append(after(REROLE + left, "R", behind[GIVEN[state]]))
        made.append(min((w for w in ways if w), default=None))
    return _inserted(made)


def _inserted(values: list[Best]) -> list[Best]:
    out = []
    for state in range(4):
        ways = [values[state]]
        for n in (1, 2):
            state = GIVEN[state]
            if values[state] is not None:
                ways.append((values[state][0] + INSERT * n, "I" * n + values[state][1]))
        out.append(min((w for w in ways if w), default=None))
    return out


# Behind the last row of a conversation, and behind a string that ends in a given state.
_END = [_inserted([(0, "") if state in (START, AFTER_A) else None for state in range(4)])]
_IN_STATE = [[(0, "") if state == end else None for state in range(4)] for end in range(4)]


class Automaton:
    """Values of the nodes on the path of one string, read from its end; strings come in the order of their reverses."""

    def __init__(self, last: bool):
        self.path, self.nodes = "", [_END if last else _IN_STATE]

    def values(self, back: str) -> list[list[Best]]:
        """For each state in which the string can end (or for the end of the conversation), the values of its first node."""
        shared = 0
        for x, y in zip(self.path, back, strict=False):
            if x != y:
                break
            shared += 1
        del self.nodes[shared + 1 :]
        for symbol in back[shared:]:
            self.nodes.append([step(symbol, behind) for behind in self.nodes[-1]])
        self.path = back
        return self.nodes[-1]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for rows in (batch.slice(at, 4096) for at in range(0, batch.num_rows, 4096)):
            yield from zip(*[c.to_pylist() for c in rows.columns], strict=True)


def _batches(rows: Iterator[tuple], fields: dict[str, pa.DataType], size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, fields.values(), strict=True)], names=list(fields))

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held = []
    if held:
        yield made()


def _stream(df: DataFrame, compute: Callable[[Iterator[tuple]], Iterator[tuple]], fields: dict[str, tuple[str, pa.DataType]], size: int = 4096) -> DataFrame:
    """What ``compute`` makes of the rows of each task, one after the other."""
    kinds = {name: kind for name, (_, kind) in fields.items()}
    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in fields.items())
    return df.mapInArrow(lambda batches: _batches(compute(_rows(batches)), kinds, size), schema)


_TEXT, _LONG, _BOOL = ("string", pa.string()), ("bigint", pa.int64()), ("boolean", pa.bool_())
_LONGS, _TEXTS = ("array<bigint>", pa.list_(pa.int64())), ("array<string>", pa.list_(pa.string()))


def group_key(conversation: str) -> Column:
    """A conversation's name; NULL is one as well, unlike all others."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{conversation}`").cast("string")), F.lit(""))


def _read(rows: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """(key, turn, role, text, digest of role and text), NULL roles and texts as one blank."""
    named = rows.select(
        group_key(conversation).alias("key"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" ")).alias("text"),
    )
    return named.withColumn("digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))


def _ordered(read: DataFrame) -> DataFrame:
    """(key, turn, role, digest, blank, closed, n, at): distinct rows, how often each occurs, and its place.

    ``at`` goes up in a conversation, in steps of ``n`` where one task holds the conversation. Rows are dealt out by ranges of their order, so that
    a conversation of any length is spread.
    """
    end = F.right(F.rtrim("text", F.lit(BLANK)), F.lit(1))
    light = read.select("key", "turn", "role", "digest", (end == "").alias("blank"), end.isin(".", "!", "?").alias("closed"))
    counted = light.groupBy(*light.columns).agg(F.count(F.lit(1)).alias("n"))
    order = ["key", F.asc_nulls_first("turn"), "role", "digest"]

    def placed(rows: Iterator[tuple]) -> Iterator[tuple]:
        at = TaskContext.get().partitionId() << 40
        for row in rows:
            yield (*row, at)
            at += row[-1]

    fields = {"key": _TEXT, "turn": _LONG, "role": _TEXT, "digest": _TEXT, "blank": _BOOL, "closed": _BOOL, "n": _LONG, "at": _LONG}
    return stable(_stream(counted.repartitionByRange(*order).sortWithinPartitions(*order), placed, fields))


def _marked(ordered: DataFrame) -> DataFrame:
    """With ``original``: whether no row before has the same role and text, but for the row's own copies."""
    firsts = ordered.groupBy("key", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("original"))
    return stable(ordered.join(firsts, "at", "left").withColumn("original", F.coalesce("original", F.lit(False))))


def _segments(marked: DataFrame, segment: int) -> DataFrame:
    """(key, at, signature, first, last, illegal): strings of at most ``segment`` rows, cut from the end of each task's part of a conversation.

    ``first`` and ``last`` are initials of roles; ``illegal`` counts neighbours within the string whose initials do not follow each other.
    """
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = F.when(F.col("blank") | ~F.col("original"), MUST_GO).when(F.col("closed"), known).otherwise(F.upper(known))
    rows = marked.select(F.shiftright("at", 40).alias("part"), "at", "key", "n", known.alias("initial"), symbol.alias("symbol"))

    def cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        part = key = None
        at, symbols, initials, illegal = 0, [], [], 0

        def made() -> tuple:
            return (key, at, "".join(reversed(symbols)), initials[-1], initials[0], illegal)

        for row_part, row_at, row_key, n, initial, symbol in rows:
            if (row_part, row_key) != (part, key) and symbols:
                yield made()
                symbols, initials, illegal = [], [], 0
            part, key = row_part, row_key
            # The last copies come first; they must go.
            for copy in range(n - 1, -1, -1):
                if len(symbols) == segment:
                    yield made()
                    symbols, initials, illegal = [], [], 0
                if initials and initial + initials[-1] not in ("su", "ua", "au"):
                    illegal += 1
                at = row_at + copy
                symbols.append(symbol if copy == 0 else MUST_GO)
                initials.append(initial)
        if symbols:
            yield made()

    fields = {"key": _TEXT, "at": _LONG, "signature": _TEXT, "first": _TEXT, "last": _TEXT, "illegal": _LONG}
    dealt = rows.repartition("part").sortWithinPartitions(F.desc("part"), F.desc("at"))
    line = W.partitionBy("key").orderBy("at")
    cuts = _stream(dealt, cut, fields).withColumn("next", F.lead("first").over(line)).withColumn("string", F.row_number().over(line))
    bad = F.col("illegal") + (~F.concat("last", "next").isin("su", "ua", "au")).cast("bigint")
    return stable(cuts.select("key", "at", "signature", F.col("next").isNull().alias("is_last"), (F.col("string") == 1).alias("is_first"), F.coalesce(bad, "illegal").alias("illegal")))


def automaton_values(strings: DataFrame) -> DataFrame:
    """(signature, is_last, costs, audits) of distinct strings, by entry state; for strings that are not last by final state before that."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        automata = {last: Automaton(last) for last in (False, True)}
        for back, last in rows:
            found = [best for values in automata[last].values(back) for best in values]
            yield (back[::-1], last, [b and b[0] for b in found], [b and b[1] for b in found])

    fields = {"signature": _TEXT, "is_last": _BOOL, "costs": _LONGS, "audits": _TEXTS}
    distinct = strings.select(F.reverse("signature").alias("back"), "is_last").distinct()
    return stable(_stream(distinct.repartitionByRange("back", "is_last").sortWithinPartitions("back", "is_last"), run, fields, 64))


def _chained(strings: DataFrame) -> DataFrame:
    """(key, at, entry, cost, audit) of strings that are not alone in their conversation; ``cost`` is that of the whole conversation."""

    def costs(rows: Iterator[tuple]) -> Iterator[tuple]:
        to_go: list[int | None] = []
        for key, at, first, last, cost, audits in rows:
            ends = [0, 0, 0, 0]
            if not last:
                ways = [[(cost[4 * end + state] + to_go[end], audits[4 * end + state], end) for end in range(4) if cost[4 * end + state] is not None and to_go[end] is not None] for state in range(4)]
                best = [min(w, default=(None, None, 0)) for w in ways]
                cost, audits, ends = [b[0] for b in best], [b[1] for b in best], [b[2] for b in best]
            to_go = cost
            yield (key, at, first, last, cost, audits, ends)

    def states(rows: Iterator[tuple]) -> Iterator[tuple]:
        state = total = 0
        for key, at, first, _, cost, audits, ends in rows:
            if first:
                state, total = START, cost[START]
            yield (key, at, state, total, audits[state])
            state = ends[state]

    fields = {"key": _TEXT, "at": _LONG, "is_first": _BOOL, "is_last": _BOOL, "costs": _LONGS, "audits": _TEXTS}
    back = _stream(strings.select(*fields).repartition("key").sortWithinPartitions("key", F.desc("at")), costs, fields | {"ends": _LONGS}, 64)
    forth = stable(back).repartition("key").sortWithinPartitions("key", "at")
    return _stream(forth, states, {"key": _TEXT, "at": _LONG, "entry": _LONG, "cost": _LONG, "audit": _TEXT}, 256)


def _audits(segments: DataFrame) -> DataFrame:
    """(key, at, entry, cost, audit) of each string."""
    values = automaton_values(segments)
    # The string that a third of all conversations are goes to several tasks.
    copies = values.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = segments.withColumn("salt", F.pmod(F.hash("key"), F.lit(SALTS)))
    strings = stable(spread.join(copies, ["signature", "is_last", "salt"]))
    alone = strings.where("is_first and is_last").select("key", "at", F.lit(START).cast("bigint").alias("entry"), F.col("costs")[START].alias("cost"), F.col("audits")[START].alias("audit"))
    return stable(alone.unionByName(_chained(strings.where("not (is_first and is_last)"))))


def _lines(audits: DataFrame) -> DataFrame:
    """(key, at, place, edit, role) of each line that a repaired conversation has, NULL for a kept row's own role.

    ``at`` is the row's, or for an insert that of the row it stands before (after the last one: one more); ``place`` orders lines of one ``at``.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, at, state, audit, signature in rows:
            row = place = 0
            for edit in audit:
                if edit == "D":
                    row, place = row + 1, 0
                    continue
                state = FOLLOWS[state][signature[row].lower()] if edit == "K" else GIVEN[state]
                yield (key, at + row, place, edit, None if edit == "K" else NAMES[state])
                row, place = (row, place + 1) if edit == "I" else (row + 1, 0)

    fields = {"key": _TEXT, "at": _LONG, "place": _LONG, "edit": _TEXT, "role": _TEXT}
    return _stream(audits.select("key", "at", "entry", "audit", "signature"), run, fields)


def repair(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """Conversations as (key, gaps, blank, duplicate, truncated, illegal, cost, audit), and their repaired rows (key, at, place, edit, role, text).

    Rows go by ``turn`` (NULL first), equal ones by role and digest of role and text; copies of a row are rows. NULL roles and texts
    are one blank, and NULL is a conversation (see :func:`group_key`). A row's fault is the first of: blank; duplicate, of an earlier row of its
    conversation with the same role and text; truncated, if the last character that is not white space is none of ``.!?``. ``gaps`` are turns that
    are missing between the first and the last. ``illegal`` counts neighbours whose roles' initials are not su, ua or au; an empty role has none.

    ``audit`` has the initials of the edits (Keep, Rerole, Delete, Insert) of least cost after which roles are ``(s?(ua)+)?`` by initials, of
    equally cheap ones the least. Repaired rows of a conversation go by ``at`` and ``place``; inserted ones have an empty text. A table without rows gives none
    of either; other columns are not looked at.
    """
    read = _read(rows, conversation, turn, role, text)
    ordered = _ordered(read)
    marked = _marked(ordered)
    release(ordered)
    segments = _segments(marked, segment)
    audits = _audits(segments)

    # The first of a row's copies is none of an earlier row, if the row is not.
    copies = F.when(F.col("original"), F.col("n") - 1).otherwise(F.col("n"))
    faults = marked.groupBy("key").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), copies).otherwise(0)).alias("duplicate"),
        F.sum((F.col("original") & ~F.col("blank") & ~F.col("closed")).cast("bigint")).alias("truncated"),
    )
    turns = marked.where(F.col("turn").isNotNull()).groupBy("key", "turn").agg(F.lit(1).cast("bigint").alias("one"))
    gaps = turns.groupBy("key").agg((F.max("turn") - F.min("turn") + 1 - F.sum("one")).alias("gaps"))
    illegal = segments.groupBy("key").agg(F.sum("illegal").alias("illegal"))
    told = audits.groupBy("key").agg(
        F.max("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "audit"))), lambda s: s["audit"]), "").alias("audit"),
    )
    found = faults.join(gaps, "key", "left").join(illegal, "key").join(told, "key")
    found = found.select("key", F.coalesce("gaps", F.lit(0).cast("bigint")).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    lines = stable(_lines(audits.join(segments.select("key", "at", "signature"), ["key", "at"])))
    inserted = lines.where("edit = 'I'").withColumn("text", F.lit(""))
    own = marked.select("at", F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("turn"), "digest", F.col("role").alias("own"))
    kept = lines.where("edit <> 'I'").join(own, "at").select("key", "at", "place", "edit", F.coalesce("role", "own").alias("role"), "turn", "digest")
    texts = read.select("key", F.coalesce(F.col("turn").cast("string"), F.lit("")).alias("turn"), "digest", "text").dropDuplicates(["key", "turn", "digest"])
    repaired = kept.join(texts, ["key", "turn", "digest"]).select("key", "at", "place", "edit", "role", "text")
    return found, repaired.unionByName(inserted)


def line_digests(repaired: DataFrame) -> DataFrame:
    """(key, sha256) of the repaired rows of each conversation, as ``role:text`` with line ends between.

    Rows run through a task in order, so one of them is in memory at a time, whatever the length of a conversation.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        key, digest = None, None
        for row_key, role, text in rows:
            line = f"{role}:{text}".encode("utf-8", "replace")
            if row_key != key or digest is None:
                if digest is not None:
                    yield (key, digest.hexdigest())
                key, digest = row_key, hashlib.sha256(line)
            else:
                digest.update(b"\n")
                digest.update(line)
        if digest is not None:
            yield (key, digest.hexdigest())

    ordered = repaired.select("key", "role", "text", "at", "place").repartition("key").sortWithinPartitions("key", "at", "place").select("key", "role", "text")
    return _stream(ordered, run, {"key": _TEXT, "repaired_sha256": _TEXT})


def damage(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (of those four columns) with faults drawn by a checksum of conversation and turn, for trials of :func:`repair`.

    One in twenty each is dropped, emptied, loses its ``.!?``, is repeated, and becomes a user's. NULLs count as one blank.
    """
    one = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))
    draw = F.pmod(F.crc32(F.concat(one(conversation), F.lit(":"), one(turn)).cast("binary")), F.lit(20))
    drawn = rows.select(F.col(f"`{conversation}`"), F.col(f"`{turn}`"), one(role).alias(role), one(text).alias(text), draw.alias("__draw")).where("__draw <> 0")
    body = F.when(F.col("__draw") == 1, "").when(F.col("__draw") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text))
    times = F.when(F.col("__draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return drawn.withColumn("__time", F.explode(times)).select(conversation, turn, F.when(F.col("__draw") == 4, "user").otherwise(F.col(role)).alias(role), body.alias(text))


def repair_damaged(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Damage conversations and repair them: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    A conversation of which no row is left has zeros, an empty audit and the digest of an empty text.
    """
    found, repaired = repair(damage(rows, conversation, turn, role, text), conversation, turn, role, text)
    told = found.join(line_digests(repaired), "key", "left")
    every = rows.select(F.col(f"`{conversation}`").alias("__name"), group_key(conversation).alias("key")).distinct()
    numbers = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")
    return every.join(told, "key", "left").select(F.col("__name").alias(conversation), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), digest)

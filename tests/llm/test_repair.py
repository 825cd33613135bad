import hashlib
import heapq
import random

import pytest
from pyspark.sql import functions as F

from skyload.llm.repair import Automaton, automaton_values, damage, line_digests, repair, repair_damaged

SCHEMA = "conv_id bigint, turn bigint, role string, text string, key string, at int"
BLANKS = " \t\n\x0b\x0c\r"


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(BLANKS)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _cheapest(rows, faults):
    """The cheapest edits by search over all of them: (cost, audit, lines)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, lines
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        given = {"u": "user", "a": "assistant"}[allowed[-1]]
        heapq.heappush(heap, (cost + 2, audit + "I", i, given[0], (*lines, given + ":")))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, lines))
            if faults[i] not in ("blank", "duplicate"):
                left = faults[i] == "truncated"
                heapq.heappush(heap, (cost + 2 + left, audit + "R", i + 1, given[0], (*lines, f"{given}:{text}")))
                if role and role[0] in allowed:
                    heapq.heappush(heap, (cost + left, audit + "K", i + 1, role[0], (*lines, f"{role}:{text}")))


def _digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def _plain(rows):
    """What :func:`repair` says of one conversation's (turn, role, text) rows, and the digest of its lines."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], _digest(r[1], r[2])))
    turns = {t for t, _, _ in rows if t is not None}
    named = [r[1:] for r in rows]
    faults = _faults(named)
    cost, audit, lines = _cheapest(named, faults)
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(named, named[1:])]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _table(draw, conversations):
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "s", "", None]
    texts = ["Yes.", "No!", "so", "what?", "", " \n", None, "end. \t", "é…"]
    rows = []
    for c in range(conversations):
        for t in range(draw.randint(1, 9)):
            turn = None if draw.random() < 0.05 else t + draw.randint(0, 1)
            row = (None if c == 3 else c, turn, draw.choice(roles), draw.choice(texts), "x", 0)
            rows += [row] * (draw.randint(2, 4) if draw.random() < 0.1 else 1)
    return rows


def _got(spark, rows, segment):
    found, repaired = repair(spark.createDataFrame(rows, SCHEMA).repartition(3), segment=segment)
    told = found.join(line_digests(repaired), "key", "left").select("key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)))
    return {r[0]: tuple(r)[1:] for r in told.collect()}


@pytest.mark.parametrize("segment", [1024, 3, 1])
def test_same_as_search_over_all_edits(spark, segment):
    rows = _table(random.Random(7 + segment), 120)
    wanted = {}
    for r in rows:
        wanted.setdefault("" if r[0] is None else f"={r[0]}", []).append(r[1:4])
    assert _got(spark, rows, segment) == {key: _plain(mine) for key, mine in wanted.items()}


def test_one_conversation_holds_most_rows(spark):
    draw = random.Random(3)
    long = [(5, t, draw.choice(["user", "assistant", "user", "tool"]), f"{draw.randint(0, 900)}" + draw.choice([".", ""]), "x", 0) for t in range(3000)]
    rows = long + [(c, 0, "user", "Hi.", "x", 0) for c in range(100, 400)]
    got = _got(spark, rows, 100)
    assert got == _got(spark, rows, 5000)
    cost, audit = got["=5"][5:7]
    assert got["=100"][5:7] == (2, "KI") and cost <= 3 * 3000 and sum(e != "I" for e in audit) == 3000


def test_many_equal_rows(spark):
    rows = [(1, 0, "user", "Hi.", "x", 0)] * 2500 + [(1, 1, "assistant", "Yes.", "x", 0)]
    assert _got(spark, rows, 1024)["=1"][1:7] == (0, 2499, 0, 2499, 3 * 2499, "K" + "D" * 2499 + "K")


def test_nodes_of_common_suffixes_are_made_once():
    automaton = Automaton(last=True)
    automaton.values("auauau")
    shared = automaton.nodes[4]
    automaton.values("auauxs")
    assert automaton.nodes[4] is shared and len(automaton.nodes) == 7


def test_values_of_strings(spark):
    strings = spark.createDataFrame([("ua", True), ("ua", True), ("u", False), ("x", True)], "signature string, is_last boolean")
    got = {(r["signature"], r["is_last"]): r for r in automaton_values(strings).collect()}
    assert len(got) == 3 and got["ua", True]["costs"][0] == 0 and got["ua", True]["audits"][0] == "KK"
    assert got["x", True]["audits"][:2] == ["D", "DII"]
    # From the start to after a user's row.
    assert got["u", False]["costs"][2 * 4] == 0 and got["u", False]["audits"][2 * 4] == "K"


def test_damage_of_every_kind(spark):
    rows = [(c, t, "assistant", "Yes. No!", "x", 0) for c in range(30) for t in range(10)]
    counts = {}
    got = damage(spark.createDataFrame(rows, SCHEMA)).collect()
    for r in got:
        counts.setdefault((r["conv_id"], r["turn"]), []).append((r["role"], r["text"]))
    import zlib

    for c, t, role, text, *_ in rows:
        draw = zlib.crc32(f"{c}:{t}".encode()) % 20
        wanted = {0: None, 1: [(role, "")], 2: [(role, "Yes No")], 3: [(role, text)] * 2, 4: [("user", text)]}.get(draw, [(role, text)])
        assert counts.get((c, t)) == wanted


def test_dropped_null_and_no_conversations(spark):
    dropped = next((c, t) for c in range(99) for t in range(9) if __import__("zlib").crc32(f"{c}:{t}".encode()) % 20 == 0)
    rows = [(*dropped, "user", "Hi.", "x", 0), (None, None, None, None, "x", 0)]
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_damaged(spark.createDataFrame(rows, SCHEMA)).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert got[dropped[0]] == (0, 0, 0, 0, 0, 0, "", nothing)
    # Damage of the row without a conversation: NULL stands for a blank in the checksum.
    assert got[None][-1] == nothing and got[None][1] in (0, 1, 2)
    assert repair_damaged(spark.createDataFrame([], SCHEMA)).collect() == []

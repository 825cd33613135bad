import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skyload.llm.chats import CLOSE, OPEN, conversations_read_back, escape, format_paths, learned_text, read_turns, reply_paths, unescape
from tests.llm import brute

TREE = "tree bigint, message string, parent string, score double, role string, text string"
BITS = ["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "|im_start|>", "|im_end|>", "SYS>>", "<", "\n", "é", "😀", "$1", "a"]


def _strings(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(BITS, k=draw.randint(0, 12))) for _ in range(n)]


def test_escape_is_reversible(spark):
    rows = spark.createDataFrame([(t,) for t in _strings(2000, 1)], "t string").select("t", escape(F.col("t")).alias("e")).withColumn("back", unescape(F.col("e"))).collect()
    assert all(r["back"] == r["t"] for r in rows)
    assert not any(mark in r["e"] for r in rows for mark in (OPEN, CLOSE, "</s>", "<s>", "[INST]", "[/INST]", "<SYS>>"))


def test_chains_read_back(spark):
    texts = _strings(300, 2)
    draw = random.Random(3)
    rows = [(draw.choice([1, 2, 3, None]), draw.choice([0, 1, 2, None, i]), draw.choice(["user", "assistant", "system", "a\nb\\n", None]), draw.choice([t, None]), "x", 1) for i, t in enumerate(texts)]
    rows += [(4, 0, "assistant", "one", "x", 1), (5, 0, "user", "again", "x", 1), (5, 0, "user", "again", "x", 1)]
    rows += [(6, i, "assistant" if i % 2 else "user", "t" * (i % 7), "x", 1) for i in range(1000)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, message string, tree int").repartition(4)
    got = {r["conv_id"]: tuple(r)[1:5] for r in conversations_read_back(table).collect()}
    chats = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        chats[c].append((-1 if turn is None else turn, role or "", text or "", (role is not None, text is not None)))
    for c, turns in chats.items():
        turns.sort(key=lambda t: (t[0], t[3][0], t[1], t[3][1], t[2]))
        learned = "".join(t[2] for t in turns if t[1] == "assistant")
        assert got[c] == (len(turns), brute.sha("".join(f"{t[1]}\n{t[2]}\n" for t in turns)), len(learned), brute.sha(learned)), c
    assert len(got) == len(chats)
    assert conversations_read_back(table.limit(0)).count() == 0


def _messages():
    draw = random.Random(5)
    rows = []
    for tree in range(6):
        names = [f"{tree}-{i}" for i in range(40)]
        for i, name in enumerate(names):
            parent = draw.choice(names[:i]) if i else None
            rows.append((tree, name, parent, draw.choice([None, 0.5, 1.0, 2.0]), draw.choice(["user", "assistant"]), f"text {name} <s>"))
    rows += [(10, "c1", "c2", 1.0, "user", "circle"), (10, "c2", "c1", 1.0, "user", "circle"), (11, "o1", "lost", 1.0, "user", "orphan"), (11, "o2", "o1", 1.0, "assistant", None), (12, "k", "0-0", 1.0, "user", "other tree"), (None, "n", None, None, None, "x")]
    return rows


@pytest.mark.parametrize("branches", [1, 3])
def test_branches_by_score(spark, branches):
    rows = _messages()
    messages = spark.createDataFrame(rows, TREE).repartition(3)
    made = format_paths(reply_paths(messages, branches), messages).select("tree", "leaf", "rank", "formatted", "spans", read_turns(F.col("formatted")).alias("turns"), learned_text(F.col("formatted"), F.col("spans")).alias("learned")).collect()
    got = {(r["tree"], r["rank"]): (r["leaf"], [(t["role"], t["text"]) for t in r["turns"]]) for r in made}
    known = {r[1]: r for r in rows}
    parent = {r[1]: r[2] if r[2] in known and known[r[2]][0] == r[0] else None for r in rows}
    wanted = {}
    for tree in {r[0] for r in rows}:
        names = [r[1] for r in rows if r[0] == tree]
        scored = []
        for leaf in set(names) - set(parent.values()):
            path = [leaf]
            while parent[path[-1]]:
                path.append(parent[path[-1]])
            scored.append((-sum(known[p][3] or 0.0 for p in path) / len(path), leaf, path[::-1]))
        for rank, (_, leaf, path) in enumerate(sorted(scored)[:branches], 1):
            wanted[tree, rank] = (leaf, [(known[p][4] or "", known[p][5] or "") for p in path])
    assert got == wanted
    for r in made:
        texts = [(r["formatted"][s["start"] : s["end"]], s["learn"]) for s in r["spans"]]
        assert [t.replace("<\\s>", "<s>") for t, _ in texts] == [t["text"] for t in r["turns"]]
        assert "".join(t for t, learn in texts if learn).replace("<\\s>", "<s>") == r["learned"]
        assert all(r["formatted"][s["turn"] :].startswith(OPEN) for s in r["spans"])

"""Reply trees as conversations, with DataFrame functions alone.

Messages point to the one they reply to. Self-joins that double their reach follow these pointers, so that a chain of
n replies takes about log2(n) joins: they give each leaf's score along its path, and then, for the branches chosen, the
messages from root to leaf. Each path is formatted as one conversation, with a mask of what a model is to learn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyload.session import release, stable

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# Strings that this and other templates give a meaning, without their first character, which is < or [.
CONTROL = r"\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|SYS>>|/SYS>>|INST\]|/INST\]"


def escape(text: Column) -> Column:
    """Put a backslash after the first character of each control string, and of each that has some already."""
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL})", r"$1$2\\$3")


def unescape(text: Column) -> Column:
    """Undo :func:`escape`."""
    return F.regexp_replace(text, rf"([<\[])(\\*)\\({CONTROL})", "$1$2$3")


def _role(role: Column) -> Column:
    """A role in one line."""
    one = F.replace(F.replace(F.coalesce(role, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(one)


def _unrole(role: Column) -> Column:
    parts = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def reply_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """Messages on the chosen root-to-leaf paths: (tree, leaf, rank, depth_below_leaf, message).

    ``messages`` has (tree, message, parent, score); ``message`` is unique. A message whose parent is NULL or missing, or
    lies in another tree, is a root; one without replies is a leaf. Leaves of a tree are ranked by the mean score along their path
    (NULL counts 0), then by name, and the first ``branches`` are kept. Messages that reply in a circle are on
    no such path.
    """
    ids = messages.select("tree", "message", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    up = ids.select(F.col("tree").alias("up_tree"), F.col("message").alias("up"))
    known = ids.join(up, (F.col("parent") == F.col("up")) & F.col("tree").eqNullSafe(F.col("up_tree")), "left")
    base = stable(known.select("tree", "message", F.col("up").alias("to"), "score"))
    limit = max(1, base.count()).bit_length()

    # jumps[i]: from a message 2**i replies up, where there are so many, and the scores passed on the way. A message
    # whose jump ends below so many others is done: its path goes on as that of the message reached.
    active = stable(base.where(F.col("to").isNotNull()).select("message", "to", F.col("score").alias("total"), F.lit(1).cast("bigint").alias("n")))
    reached = stable(base.where(F.col("to").isNull()).select("message", F.col("score").alias("total"), F.lit(1).cast("bigint").alias("n")))
    jumps: list[DataFrame] = []
    while len(jumps) <= limit and not active.isEmpty():
        jumps.append(active)
        ahead = active.select(F.col("message").alias("to"), F.col("to").alias("far"), F.col("total").alias("more"), F.col("n").alias("n_more"))
        whole = reached.select(F.col("message").alias("to"), F.col("total").alias("more"), F.col("n").alias("n_more"))
        summed = ["message", (F.col("total") + F.col("more")).alias("total"), (F.col("n") + F.col("n_more")).alias("n")]
        ended = active.join(ahead.select("to"), "to", "left_anti")
        reached = reached.unionByName(stable(ended.join(whole, "to").select(*summed)))
        active = stable(active.join(ahead, "to").select(*summed, F.col("far").alias("to")))
    replied = base.where(F.col("to").isNotNull()).select(F.col("to").alias("message")).distinct()
    leaves = reached.join(replied, "message", "left_anti").join(base.select("tree", "message"), "message")
    scored = leaves.select("tree", F.col("message").alias("leaf"), (F.col("total") / F.col("n")).alias("score"))
    # Best of each part of a tree first, so that no tree's leaves meet in one task.
    part = F.pmod(F.xxhash64("leaf"), F.lit(64))
    order = [F.desc("score"), F.col("leaf")]
    best = scored.withColumn("rank", F.row_number().over(W.partitionBy("tree", part).orderBy(*order))).where(F.col("rank") <= branches)
    chosen = best.withColumn("rank", F.row_number().over(W.partitionBy("tree").orderBy(*order))).where(F.col("rank") <= branches)

    paths = stable(chosen.select("tree", "leaf", "rank", F.lit(0).cast("bigint").alias("below"), F.col("leaf").alias("message")))
    for i, jump in enumerate(jumps):
        higher = paths.join(jump.select("message", "to"), "message").select("tree", "leaf", "rank", (F.col("below") + 2**i).alias("below"), F.col("to").alias("message"))
        old, paths = paths, stable(paths.unionByName(higher))
        release(old)
    for jump in jumps:
        release(jump)
    return paths


def format_paths(paths: DataFrame, messages: DataFrame, learned: str = "assistant") -> DataFrame:
    """One conversation for each path: (tree, leaf, rank, formatted, spans).

    A turn is ``<|im_start|>role``, a line end, the text with control strings escaped, ``<|im_end|>`` and a line end; NULL
    roles and texts are empty. ``spans`` gives, for each turn, where it begins in ``formatted`` (``turn``), where its
    text stands in it (``start``, ``end`` exclusive), all in characters, and whether the loss counts there (``learn``: roles equal to ``learned``).
    """
    role, text = F.coalesce("role", F.lit("")), escape(F.coalesce("text", F.lit("")))
    turns = messages.select("message", _role(F.col("role")).alias("head"), text.alias("body"), (role == learned).alias("learn"))
    piece = F.concat(F.lit(OPEN), "head", F.lit("\n"), "body", F.lit(CLOSE + "\n"))
    line = W.partitionBy("tree", "leaf", "rank").orderBy(F.desc("below"))
    upto = F.sum(F.length("piece").cast("bigint")).over(line)
    placed = paths.join(turns, "message").withColumn("piece", piece).withColumn("end", upto - len(CLOSE) - 1).withColumn("turn", upto - F.length("piece"))
    span = F.struct("turn", (F.col("end") - F.length("body")).alias("start"), "end", "learn")
    told = placed.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list(F.struct(span.alias("span"), "piece"))).alias("turns"))
    return told.select("tree", "leaf", "rank", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), F.transform("turns", lambda t: t["span"]).alias("spans"))


def read_turns(formatted: Column) -> Column:
    """Turns of a formatted conversation as an array of (role, text)."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, F.lit(10**9))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        from_text = F.length(role) + 2
        text = F.substring(p, from_text, F.length(p) - from_text + 1 - len(CLOSE) - 1)
        return F.struct(_unrole(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, nothing between.

    The conversation is cut at its turns first, so that each span is counted from its turn and a long one is read once.
    """

    def masked(part: Column, span: Column) -> Column:
        text = F.substring(part, (span["start"] - span["turn"] - len(OPEN) + 1).cast("int"), (span["end"] - span["start"]).cast("int"))
        return F.when(span["learn"], unescape(text)).otherwise("")

    return F.array_join(F.zip_with(F.slice(F.split(formatted, r"<\|im_start\|>"), 2, F.lit(10**9)), spans, masked), "")


def chain(rows: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations of one turn after the other as messages that reply to the turn before.

    Turns go by ``turn`` (NULL first), equal ones by role and text; repeated rows are turns of their own.
    """
    line = W.partitionBy("tree").orderBy("__turn", "role", "text")
    named = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in ((tree, "tree"), (turn, "__turn"), (role, "role"), (text, "text"))])
    numbered = named.withColumn("__i", F.row_number().over(line))
    name = lambda i: F.concat_ws(":", F.coalesce(F.col("tree").cast("string"), F.lit("null")), i)
    return numbered.select("tree", name(F.col("__i")).alias("message"), F.when(F.col("__i") > 1, name(F.col("__i") - 1)).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def conversations_read_back(rows: DataFrame, tree: str = "conv_id") -> DataFrame:
    """Format conversations and read them back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Rows with a NULL conversation are one conversation; an empty table gives no rows; other columns are not looked at.
    """
    messages = stable(chain(rows, tree))
    made = format_paths(reply_paths(messages, branches=1), messages)
    read = made.select(F.col("tree").alias(tree), read_turns(F.col("formatted")).alias("turns"), learned_text(F.col("formatted"), F.col("spans")).alias("learned"), F.length("formatted").cast("bigint").alias("formatted_chars"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(tree, F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars")

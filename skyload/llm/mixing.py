"""Mixing sources to target weights, with DataFrame functions alone.

Sources hang below languages, languages below domains. A budget of tokens goes down this tree by weight.
Where a node has less than its share, what is left over goes to its siblings, by weight again, and only what a
whole family cannot hold goes on to the siblings of its parent. Each source then gives the
first tokens of its epochs: each epoch holds all its documents in another order that a seed fixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyload.llm.texts import free_name
from skyload.session import release, stable

LEVELS = ("domain", "lang", "source")
# Documents of a source whose order is compared at once, about: its order is cut into ranges of that many.
RANGE_ROWS = 4096


def fill(nodes: DataFrame, parent: list[str], order: str) -> DataFrame:
    """Share out ``budget`` of each family among its nodes: adds ``share``.

    ``nodes`` has the columns ``parent``, ``order`` (a name that breaks ties), ``weight``, ``capacity`` and
    ``budget`` (that of the family, at most its capacity). Nodes are filled in the order of capacity per weight:
    one is full if the weight left would give it that much; the others share what is then left. Shares are whole tokens, rounded down.
    A node of weight 0 gets nothing.
    """
    family = W.partitionBy(*parent)
    line = family.orderBy(F.col("capacity") / F.col("weight"), F.col(order).asc_nulls_first())
    before = line.rowsBetween(W.unboundedPreceding, -1)
    ranked = nodes.where("weight > 0").select(
        "*",
        (F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))).alias("__left"),
        (F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("__weight"),
    )
    full = F.col("capacity") * F.col("__weight") <= F.col("__left") * F.col("weight")
    marked = ranked.withColumn("__full", full)
    rest = marked.select(
        "*",
        F.max("budget").over(family).alias("__all"),
        F.coalesce(F.sum(F.when(F.col("__full"), F.col("capacity"))).over(family), F.lit(0)).alias("__held"),
        F.sum(F.when(~F.col("__full"), F.col("weight"))).over(family).alias("__open"),
    )
    share = F.when(F.col("__full"), F.col("capacity")).otherwise(
        F.floor(F.col("weight") * (F.col("__all") - F.col("__held")).cast("double") / F.col("__open"))
    )
    return rest.withColumn("share", share.cast("bigint")).drop("__left", "__weight", "__full", "__all", "__held", "__open")


def budgets(leaves: DataFrame, share_of_all: float, epochs: int) -> DataFrame:
    """Tokens that each leaf gives: (domain, lang, source, tokens, documents, share).

    ``leaves`` has the three names, ``tokens``, ``documents`` and a ``weight`` for each level: ``domain_weight``,
    ``lang_weight`` and ``source_weight``. The whole budget is ``share_of_all`` of all tokens; a leaf can give ``epochs`` times its own.
    """
    rows = leaves.withColumn("capacity", F.when((F.col("domain_weight") > 0) & (F.col("lang_weight") > 0) & (F.col("source_weight") > 0), F.col("tokens") * epochs).otherwise(0))
    total = rows.agg(F.floor(F.sum("tokens") * F.lit(float(share_of_all))).cast("bigint").alias("wanted"), F.sum("capacity").alias("most"))
    given = total.select(F.least("wanted", "most").alias("budget")).first()[0] or 0
    level = rows.withColumn("__budget", F.lit(given).cast("bigint"))
    for depth, name in enumerate(LEVELS):
        path = list(LEVELS[:depth])
        # Several leaves make one node here; a family's budget stands in each of its rows.
        nodes = level.groupBy(*path, name).agg(F.max(f"{name}_weight").alias("weight"), F.sum("capacity").alias("capacity"), F.max("__budget").alias("budget"))
        shares = fill(nodes, path or [F.lit(0)], name).select(*[F.col(c).alias(f"__{c}") for c in (*path, name)], "share")
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*path, name)]
        joined = level.drop("__budget").join(shares, same, "left").drop(*[f"__{c}" for c in (*path, name)])
        level = joined.withColumn("__budget", F.coalesce("share", F.lit(0).cast("bigint"))).drop("share")
    return level.select(*LEVELS, "tokens", "documents", F.col("__budget").alias("share"))


def token_count(text: Column) -> Column:
    """Runs of anything but blanks, tabs and line ends."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("bigint")


def place_in_epoch(row: Column, epoch: Column, seed: int) -> Column:
    """Place of a document in the order of an epoch: hexadecimal digits that seed, epoch and row fix."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), row))


def mix(
    documents: DataFrame,
    domain: Column,
    weights: DataFrame,
    share_of_all: float = 0.5,
    epochs: int = 2,
    seed: int = 17,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """Documents of the mixture with all their columns, and ``n_epochs``: how often each is in it.

    ``domain`` names a document's domain; ``weights`` has (level, name, weight) with whole-number weights, a node that
    it does not name has weight 1. A source with a share of several times its tokens gives whole epochs, then the documents of the next
    one, in its order, whose tokens, summed up to and with them, fit into the rest. Documents equal in id and
    text stand at one place and go in together. NULL names are a node of their own; NULL and empty texts have no tokens
    and are in the mixture as long as their place is before the cut; an empty table gives an empty mixture.
    If ``n_epochs`` is taken, the new column's name gets an underscore.
    """
    row = F.md5(F.concat_ws(":", F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("null")), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))))
    names = {"domain": domain.cast("string"), "lang": F.col(f"`{lang}`").cast("string"), "source": F.col(f"`{source}`").cast("string")}
    read = stable(documents.select(*[names[n].alias(n) for n in LEVELS], row.alias("row"), token_count(F.col(f"`{text}`").cast("string")).alias("n")))
    leaves = read.groupBy(*LEVELS).agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    for name in LEVELS:
        known = weights.where(F.col("level") == name).groupBy(F.col("name").alias("__name")).agg(F.max("weight").cast("bigint").alias("__weight"))
        leaves = leaves.join(known, F.col(name).eqNullSafe(F.col("__name")), "left").withColumn(f"{name}_weight", F.coalesce("__weight", F.lit(1).cast("bigint"))).drop("__name", "__weight")
    shared = budgets(stable(leaves), share_of_all, epochs)
    full = F.when(F.col("tokens") > 0, F.floor(F.col("share") / F.col("tokens"))).otherwise(0).cast("bigint")
    # So many leading digits of a place that a range of places has about RANGE_ROWS documents.
    digits = F.greatest(F.lit(0), F.ceil(F.log(16.0, F.greatest(F.col("documents") / F.lit(RANGE_ROWS), F.lit(1.0))))).cast("int")
    plan = stable(shared.withColumn("full", full).withColumn("rest", F.col("share") - F.col("full") * F.col("tokens")).withColumn("digits", digits))

    def at_leaf(df: DataFrame, table: DataFrame) -> DataFrame:
        table = table.select(*[F.col(c).alias(f"__{c}") for c in LEVELS], *[c for c in table.columns if c not in LEVELS])
        return df.join(table, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in LEVELS]).drop(*[f"__{c}" for c in LEVELS])

    placed = at_leaf(read, plan.select(*LEVELS, "full", "rest", "digits")).withColumn("place", place_in_epoch(F.col("row"), F.col("full"), seed))
    placed = placed.withColumn("range", F.substring("place", F.lit(1), F.col("digits")))
    ranges = placed.groupBy(*LEVELS, "range", "rest").agg(F.sum("n").alias("n"))
    line = W.partitionBy(*LEVELS).orderBy("range")
    summed = stable(ranges.withColumn("upto", F.sum("n").over(line)))
    # The first range that does not fit whole; the ones before it do.
    cut = summed.where("upto > rest").groupBy(*LEVELS).agg(F.min(F.struct("range", (F.col("upto") - F.col("n")).alias("before"))).alias("c")).select(*LEVELS, F.col("c.range").alias("cut_range"), F.col("c.before").alias("before"))
    inside = at_leaf(placed, cut).where(F.col("range") == F.col("cut_range")).groupBy(*LEVELS, "before", "rest", "place").agg(F.sum("n").alias("n"))
    fits = inside.withColumn("upto", F.col("before") + F.sum("n").over(W.partitionBy(*LEVELS).orderBy("place"))).where("upto <= rest")
    last = fits.groupBy(*LEVELS).agg(F.max("place").alias("last"))
    ends = plan.select(*LEVELS, "full", "share")
    for table in (cut.select(*LEVELS, "cut_range"), last):
        named = table.select(*[F.col(c).alias(f"__{c}") for c in LEVELS], *[c for c in table.columns if c not in LEVELS])
        ends = ends.join(named, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in LEVELS], "left").drop(*[f"__{c}" for c in LEVELS])
    ends = stable(ends)
    release(summed)
    # Below the cut range all are in, within it those up to the last that fits; without a cut all are.
    new = {c: free_name(documents, f"__{c}") for c in (*LEVELS, "row", "full", "share", "cut_range", "last", "place")}
    named = documents.select("*", *[names[c].alias(new[c]) for c in LEVELS], row.alias(new["row"]))
    ends = ends.select(*[F.col(c).alias(f"{new[c]}_") for c in LEVELS], *[F.col(c).alias(new[c]) for c in ("full", "share", "cut_range", "last")])
    met = named.join(ends, [F.col(new[c]).eqNullSafe(F.col(f"{new[c]}_")) for c in LEVELS])
    met = met.withColumn(new["place"], place_in_epoch(F.col(new["row"]), F.col(new["full"]), seed))
    place, cut_range = F.col(new["place"]), F.col(new["cut_range"])
    partly = F.when(cut_range.isNull(), True).otherwise((place < cut_range) | F.coalesce(place <= F.col(new["last"]), F.lit(False)))
    taken = F.when(F.col(new["share"]) > 0, F.col(new["full"]) + partly.cast("bigint")).otherwise(0).cast("bigint")
    out = free_name(documents, "n_epochs")
    return met.select(*[F.col(f"`{c}`") for c in documents.columns], taken.alias(out)).where(F.col(out) > 0)

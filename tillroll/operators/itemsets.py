"""Frequent itemsets by level-wise prefix projection.

Spark ML's FP-Growth gives the whole conditional database of one item to one
task. Here no item, and no itemset, is a task of its own: items are ranked by
frequency, a basket is the ascending list of its ranks, and the conditional
database of an itemset is a set of rows ``(set, prefix, weight)``. Rows with
equal prefixes are merged before they move, as a prefix tree would merge them.
A level counts ``(set, item)`` by partial aggregation, keeps the frequent
ones, drops from every prefix the items that are not frequent beside its set,
and makes the next level's rows. The rows of a common item are dealt by
``(set, prefix)``, so its second items, third items and so on are worked on
by all tasks.

Only the emptiness of a level reaches the driver; there are as many levels as
the longest itemset has items.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.plans.lineage import Scratch
from tillroll.plans.lookup import lookup_table


def least_count(min_support: float, n_baskets: int) -> int:
    """Baskets an itemset needs to reach ``min_support``, one at least."""
    return max(1, math.ceil(min_support * n_baskets))


def item_counts(baskets: DataFrame) -> DataFrame:
    """``item``, ``freq``: baskets (with sets of items) that hold the item."""
    return baskets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("freq"))


def ranked_items(baskets: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """``rank`` (0 = most frequent), ``item``, ``freq`` of the frequent items,
    written. Their number is at most the mean basket size over the support, so
    one task may put them in order."""
    frequent = scratch.table(item_counts(baskets).filter(F.col("freq") >= least), "frequent-items")
    rank = F.row_number().over(Window.orderBy(F.desc("freq"), "item")) - 1
    return scratch.table(frequent.select(rank.alias("rank"), "item", "freq"), "ranked-items")


def ranked_baskets(baskets: DataFrame, ranked: DataFrame) -> DataFrame:
    """The first level's rows: ``set`` 0, ``prefix`` (ranks, ascending),
    ``weight`` (equal baskets). ``baskets`` has ``InvoiceNo`` and ``items``."""
    each = baskets.select("InvoiceNo", F.explode("items").alias("item"))
    known = lookup_table(ranked.select("item", "rank")).join(each, "item", "inner")
    prefixes = known.groupBy("InvoiceNo").agg(F.sort_array(F.collect_list("rank")).alias("prefix"))
    return prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("weight")).select(F.lit(0).cast("long").alias("set"), "prefix", "weight")


def extensions(rows: DataFrame, least: int) -> DataFrame:
    """``set``, ``rank``, ``freq``: items frequent beside each set."""
    each = rows.select("set", "weight", F.explode("prefix").alias("rank"))
    return each.groupBy("set", "rank").agg(F.sum("weight").alias("freq")).filter(F.col("freq") >= least)


def projected(rows: DataFrame, level: DataFrame) -> DataFrame:
    """The rows of the sets of ``level`` (``set``, ``rank``, ``next``): what
    stands before the item in prefixes that hold only frequent items."""
    allowed = level.groupBy("set").agg(F.collect_list("rank").alias("allowed"))
    pruned = rows.join(allowed, "set").select("set", "weight", F.array_intersect("prefix", "allowed").alias("prefix"))
    each = pruned.filter(F.size("prefix") > 1).select("set", "weight", "prefix", F.posexplode("prefix").alias("at", "rank")).filter("at > 0")
    cut = each.select("set", "rank", "weight", F.slice("prefix", F.lit(1), F.col("at")).alias("prefix"))
    return (cut.join(level.select("set", "rank", "next"), ["set", "rank"])
            .groupBy(F.col("next").alias("set"), "prefix").agg(F.sum("weight").alias("weight")))


def projected_itemsets(baskets: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """``items`` (sorted), ``freq`` of every itemset in at least ``least`` of
    ``baskets`` (``InvoiceNo``, ``items``: sets)."""
    ranked = ranked_items(baskets, least, scratch)
    names = lookup_table(ranked.select("rank", "item"))
    rows = scratch.table(ranked_baskets(baskets, ranked), "projection")
    before = None
    found = []
    while True:
        level = scratch.table(extensions(rows, least).withColumn("next", F.monotonically_increasing_id()), "extensions")
        if level.isEmpty():
            break
        named = names.join(level, "rank", "inner").select("set", "next", "freq", F.array("item").alias("items"))
        if before is not None:
            parents = before.select(F.col("next").alias("set"), F.col("items").alias("parent"))
            named = named.join(parents, "set").select("set", "next", "freq", F.concat("parent", "items").alias("items"))
        before = scratch.table(named, "itemsets")
        found.append(before)
        further = scratch.table(projected(rows, level), "projection")
        scratch.drop(rows, level)
        rows = further
    if not found:
        return baskets.select(F.col("items"), F.lit(0).cast("long").alias("freq")).limit(0)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.select(F.array_sort("items").alias("items"), "freq")


def rules_of(itemsets: DataFrame, n_baskets: int, min_confidence: float) -> DataFrame:
    """Rules with a one-item consequent from all frequent itemsets
    (``items`` sorted, ``freq``): ``antecedent``, ``consequent``,
    ``confidence``, ``lift``, ``support``."""
    each = itemsets.filter(F.size("items") > 1).select("items", "freq", F.explode("items").alias("item"))
    rules = each.select(F.array_remove("items", F.col("item")).alias("antecedent"), "item", "freq")
    left = itemsets.select(F.col("items").alias("antecedent"), F.col("freq").alias("left_freq"))
    right = itemsets.filter(F.size("items") == 1).select(F.element_at("items", 1).alias("item"), F.col("freq").alias("right_freq"))
    confidence = F.col("freq") / F.col("left_freq")
    return (rules.join(left, "antecedent").filter(confidence >= min_confidence).join(right, "item")
            .select("antecedent", F.array("item").alias("consequent"), confidence.alias("confidence"),
                    (confidence / (F.col("right_freq") / F.lit(n_baskets))).alias("lift"), (F.col("freq") / F.lit(n_baskets)).alias("support")))

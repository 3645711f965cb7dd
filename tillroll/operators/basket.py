"""Market-basket analysis (B1-B18): Spark ML's parallel FP-Growth, and level-wise
projection where one item's database may outgrow a task.

Item arrays are always sorted (``array_sort``) before they are compared or
written. Names are attached by exploding item arrays with their position,
joining the product table (size-checked broadcast, see
:mod:`tillroll.plans.lookup`) and re-assembling in position order; no
driver-side dictionary. A program makes the product table once
(:func:`tillroll.plans.lookup.lookup_table`) and passes it to every report.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import NO_DESCRIPTION, list_repr, truncate_text
from tillroll.operators.itemsets import item_counts, least_count, projected_itemsets, rules_of
from tillroll.plans.lineage import Scratch
from tillroll.plans.lookup import Lookup, join_lookup

# Support/confidence ladder of the mining run: first rung that finds any
# frequent itemset wins (fixed values of the reference run).
DEFAULT_LADDER = ((0.007, 0.6), (0.003, 0.6))
# Items of all baskets together, frequent ones only, up to which the database
# of one item surely fits a task.
SPLIT_CELLS = 20_000_000


def basket_lines(df: DataFrame) -> DataFrame:
    """B1: lines with Quantity > 0."""
    return df.filter(F.col("Quantity") > 0)


def product_dim(df: DataFrame) -> DataFrame:
    """B2: one name per code from the positive lines (StockCode, Description)."""
    return (basket_lines(df).filter(F.col("StockCode").isNotNull())
            .groupBy("StockCode").agg(F.min("Description").alias("Description")))


def basket_items(df: DataFrame, item_col: str = "StockCode") -> DataFrame:
    """Different (InvoiceNo, ``item``) pairs of the positive lines. They are
    dealt by both, so a huge invoice is spread over tasks."""
    lines = basket_lines(df).filter(F.col(item_col).isNotNull())
    return lines.select("InvoiceNo", F.col(item_col).alias("item")).distinct()


def basket_sizes(items: DataFrame) -> DataFrame:
    """Items per invoice (InvoiceNo, basket_size) from :func:`basket_items`,
    by partial counts: no set of items is made."""
    return items.groupBy("InvoiceNo").agg(F.count(F.lit(1)).cast("int").alias("basket_size"))


def baskets(df: DataFrame, item_col: str = "StockCode", max_items: int | None = None) -> DataFrame:
    """B3 + B4: one row per invoice with its sorted distinct items and size.

    ``collect_set`` aggregates partially on the map side, so a huge invoice
    reaches the reducer as per-task sets of distinct items. With
    ``max_items`` the larger invoices (a placeholder number, say) are known
    from their counts and leave before any set is collected."""
    if max_items is not None:
        items = basket_items(df, item_col)
        return baskets_within(items, basket_sizes(items), max_items)
    lines = basket_lines(df).filter(F.col(item_col).isNotNull())
    return (lines.groupBy("InvoiceNo").agg(F.array_sort(F.collect_set(item_col)).alias("items"))
                 .withColumn("basket_size", F.size("items")))


def baskets_within(items: DataFrame, sizes: DataFrame, max_items: int) -> DataFrame:
    """B3 + B6: the baskets of at most ``max_items`` items, from
    :func:`basket_items` and :func:`basket_sizes`. Spark broadcasts the
    oversized numbers while they are few, so their lines are not shuffled."""
    big = sizes.filter(F.col("basket_size") > max_items).select(F.col("InvoiceNo").alias("_big"))
    small = items.join(big, F.col("InvoiceNo").eqNullSafe(F.col("_big")), "left_anti")
    return (small.groupBy("InvoiceNo").agg(F.array_sort(F.collect_list("item")).alias("items"))
                 .withColumn("basket_size", F.size("items")))


def basket_count(b: DataFrame) -> DataFrame:
    """Number of baskets (one row)."""
    return b.agg(F.count(F.lit(1)).alias("n_baskets"))


def basket_size_distribution(b: DataFrame) -> DataFrame:
    """Baskets per size."""
    return b.groupBy("basket_size").agg(F.count(F.lit(1)).alias("n_baskets")).orderBy("basket_size")


def limit_baskets(b: DataFrame, max_items: int | None = None) -> DataFrame:
    """B6 + B7: baskets of at most ``max_items`` items (None: of any size),
    null item sets out."""
    some = b.filter(F.col("items").isNotNull())
    return some if max_items is None else some.filter(F.col("basket_size") <= max_items)


def basket_limit_summary(b: DataFrame, max_items: int | None = None) -> DataFrame:
    """B6 + B7 counts in one pass: total, kept, dropped for size, null. ``b``
    is a basket table or, without its sets, :func:`basket_sizes`."""
    big = F.lit(False) if max_items is None else F.col("basket_size") > max_items
    null = F.col("items" if "items" in b.columns else "basket_size").isNull()
    return b.agg(F.count(F.lit(1)).alias("n_baskets"),
                 F.count_if(~big & ~null).alias("n_kept"),
                 F.count_if(big).alias("n_dropped"),
                 F.count_if(null).alias("n_null"))


def fit_fpgrowth(b: DataFrame, min_support: float, min_confidence: float,
                 num_partitions: int | None = None) -> FPGrowthModel:
    fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    return fp.fit(b.select("items"))


def frequent_itemsets(model: FPGrowthModel) -> DataFrame:
    """Frequent itemsets (items sorted, freq)."""
    return model.freqItemsets.select(F.array_sort("items").alias("items"), F.col("freq").cast("long"))


def association_rules(model: FPGrowthModel) -> DataFrame:
    """Rules with a one-item consequent: confidence, lift, support."""
    return model.associationRules.select(
        F.array_sort("antecedent").alias("antecedent"), F.array_sort("consequent").alias("consequent"),
        "confidence", "lift", "support")


@dataclass
class MiningRun:
    baskets: DataFrame          # baskets fed to the miner (B3, B6, B7), persisted
    itemsets: DataFrame         # B8, written
    counts: tuple               # baskets before the limit, used, dropped for size, null
    min_support: float
    min_confidence: float
    max_items: int | None
    scratch: Scratch

    @property
    def used(self) -> DataFrame:
        """The sets of items that were mined."""
        return self.baskets.select("items")

    @property
    def limits(self) -> DataFrame:
        """How many baskets the size limit kept and dropped (one row)."""
        return self.baskets.sparkSession.createDataFrame([self.counts], "n_baskets long, n_kept long, n_dropped long, n_null long")

    @cached_property
    def rules(self) -> DataFrame:
        """B10, worked out and written on first use."""
        return self.scratch.table(rules_of(self.itemsets, self.counts[1], self.min_confidence), "rules")

    def close(self) -> None:
        """Release the cached baskets and the written itemsets and rules."""
        self.baskets.unpersist()
        self.scratch.close()


def mine_with_backoff(lines: DataFrame, ladder=DEFAULT_LADDER, max_items: int | None = None,
                      item_col: str = "StockCode", num_partitions: int | None = None,
                      split_cells: int = SPLIT_CELLS) -> MiningRun:
    """B8 + B9: mine at the first (support, confidence) rung that yields an
    itemset. There is one exactly if some item reaches the rung's support, so
    the rung follows from the item counts and mining runs once, whatever the
    ladder. ``max_items`` leaves out larger baskets before their sets are
    collected; ``MiningRun.limits`` counts them.

    The itemsets come from Spark ML's FP-Growth while the frequent items of
    all baskets together are at most ``split_cells``, and from
    :mod:`tillroll.operators.itemsets` beyond it, where no item's database is
    one task. Both give the same itemsets."""
    if not ladder:
        raise ValueError("the ladder needs at least one (support, confidence) rung")
    spark = lines.sparkSession
    scratch = Scratch(spark)
    items = None
    if max_items is None:
        used = baskets(lines, item_col).persist()
        counts = tuple(basket_limit_summary(used).first())
    else:
        items = basket_items(lines, item_col).persist()
        sizes = scratch.table(basket_sizes(items), "basket-sizes")
        counts = tuple(basket_limit_summary(sizes, max_items).first())
        used = baskets_within(items, sizes, max_items).persist()
    n_used = counts[1]
    per_item = scratch.table(item_counts(used), "item-counts")
    most = per_item.agg(F.max("freq")).first()[0] or 0
    support, confidence = next(((s, c) for s, c in ladder if least_count(s, n_used) <= most), ladder[-1])
    least = least_count(support, n_used)
    cells = per_item.agg(F.sum(F.when(F.col("freq") >= least, F.col("freq")))).first()[0] or 0
    if cells > split_cells:
        itemsets = projected_itemsets(used, least, scratch)
    elif most >= least:
        itemsets = frequent_itemsets(fit_fpgrowth(used, support, confidence, num_partitions))
    else:
        itemsets = used.select("items", F.lit(0).cast("long").alias("freq")).limit(0)
    run = MiningRun(used, scratch.table(itemsets, "itemsets"), counts, support, confidence, max_items, scratch)
    if items is not None:
        items.unpersist()
    return run


def _describe(df: DataFrame, arr: str, dim: DataFrame | Lookup, prefix: str | None = None) -> DataFrame:
    """Add ``<prefix>_names`` (names, fallback text when a code has none)
    and ``<prefix>_with_desc`` (``code: name``) for the array ``arr``, both
    in the array's order. Grouping by all input columns keeps each row."""
    prefix = prefix or arr
    keep = df.columns
    exploded = df.select(*keep, F.posexplode(arr).alias("_pos", "StockCode"))
    named = join_lookup(exploded, dim, "StockCode").withColumn(
        "_name", F.coalesce(F.col("Description"), F.lit(NO_DESCRIPTION)))
    parts = F.array_sort(F.collect_list(F.struct("_pos", F.col("StockCode").alias("_code"), "_name")))
    grouped = named.groupBy(*keep).agg(parts.alias("_parts"))
    return grouped.select(
        *keep,
        F.transform("_parts", lambda s: s["_name"]).alias(f"{prefix}_names"),
        F.transform("_parts", lambda s: F.concat(s["_code"], F.lit(": "), s["_name"])).alias(f"{prefix}_with_desc"))


def describe_itemsets(itemsets: DataFrame, dim: DataFrame | Lookup) -> DataFrame:
    """Itemsets with ``items_with_desc``."""
    return _describe(itemsets, "items", dim).drop("items_names")


def describe_rules(rules: DataFrame, dim: DataFrame | Lookup) -> DataFrame:
    """Rules with names for both sides.

    Both sides are exploded in one pass (items tagged 0 = antecedent,
    1 = consequent), so one lookup join and one grouping name a rule."""
    keep = rules.columns
    tag = lambda arr, k: F.transform(arr, lambda x: F.struct(F.lit(k).alias("side"), x.alias("code")))
    exploded = rules.select(*keep, F.posexplode(F.concat(tag("antecedent", 0), tag("consequent", 1)))
                            .alias("_pos", "_t"))
    exploded = exploded.select(*keep, "_pos", F.col("_t.side").alias("_side"), F.col("_t.code").alias("StockCode"))
    named = join_lookup(exploded, dim, "StockCode").withColumn(
        "_name", F.coalesce(F.col("Description"), F.lit(NO_DESCRIPTION)))
    parts = F.array_sort(F.collect_list(F.struct("_pos", "_side", F.col("StockCode").alias("_code"), "_name")))
    grouped = named.groupBy(*keep).agg(parts.alias("_parts"))
    side = lambda k: F.filter("_parts", lambda s: s["_side"] == k)
    with_desc = lambda s: F.concat(s["_code"], F.lit(": "), s["_name"])
    return grouped.select(
        *keep,
        F.transform(side(0), lambda s: s["_name"]).alias("antecedent_names"),
        F.transform(side(0), with_desc).alias("antecedent_with_desc"),
        F.transform(side(1), lambda s: s["_name"]).alias("consequent_names"),
        F.transform(side(1), with_desc).alias("consequent_with_desc"))


def _rule_order(by: str):
    other = "lift" if by == "confidence" else "confidence"
    return [F.desc(F.round(by, 9)), F.desc(F.round(other, 9)),
            F.array_join("antecedent", ","), F.array_join("consequent", ",")]


def _rule_label(df: DataFrame) -> DataFrame:
    return df.withColumn("rule", F.concat(list_repr("antecedent_with_desc"), F.lit(" → "),
                                          list_repr("consequent_with_desc")))


def top_rules(rules: DataFrame, by: str = "confidence", n: int = 20, dim: DataFrame | Lookup | None = None) -> DataFrame:
    """B13 (by confidence) / B14 (by lift) + B15 label
    ``[antecedent names] → [consequent names]``.

    With ``dim`` the top ``n`` are chosen on the bare rules and only those
    rows are named (the order needs no names); rules already named (e.g.
    read back from CSV) are labelled as they are."""
    order = _rule_order(by)
    top = rules.orderBy(*order).limit(n)
    if dim is not None:
        return _rule_label(describe_rules(top, dim)).orderBy(*order)
    if "antecedent_with_desc" in rules.columns:
        return _rule_label(top)
    return top


def number_rules(rules: DataFrame) -> DataFrame:
    """``rule_id`` = position of the rule in (antecedent, consequent)
    order over all rules, computed once with a distributed rank."""
    from tillroll.plans.ranking import global_row_number

    keyed = rules.withColumn("_a", F.array_join("antecedent", ", ")).withColumn("_c", F.array_join("consequent", ", "))
    return global_row_number(keyed, ["_a", "_c"], "rule_id").drop("_a", "_c")


def friendly_rules(rules: DataFrame, dim: DataFrame | Lookup, n: int = 20) -> DataFrame:
    """Readable top-``n`` report by confidence: rule number, codes
    joined by ``, ``, names joined by ``; ``, confidence, lift. A rule's
    number is its position among all rules (:func:`number_rules`); for the
    few shown it is the count of rules at or before it, so the rules are
    neither sorted nor checkpointed for it."""
    order = _rule_order("confidence")
    top = rules.orderBy(*order).limit(n)
    keys = [F.array_join("antecedent", ", "), F.array_join("consequent", ", ")]
    shown = [(r["a"], r["c"]) for r in top.select(keys[0].alias("a"), keys[1].alias("c")).collect()]
    at = F.lit(None).cast("long")
    if shown:
        before = [F.count_if((keys[0] < a) | ((keys[0] == a) & (keys[1] <= c))).alias(f"n{k}") for k, (a, c) in enumerate(shown)]
        numbers = rules.agg(*before).first()
        for k, (a, c) in enumerate(shown):
            at = F.when((keys[0] == a) & (keys[1] == c), F.lit(numbers[k]).cast("long")).otherwise(at)
    top = top.withColumn("rule_id", at)
    return describe_rules(top, dim).orderBy(*order).select(
        "rule_id",
        F.array_join("antecedent", ", ").alias("antecedent_codes"),
        F.array_join("antecedent_names", "; ").alias("antecedent_descriptions"),
        F.array_join("consequent", ", ").alias("consequent_codes"),
        F.array_join("consequent_names", "; ").alias("consequent_descriptions"),
        "confidence", "lift")


def top_itemsets(itemsets: DataFrame, dim: DataFrame | Lookup | None = None, n: int = 20, width: int = 75) -> DataFrame:
    """Top ``n`` itemsets by freq with display text cut to ``width``
    (named after the cut when ``dim`` is given)."""
    order = [F.desc("freq"), F.array_join("items", ",")]
    top = itemsets.orderBy(*order).limit(n)
    if dim is not None:
        top = describe_itemsets(top, dim).orderBy(*order)
    return top.withColumn("items_display", truncate_text(list_repr("items_with_desc"), width))


def mining_summary(run: MiningRun) -> DataFrame:
    """Baskets before/after the size limit, itemsets, rules, thresholds
    (one row of scalar subqueries)."""
    n_sets = run.itemsets.agg(F.count(F.lit(1))).scalar()
    n_rules = run.rules.agg(F.count(F.lit(1))).scalar()
    return run.limits.select(
        "n_baskets", F.col("n_kept").alias("n_used"), n_sets.alias("n_itemsets"), n_rules.alias("n_rules"),
        F.lit(run.min_support).alias("min_support"), F.lit(run.min_confidence).alias("min_confidence"))

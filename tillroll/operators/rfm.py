"""RFM customer segmentation.

Scores are terciles as pandas ``qcut(x, 3)`` draws them (SURVEY R3/R4):
the cut positions come from :mod:`tillroll.functions.quantiles` given the
customer count ``n`` (one scalar on the driver).

* R (values): the cut values are interpolated between the Recency values
  at two positions; at or under the first cut scores 3, then 2, then 1.
  Recency is a whole number of days, so its histogram has one row per
  distinct day and the running count over it is small.
* F, M (ranks, ties by CustomerID): rank at or under the first cut scores
  1, then 2, else 3. Only the customers at the two cut ranks are looked up
  (:func:`kth_keys_of`, bracket and count); everyone else is compared with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import SEGMENTS, money_sum
from tillroll.functions.quantiles import cut_positions, rank_cuts
from tillroll.plans.lineage import checkpointed
from tillroll.plans.ranking import kth_keys_of


def rfm_reference_date(df: DataFrame) -> DataFrame:
    """Latest InvoiceDate over rows that have a customer (one row)."""
    return df.filter(F.col("CustomerID").isNotNull()).agg(F.max("InvoiceDate").alias("max_date"))


def rfm_base(df: DataFrame) -> DataFrame:
    """R2: per customer Recency (days from their last invoice to the latest
    one overall), Frequency (distinct invoices), Monetary (revenue).

    The overall latest date is the max over the per-customer maxima (a
    scalar subquery over the same aggregate, whose shuffle is reused)."""
    per = (df.filter(F.col("CustomerID").isNotNull())
             .groupBy("CustomerID")
             .agg(F.max("InvoiceDate").alias("_last"),
                  F.countDistinct("InvoiceNo").alias("Frequency"),
                  money_sum("TotalValue").alias("Monetary")))
    ref = per.agg(F.max("_last")).scalar()
    return per.select("CustomerID", F.datediff(ref, F.col("_last")).alias("Recency"), "Frequency", "Monetary")


def _lerp(a, b, t: float):
    a, b = a.cast("double"), b.cast("double")
    return b - (b - a) * F.lit(1 - t) if t >= 0.5 else a + (b - a) * F.lit(t)


def recency_cuts(base: DataFrame, n: int) -> DataFrame:
    """One row, one struct column ``cuts``: the two tercile cut values of
    Recency (``r_cut1``, ``r_cut2``)."""
    hist = base.groupBy("Recency").agg(F.count(F.lit(1)).alias("_c"))
    run = hist.select("Recency", F.sum("_c").over(Window.orderBy("Recency")).alias("_cum"))
    at = lambda pos: F.min(F.when(F.col("_cum") >= pos + 1, F.col("Recency")))
    (l1, h1, t1), (l2, h2, t2) = cut_positions(max(n, 1))
    vals = run.agg(at(l1).alias("_a1"), at(h1).alias("_b1"), at(l2).alias("_a2"), at(h2).alias("_b2"))
    return vals.select(F.struct(_lerp(F.col("_a1"), F.col("_b1"), t1).alias("r_cut1"),
                                _lerp(F.col("_a2"), F.col("_b2"), t2).alias("r_cut2")).alias("cuts"))


def rfm_r_score(base: DataFrame, n: int | None = None) -> DataFrame:
    """R_Score on an rfm_base table (``n`` = its row count if known)."""
    n = base.count() if n is None else n
    cuts = recency_cuts(base, n).scalar()
    score = (F.when(F.col("Recency") <= cuts.getField("r_cut1"), 3)
              .when(F.col("Recency") <= cuts.getField("r_cut2"), 2).otherwise(1))
    return base.withColumn("R_Score", score)


def rank_score(df: DataFrame, metric: str, out: str, n: int | None = None) -> DataFrame:
    """Tercile score of the rank of ``metric`` (ties by CustomerID)."""
    return rank_scores(df, {metric: out}, n)


def rank_scores(df: DataFrame, metrics: dict[str, str], n: int | None = None) -> DataFrame:
    """R4 for several metrics ({metric: score column}) in the same passes."""
    n = df.count() if n is None else n
    cuts = [int(c) for c in rank_cuts(max(n, 1))]
    inside = [(m, c) for m in metrics for c in cuts if 1 <= c <= n]
    keys = dict(zip(inside, kth_keys_of(df, "CustomerID", inside, n)))

    def at_or_under(metric: str, cut: int):
        if (metric, cut) not in keys:
            return F.lit(cut > n)
        value, ident = keys[metric, cut]
        return (F.col(metric) < F.lit(value)) | ((F.col(metric) == F.lit(value)) & (F.col("CustomerID") <= F.lit(ident)))

    return df.withColumns({out: F.when(at_or_under(m, cuts[0]), 1).when(at_or_under(m, cuts[1]), 2).otherwise(3) for m, out in metrics.items()})


def rfm_scores(df: DataFrame) -> DataFrame:
    """R2-R5 on sales lines: base columns, R/F/M scores and RFM_Score.

    The customer table is checkpointed once; its row count is the only
    value the driver sees besides the cut keys."""
    base = checkpointed(rfm_base(df))
    n = base.count()
    scored = rfm_r_score(rank_scores(base, {"Frequency": "F_Score", "Monetary": "M_Score"}, n), n)
    return scored.select("CustomerID", "Recency", "Frequency", "Monetary", "R_Score", "F_Score", "M_Score",
                         (F.col("R_Score") + F.col("F_Score") + F.col("M_Score")).alias("RFM_Score"))


def segment_of(score) -> F.Column:
    """Right-closed bins (0,3], (3,6], (6,9]."""
    s = F.col(score) if isinstance(score, str) else score
    return (F.when((s > 0) & (s <= 3), F.lit(SEGMENTS[0]))
             .when((s > 3) & (s <= 6), F.lit(SEGMENTS[1]))
             .when((s > 6) & (s <= 9), F.lit(SEGMENTS[2])))


def rfm_segments(df: DataFrame) -> DataFrame:
    """Scores plus Segment."""
    return rfm_scores(df).withColumn("Segment", segment_of("RFM_Score"))


def segment_counts(segments: DataFrame) -> DataFrame:
    """Customers per segment, every segment shown, largest first."""
    spine = segments.sparkSession.createDataFrame([(s,) for s in SEGMENTS], "Segment string")
    counts = segments.groupBy("Segment").agg(F.count(F.lit(1)).alias("Count"))
    # At most one row per segment.
    return (spine.join(F.broadcast(counts), "Segment", "left")
             .select("Segment", F.coalesce(F.col("Count"), F.lit(0)).alias("Count"))
             .orderBy(F.desc("Count"), F.asc("Segment")))


def rfm_sample(segments: DataFrame, n: int = 1000, seed: int = 42) -> DataFrame:
    """Repeatable sample of exactly ``n`` customers (all if fewer): the
    ``n`` smallest ``md5("<seed>:<CustomerID>")`` values. A top-k (each task
    keeps its best ``n``), so no shuffle of the whole table to one task; md5
    makes the order reproducible in any engine."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col("CustomerID").cast("string")))
    return segments.orderBy(key, F.col("CustomerID")).limit(n)

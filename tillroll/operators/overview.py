"""Overview aggregations (K1-K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import money_sum, year_month_label


def kpis(df: DataFrame) -> DataFrame:
    """K1: revenue, distinct invoices, distinct customers, average order
    value (0 when there is no order). One row."""
    agg = df.agg(money_sum("TotalValue").alias("total_revenue"),
                 F.countDistinct("InvoiceNo").alias("total_invoices"),
                 F.countDistinct("CustomerID").alias("total_customers"))
    aov = F.when(F.col("total_invoices") > 0, F.col("total_revenue") / F.col("total_invoices")).otherwise(F.lit(0.0))
    return agg.withColumn("avg_order_value", aov)


def monthly_revenue(df: DataFrame) -> DataFrame:
    """K2: revenue per Year, Month with a ``YYYY-MM`` label."""
    return (df.groupBy("Year", "Month").agg(money_sum("TotalValue").alias("Revenue"))
              .withColumn("Date", year_month_label("Year", "Month"))
              .orderBy("Year", "Month"))


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    """K3: top ``n`` named products by quantity; ties by name."""
    return (df.filter(F.col("Description").isNotNull())
              .groupBy("Description").agg(F.sum("Quantity").alias("Quantity"))
              .orderBy(F.desc("Quantity"), F.asc("Description")).limit(n))


def order_values(df: DataFrame) -> DataFrame:
    """K4: value of each order."""
    return df.groupBy("InvoiceNo").agg(money_sum("TotalValue").alias("TotalValue"))


def order_value_percentile(orders: DataFrame, p: float = 0.95, exact: bool = False,
                           accuracy: int = 10000) -> DataFrame:
    """K5 on an order-value table: one row ``upper_limit``.

    Default is ``percentile_approx`` (one pass, bounded memory per task).
    ``exact=True`` gives ``percentile_disc`` semantics (smallest value whose
    cumulative share is >= p): the approximate answer narrows the search to
    a thin window and only that window is ranked (see
    :func:`tillroll.plans.ranking.percentile_disc`); the order table is
    checkpointed first because it is read more than once.
    """
    if not exact:
        return orders.agg(F.percentile_approx("TotalValue", p, accuracy).alias("upper_limit"))
    from tillroll.plans.lineage import checkpointed
    from tillroll.plans.ranking import percentile_disc

    return percentile_disc(checkpointed(orders), "TotalValue", p).select(F.col("TotalValue").alias("upper_limit"))


def order_value_p95(df: DataFrame, p: float = 0.95, exact: bool = False) -> DataFrame:
    """K5: 95th percentile of order value (one row)."""
    return order_value_percentile(order_values(df), p, exact)


def trimmed_order_values(df: DataFrame, p: float = 0.95, exact: bool = False) -> DataFrame:
    """K6: orders whose value is at or under the percentile. The limit is a
    scalar subquery (run once, inlined into the filter)."""
    orders = order_values(df)
    if exact:
        from tillroll.plans.lineage import checkpointed
        from tillroll.plans.ranking import percentile_disc

        orders = checkpointed(orders)
        limit = percentile_disc(orders, "TotalValue", p).select("TotalValue")
    else:
        limit = order_value_percentile(orders, p)
    return orders.filter(F.col("TotalValue") <= limit.scalar()).select("InvoiceNo", "TotalValue")


def histogram(values: DataFrame, col: str = "TotalValue", bins: int = 50) -> DataFrame:
    """K7 core: ``bins`` equal-width bins from min to max; the max falls in
    the last bin; if min = max every row is in bin 1. Empty bins are kept
    (left join from a ``bins``-row spine; the counts table has at most
    ``bins`` rows, so it is broadcast). Min and max are one scalar subquery."""
    v = F.col(col)
    bounds = values.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi")).alias("b")).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    width = hi - lo
    b = F.when(width > 0, F.least(F.floor((v - lo) * bins / width).cast("int") + 1, F.lit(bins))).otherwise(F.lit(1))
    counts = values.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n_orders"))
    spine = values.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    edge = lambda k: lo + (hi - lo) * k / bins
    return (spine.join(F.broadcast(counts), "bin", "left")
                 .select("bin", edge(F.col("bin") - 1).alias("bin_start"), edge(F.col("bin")).alias("bin_end"),
                         F.coalesce(F.col("n_orders"), F.lit(0)).alias("n_orders"))
                 .orderBy("bin"))


def order_value_histogram(df: DataFrame, bins: int = 50, p: float = 0.95, exact: bool = False) -> DataFrame:
    """K7: histogram of the trimmed order values."""
    return histogram(trimmed_order_values(df, p, exact), "TotalValue", bins)

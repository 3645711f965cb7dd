"""Country aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import money_sum


def country_metrics(df: DataFrame) -> DataFrame:
    """G1: per country Revenue, Orders, Customers, Avg_Order_Value.

    Two distinct counts per group: Spark expands the rows per distinct
    column and pre-aggregates on (Country, InvoiceNo) / (Country,
    CustomerID) before the Country shuffle, so one country holding most of
    the rows is never a single-task group of raw lines.
    """
    agg = df.groupBy("Country").agg(
        money_sum("TotalValue").alias("Revenue"),
        F.countDistinct("InvoiceNo").alias("Orders"),
        F.countDistinct("CustomerID").alias("Customers"))
    return agg.withColumn("Avg_Order_Value", F.try_divide(F.col("Revenue"), F.col("Orders")))


def top_countries(df: DataFrame, by: str = "Revenue", n: int = 10) -> DataFrame:
    """G2 (``by="Revenue"``) / G3 (``by="Avg_Order_Value"``): top ``n``
    countries, ties by name."""
    return country_metrics(df).orderBy(F.desc(by), F.asc("Country")).limit(n)

"""Time aggregations, the growth window and the heat-map pivot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import money_sum, month_year_label, weekday_name


def hourly(df: DataFrame) -> DataFrame:
    """Distinct orders and revenue per Hour."""
    return (df.groupBy("Hour").agg(F.countDistinct("InvoiceNo").alias("Orders"),
                                   money_sum("TotalValue").alias("TotalValue"))
              .orderBy("Hour"))


def weekday_revenue(df: DataFrame) -> DataFrame:
    """Revenue per DayOfWeek with the day name."""
    return (df.groupBy("DayOfWeek").agg(money_sum("TotalValue").alias("TotalValue"))
              .withColumn("Weekday", weekday_name("DayOfWeek"))
              .orderBy("DayOfWeek"))


def daily_trend(df: DataFrame) -> DataFrame:
    """Revenue and distinct orders per calendar day."""
    return (df.groupBy(F.to_date("InvoiceDate").alias("Date"))
              .agg(money_sum("TotalValue").alias("Revenue"), F.countDistinct("InvoiceNo").alias("Orders"))
              .orderBy("Date"))


def heatmap_long(df: DataFrame) -> DataFrame:
    """T4: distinct orders per (DayOfWeek, Hour)."""
    return df.groupBy("DayOfWeek", "Hour").agg(F.countDistinct("InvoiceNo").alias("Orders"))


def heatmap_matrix(df: DataFrame) -> DataFrame:
    """T5: 7 rows (Monday first) x 24 hour columns ``h00``..``h23``; a cell
    without orders is null. The pivot values are fixed, so no extra job
    looks for them; the days found, at most 7 rows, are broadcast."""
    hours = list(range(24))
    wide = heatmap_long(df).groupBy("DayOfWeek").pivot("Hour", hours).agg(F.first("Orders"))
    wide = wide.select("DayOfWeek", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])
    spine = df.sparkSession.range(7).select(F.col("id").cast("int").alias("DayOfWeek"))
    return (spine.join(F.broadcast(wide), "DayOfWeek", "left")
             .select("DayOfWeek", weekday_name("DayOfWeek").alias("Weekday"), *[f"h{h:02d}" for h in hours])
             .orderBy("DayOfWeek"))


def month_year_revenue(df: DataFrame) -> DataFrame:
    """Revenue per month with ``January 2011`` labels."""
    return (df.groupBy("Year", "Month").agg(money_sum("TotalValue").alias("TotalValue"))
              .withColumn("MonthYear", month_year_label("Year", "Month"))
              .orderBy("Year", "Month"))


def monthly_country_revenue(df: DataFrame) -> DataFrame:
    """Revenue per Country, Year, Month."""
    return df.groupBy("Country", "Year", "Month").agg(money_sum("TotalValue").alias("TotalValue"))


def monthly_growth(df: DataFrame) -> DataFrame:
    """Month-over-month growth in % against the previous month present
    for the same country; null without one, null when it was 0.

    The window runs on the (country, month) aggregate, a table of at most
    countries x months rows, partitioned by Country."""
    w = Window.partitionBy("Country").orderBy("Year", "Month")
    m = monthly_country_revenue(df).withColumn("PrevRevenue", F.lag("TotalValue").over(w))
    growth = F.try_divide(F.col("TotalValue") - F.col("PrevRevenue"), F.col("PrevRevenue")) * 100
    return m.withColumn("GrowthRate", growth)


def growth_signed(df: DataFrame) -> DataFrame:
    """Growth rows without nulls, labelled and split by sign."""
    g = monthly_growth(df).dropna()
    return (g.withColumn("MonthYear", month_year_label("Year", "Month"))
             .withColumn("Sign", F.when(F.col("GrowthRate") >= 0, F.lit("Positive Growth"))
                                  .otherwise(F.lit("Negative Growth"))))

"""The dashboard as one plan: load, filter, then every panel's table.

The filtered table is persisted once (after the filters, so the country
list and date bounds are pushed into the Parquet scan) and every panel is a
lazy DataFrame over it; call :meth:`Dashboard.close` to release it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import country as G
from tillroll.operators import filters as FL
from tillroll.operators import overview as K
from tillroll.operators import rfm as R
from tillroll.operators import timeline as T
from tillroll.sources.files import load_sales


@dataclass
class Dashboard:
    sales: DataFrame
    panels: dict[str, DataFrame] = field(default_factory=dict)

    def close(self) -> None:
        self.sales.unpersist()


def panels(df: DataFrame, exact_percentile: bool = False) -> dict[str, DataFrame]:
    """Every panel table over an already filtered sales DataFrame."""
    return {
        "kpis": K.kpis(df),
        "monthly_revenue": K.monthly_revenue(df),
        "top_products": K.top_products(df),
        "order_value_histogram": K.order_value_histogram(df, exact=exact_percentile),
        "country_metrics": G.country_metrics(df),
        "top_countries_revenue": G.top_countries(df, "Revenue"),
        "top_countries_aov": G.top_countries(df, "Avg_Order_Value"),
        "hourly": T.hourly(df),
        "weekday_revenue": T.weekday_revenue(df),
        "daily_trend": T.daily_trend(df),
        "heatmap_matrix": T.heatmap_matrix(df),
        "month_year_revenue": T.month_year_revenue(df),
        "growth_signed": T.growth_signed(df),
    }


def build_dashboard(df: DataFrame, countries=None, start=None, end=None,
                    persist: bool = True, exact_percentile: bool = False) -> Dashboard:
    """F1-F3 then the overview, country and time panels (RFM panels come
    from :func:`rfm_panels`, which checkpoint their own customer table)."""
    filtered = FL.filter_sales(df, countries, start, end)
    if persist:
        filtered = filtered.persist(StorageLevel.MEMORY_AND_DISK)
    return Dashboard(filtered, panels(filtered, exact_percentile))


def rfm_panels(df: DataFrame) -> dict[str, DataFrame]:
    seg = R.rfm_segments(df)
    return {"rfm_segments": seg, "segment_counts": R.segment_counts(seg), "rfm_sample": R.rfm_sample(seg)}


def open_dashboard(spark: SparkSession, path: str, countries=None, start=None, end=None) -> Dashboard:
    """Scan the clean table at ``path`` (A1 + C4b) and build the dashboard."""
    return build_dashboard(load_sales(spark, path), countries, start, end)

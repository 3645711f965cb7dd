"""

Each callable takes ``(spark, sf_dir)``, reads the given test tables
through the fixture views and returns a lazy DataFrame. Array columns are
rendered as text (codes joined by ``, ``; ``*_with_desc`` lists printed as
``['code: name', ...]``) so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import list_repr
from tillroll.operators import basket as B
from tillroll.operators import clean as C
from tillroll.operators import country as G
from tillroll.operators import filters as FL
from tillroll.operators import overview as K
from tillroll.operators import rfm as R
from tillroll.operators import sketches as S
from tillroll.operators import timeline as TL
from tillroll.plans.lineage import Scratch, checkpointed, written_table
from tillroll.plans.lookup import Lookup, lookup_table
from tillroll.session import scratch_path
from tillroll.sources import files as A
from tillroll.sources import testdata as V

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered runs (FIXTURES.md 3).
FILTER_COUNTRIES = ["NATION_1", "NATION_7"]
FILTER_BOTH = (["NATION_3"], "1996-01-01", "1997-06-30")
FILTER_ACTIVITY_DATES = ("2024-01-05", "2024-01-10")
ITEMSETS_RUN = ("p_type", ((0.007, 0.6),), 30)
RULES_RUN = ("p_type", ((0.01, 0.45),), 30)
BACKOFF_RUN = ("l_partkey", ((0.007, 0.6), (0.003, 0.6)), 30)
DESCRIBED_LADDER = ((0.007, 0.1),)
LIMIT_MAX_ITEMS = 5


def flat(df: DataFrame) -> DataFrame:
    """Array columns to text for cross-engine comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            text = list_repr(f.name) if f.name.endswith("_with_desc") else F.array_join(f.name, ", ")
            cols.append(text.alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


# ---- views -------------------------------------------------------------------

def _sales(spark, sf):
    return V.sales(spark, sf)


def _sales_nc(spark, sf):
    return V.sales(spark, sf, null_customers=True)


def _raw(spark, sf):
    return V.raw_sales(spark, sf)


def _valid(spark, sf):
    return C.filter_valid(V.raw_sales(spark, sf))


# ---- A: sources and sinks ----------------------------------------------------

def scan_sales(spark, sf):
    return _sales(spark, sf)


def roundtrip_parquet(spark, sf):
    path = scratch_path(spark, "sales")
    A.write_sales(_sales(spark, sf), path)
    return A.read_sales(spark, path)


def load_sales(spark, sf):
    path = scratch_path(spark, "sales")
    A.write_sales(_sales(spark, sf), path, partition_by=["Year", "Month"])
    loaded = A.load_sales(spark, path)
    return loaded.select(_sales(spark, sf).columns)


def ingest_raw(spark, sf):
    path = scratch_path(spark, "raw")
    (_raw(spark, sf).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return C.clean_sales(A.read_raw(spark, path, escape='"'))


def _raw_with_bad_lines(spark, sf):
    path = scratch_path(spark, "raw_text")
    V.raw_text(spark, sf).write.text(path)
    return written_table(A.read_raw(spark, path, bad_line=A.BAD_LINE, header=False, escape='"'), "raw_lines")


def malformed_counts(spark, sf):
    return C.dropped_counts(_raw_with_bad_lines(spark, sf), bad_line=A.BAD_LINE)


def malformed_lines(spark, sf):
    bad = A.split_bad_lines(_raw_with_bad_lines(spark, sf))[1]
    return bad.groupBy(F.col(A.BAD_LINE).alias("bad_line")).agg(F.count(F.lit(1)).alias("n_lines"))


def ingest_records(spark, sf):
    return C.clean_sales(A.split_bad_lines(_raw_with_bad_lines(spark, sf))[0])


def profile_counts(spark, sf):
    return A.profile(_sales(spark, sf))


def _by_month(spark, sf) -> str:
    path = scratch_path(spark, "sales_by_month")
    A.write_sales(_sales(spark, sf), path, partition_by=["Year", "Month"])
    return path


def footer_profile(spark, sf):
    return A.footer_profile(spark, _by_month(spark, sf))


def footer_bounds(spark, sf):
    return A.footer_bounds(spark, _by_month(spark, sf))


def _bucketed(spark, sf) -> DataFrame:
    path = scratch_path(spark, "sales_by_invoice")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    A.write_sales_bucketed(_sales(spark, sf), path, table, 16)
    return A.read_sales_table(spark, table)


def bucketed_order_values(spark, sf):
    return K.order_values(_bucketed(spark, sf))


def bucketed_baskets(spark, sf):
    return flat(B.baskets(_bucketed(spark, sf)))


def _described(spark, sf, report: Callable[[B.MiningRun, Lookup], DataFrame]) -> DataFrame:
    # Clean once, keep the columns mining and naming read, write it down:
    # the baskets and the product table then scan these files. The report is
    # checkpointed, so that everything it came from can be let go.
    with Scratch(spark) as scratch:
        lines = scratch.table(C.clean_basket_lines(_raw(spark, sf))
                              .select("InvoiceNo", "StockCode", "Description", "Quantity"), "basket_lines")
        run = B.mine_with_backoff(lines, DESCRIBED_LADDER, max_items=30)
        try:
            return checkpointed(report(run, lookup_table(B.product_dim(lines))))
        finally:
            run.close()


def rules_described(spark, sf):
    return _described(spark, sf, lambda run, dim: flat(B.describe_rules(run.rules, dim)))


def roundtrip_rules_csv(spark, sf):
    path = scratch_path(spark, "rules_csv")

    def written(run, dim):
        rules = B.describe_rules(run.rules, dim).select(
            "antecedent", "consequent", "confidence", "lift", "support", "antecedent_with_desc", "consequent_with_desc")
        A.write_rules_csv(rules, path)
        return flat(A.read_rules_csv(spark, path, "rules"))

    return _described(spark, sf, written)


def roundtrip_friendly_rules(spark, sf):
    path = scratch_path(spark, "friendly_csv")

    def written(run, dim):
        A.write_rules_csv(B.friendly_rules(run.rules, dim), path)
        return A.friendly_text(A.read_friendly_rules(spark, path))

    return _described(spark, sf, written)


# ---- C: cleaning -------------------------------------------------------------

def clean_dates(spark, sf):
    return C.parse_dates(_raw(spark, sf))


def clean_numeric(spark, sf):
    return C.coerce_numeric(C.parse_dates(_raw(spark, sf)))


def clean_nonnegative(spark, sf):
    return _valid(spark, sf)


def code_strip_all(spark, sf):
    return C.normalize_code(_raw(spark, sf), "strip_all")


def code_trim(spark, sf):
    return C.normalize_code(_raw(spark, sf), "trim")


def desc_counts(spark, sf):
    return C.description_counts(_valid(spark, sf))


def modal_description(spark, sf):
    return C.modal_description(_valid(spark, sf))


def standardize_description(spark, sf):
    return C.standardize_description(_valid(spark, sf))


def missing_description(spark, sf):
    return C.missing_description(_valid(spark, sf))


def line_total(spark, sf):
    return C.add_total_value(_valid(spark, sf))


def floor_ms(spark, sf):
    return C.floor_ms(V.activity(spark, sf).select("InvoiceNo", "InvoiceDate"))


def calendar_columns(spark, sf):
    return C.add_calendar(V.activity(spark, sf).select("InvoiceNo", "InvoiceDate"))


def clean_summary(spark, sf):
    valid = _valid(spark, sf)
    return C.clean_summary(C.clean_sales(_raw(spark, sf)), C.modal_description(valid))


def weekday_profile(spark, sf):
    return C.weekday_profile(_sales(spark, sf))


def clean_sales(spark, sf):
    return C.clean_sales(_raw(spark, sf))


def clean_basket_lines(spark, sf):
    return C.clean_basket_lines(_raw(spark, sf))


def dropped_counts(spark, sf):
    return C.dropped_counts(_raw(spark, sf))


def clean_kpis(spark, sf):
    return K.kpis(C.clean_sales(_raw(spark, sf)))


# ---- F: filters --------------------------------------------------------------

def filter_country(spark, sf):
    return FL.filter_sales(_sales(spark, sf), countries=FILTER_COUNTRIES)


def filter_dates(spark, sf):
    s, e = FILTER_ACTIVITY_DATES
    return FL.filter_sales(V.activity(spark, sf), start=s, end=e)


def filter_both(spark, sf):
    c, s, e = FILTER_BOTH
    return FL.filter_sales(_sales(spark, sf), countries=c, start=s, end=e)


def filtered_count(spark, sf):
    return FL.filtered_count(filter_both(spark, sf))


def list_countries(spark, sf):
    return FL.list_countries(_sales(spark, sf))


def date_bounds(spark, sf):
    return FL.date_bounds(_sales(spark, sf))


# ---- K: overview -------------------------------------------------------------

def kpis(spark, sf):
    return K.kpis(_sales_nc(spark, sf))


def monthly_revenue(spark, sf):
    return K.monthly_revenue(_sales(spark, sf))


def top_products(spark, sf):
    return K.top_products(_sales(spark, sf))


def order_values(spark, sf):
    return K.order_values(_sales(spark, sf))


def order_value_p95(spark, sf):
    return K.order_value_p95(_sales(spark, sf), exact=True)


def order_value_p95_approx(spark, sf):
    """The default percentile is off by at most 1/10000 of the ranks: whether
    the limit's rank is that near (one row)."""
    orders = checkpointed(K.order_values(_sales(spark, sf)))
    limit = K.order_value_percentile(orders).scalar()
    n = F.count(F.lit(1))
    upto, below = F.count_if(F.col("TotalValue") <= limit), F.count_if(F.col("TotalValue") < limit)
    return orders.agg(n.alias("n_orders"), ((upto >= (0.95 - 2e-4) * n) & (below <= (0.95 + 2e-4) * n + 1)).alias("within"))


def trimmed_order_values(spark, sf):
    return K.trimmed_order_values(_sales(spark, sf), exact=True)


def order_value_histogram(spark, sf):
    return K.order_value_histogram(_sales(spark, sf), exact=True)


# ---- G: country --------------------------------------------------------------

def country_metrics(spark, sf):
    return G.country_metrics(_sales_nc(spark, sf))


def top_countries_revenue(spark, sf):
    return G.top_countries(_sales(spark, sf), "Revenue").select("Country", "Revenue", "Orders")


def top_countries_aov(spark, sf):
    return G.top_countries(_sales(spark, sf), "Avg_Order_Value").select("Country", "Avg_Order_Value")


# ---- sketches: approximate distinct counts -------------------------------------

def _near(estimate: str, exact: str):
    """Within 5 %, three standard errors."""
    return F.abs(F.col(estimate) - F.col(exact)) <= 0.05 * F.col(exact)


def _against_exact(sketches: DataFrame, exact: DataFrame, keys: list[str]) -> DataFrame:
    found = S.estimated(S.rolled_up(sketches, keys)).select(*keys, "n_lines", "Revenue", F.col("Orders").alias("o"), F.col("Customers").alias("c"))
    return found.join(exact, keys).select(*keys, "n_lines", "Revenue", _near("o", "Orders").alias("orders_near"), _near("c", "Customers").alias("customers_near"))


def _exact_counts(sales: DataFrame, keys: list[str]) -> DataFrame:
    return sales.groupBy(*keys).agg(F.countDistinct("InvoiceNo").alias("Orders"), F.countDistinct("CustomerID").alias("Customers"))


def approx_country_metrics(spark, sf):
    """G1 from month and country sketches: revenue, and whether the distinct
    counts are as near as promised."""
    sales = _sales_nc(spark, sf)
    return _against_exact(S.sketched(sales, ["Country", "Year", "Month"]), _exact_counts(sales, ["Country"]), ["Country"])


def approx_monthly_metrics(spark, sf):
    sales = _sales_nc(spark, sf)
    return _against_exact(S.sketched(sales, ["Country", "Year", "Month"]), _exact_counts(sales, ["Year", "Month"]), ["Year", "Month"])


def approx_heatmap(spark, sf):
    """T4 from finer sketches."""
    lines = V.activity(spark, sf)
    return _against_exact(S.sketched(lines, ["Country", "DayOfWeek", "Hour"]), _exact_counts(lines, ["DayOfWeek", "Hour"]), ["DayOfWeek", "Hour"])


# ---- T: time -----------------------------------------------------------------

def hourly(spark, sf):
    return TL.hourly(V.activity(spark, sf))


def weekday_revenue(spark, sf):
    return TL.weekday_revenue(_sales(spark, sf))


def daily_trend(spark, sf):
    return TL.daily_trend(_sales(spark, sf))


def heatmap_long(spark, sf):
    return TL.heatmap_long(V.activity(spark, sf))


def heatmap_matrix(spark, sf):
    return TL.heatmap_matrix(V.activity(spark, sf))


def month_year_revenue(spark, sf):
    return TL.month_year_revenue(_sales(spark, sf))


def monthly_country_revenue(spark, sf):
    return TL.monthly_country_revenue(_sales(spark, sf))


def monthly_growth(spark, sf):
    return TL.monthly_growth(_sales(spark, sf))


def growth_signed(spark, sf):
    return TL.growth_signed(_sales(spark, sf))


# ---- R: RFM ------------------------------------------------------------------

def rfm_reference_date(spark, sf):
    return R.rfm_reference_date(_sales_nc(spark, sf))


def rfm_base(spark, sf):
    return R.rfm_base(_sales_nc(spark, sf))


def rfm_r_score(spark, sf):
    return R.rfm_r_score(R.rfm_base(_sales_nc(spark, sf))).select("CustomerID", "Recency", "R_Score")


def rfm_fm_score(spark, sf):
    return R.rfm_scores(_sales_nc(spark, sf)).select("CustomerID", "Frequency", "Monetary", "F_Score", "M_Score")


def rfm_score(spark, sf):
    return R.rfm_scores(_sales_nc(spark, sf))


def rfm_segments(spark, sf):
    return R.rfm_segments(_sales_nc(spark, sf))


def segment_counts(spark, sf):
    return R.segment_counts(R.rfm_segments(_sales_nc(spark, sf)))


def rfm_sample(spark, sf):
    return R.rfm_sample(R.rfm_segments(_sales_nc(spark, sf)))


# ---- B: market basket --------------------------------------------------------

def _mined(spark, sf, run, report: Callable[[B.MiningRun], DataFrame], **options) -> DataFrame:
    item, ladder, max_items = run
    mined = B.mine_with_backoff(V.basket_source(spark, sf, item), ladder, max_items, **options)
    try:
        return checkpointed(flat(report(mined)))
    finally:
        mined.close()


def product_dim(spark, sf):
    return B.product_dim(C.clean_basket_lines(_raw(spark, sf)))


def baskets(spark, sf):
    return flat(B.baskets(V.basket_source(spark, sf, "p_type")))


def basket_count(spark, sf):
    return B.basket_count(B.baskets(V.basket_source(spark, sf, "p_type")))


def basket_size_distribution(spark, sf):
    return B.basket_size_distribution(B.baskets(V.basket_source(spark, sf, "l_partkey")))


def basket_limit(spark, sf):
    return B.basket_limit_summary(B.basket_sizes(B.basket_items(V.basket_source(spark, sf, "l_partkey"))), LIMIT_MAX_ITEMS)


def baskets_within_limit(spark, sf):
    return flat(B.baskets(V.basket_source(spark, sf, "l_partkey"), max_items=LIMIT_MAX_ITEMS))


def frequent_itemsets(spark, sf):
    return _mined(spark, sf, ITEMSETS_RUN, lambda run: run.itemsets)


def projected_itemsets(spark, sf):
    """The same run without FP-Growth: no item's database is one task."""
    return _mined(spark, sf, ITEMSETS_RUN, lambda run: run.itemsets, split_cells=0)


def projected_rules(spark, sf):
    return _mined(spark, sf, RULES_RUN, lambda run: run.rules, split_cells=0)


def itemsets_backoff(spark, sf):
    return _mined(spark, sf, BACKOFF_RUN, lambda run: run.itemsets.withColumn("min_support", F.lit(run.min_support)))


def association_rules(spark, sf):
    return _mined(spark, sf, RULES_RUN, lambda run: run.rules)


def itemsets_described(spark, sf):
    return _described(spark, sf, lambda run, dim: flat(B.describe_itemsets(run.itemsets, dim)))


def top_rules_confidence(spark, sf):
    return _described(spark, sf, lambda run, dim: flat(B.top_rules(run.rules, "confidence", dim=dim)))


def top_rules_lift(spark, sf):
    return _described(spark, sf, lambda run, dim: flat(B.top_rules(run.rules, "lift", dim=dim)))


def friendly_rules(spark, sf):
    return _described(spark, sf, lambda run, dim: B.friendly_rules(run.rules, dim))


def top_itemsets(spark, sf):
    return _described(spark, sf, lambda run, dim: flat(B.top_itemsets(run.itemsets, dim)))


def mining_summary(spark, sf):
    return _described(spark, sf, lambda run, dim: B.mining_summary(run))


QUERIES: dict[str, Query] = {name: fn for name, fn in [
    ("scan_sales", scan_sales), ("roundtrip_parquet", roundtrip_parquet),
    ("roundtrip_rules_csv", roundtrip_rules_csv), ("roundtrip_friendly_rules", roundtrip_friendly_rules),
    ("malformed_counts", malformed_counts), ("malformed_lines", malformed_lines), ("ingest_records", ingest_records), ("profile_counts", profile_counts),
    ("footer_profile", footer_profile), ("footer_bounds", footer_bounds),
    ("bucketed_order_values", bucketed_order_values), ("bucketed_baskets", bucketed_baskets),
    ("clean_dates", clean_dates), ("clean_numeric", clean_numeric), ("clean_nonnegative", clean_nonnegative),
    ("code_strip_all", code_strip_all), ("code_trim", code_trim), ("desc_counts", desc_counts),
    ("modal_description", modal_description), ("standardize_description", standardize_description),
    ("missing_description", missing_description), ("line_total", line_total), ("floor_ms", floor_ms),
    ("calendar_columns", calendar_columns), ("clean_summary", clean_summary),
    ("weekday_profile", weekday_profile), ("clean_sales", clean_sales),
    ("clean_basket_lines", clean_basket_lines), ("dropped_counts", dropped_counts), ("clean_kpis", clean_kpis),
    ("ingest_raw", ingest_raw), ("load_sales", load_sales),
    ("filter_country", filter_country), ("filter_dates", filter_dates), ("filter_both", filter_both), ("filtered_count", filtered_count),
    ("list_countries", list_countries), ("date_bounds", date_bounds),
    ("kpis", kpis), ("monthly_revenue", monthly_revenue), ("top_products", top_products),
    ("order_values", order_values), ("order_value_p95", order_value_p95),
    ("order_value_p95_approx", order_value_p95_approx),
    ("trimmed_order_values", trimmed_order_values), ("order_value_histogram", order_value_histogram),
    ("country_metrics", country_metrics), ("top_countries_revenue", top_countries_revenue),
    ("top_countries_aov", top_countries_aov),
    ("approx_country_metrics", approx_country_metrics), ("approx_monthly_metrics", approx_monthly_metrics), ("approx_heatmap", approx_heatmap),
    ("hourly", hourly), ("weekday_revenue", weekday_revenue), ("daily_trend", daily_trend),
    ("heatmap_long", heatmap_long), ("heatmap_matrix", heatmap_matrix),
    ("month_year_revenue", month_year_revenue), ("monthly_country_revenue", monthly_country_revenue),
    ("monthly_growth", monthly_growth), ("growth_signed", growth_signed),
    ("rfm_reference_date", rfm_reference_date), ("rfm_base", rfm_base), ("rfm_r_score", rfm_r_score),
    ("rfm_fm_score", rfm_fm_score), ("rfm_score", rfm_score), ("rfm_segments", rfm_segments),
    ("segment_counts", segment_counts), ("rfm_sample", rfm_sample),
    ("product_dim", product_dim), ("baskets", baskets), ("basket_count", basket_count),
    ("basket_size_distribution", basket_size_distribution), ("basket_limit", basket_limit),
    ("baskets_within_limit", baskets_within_limit), ("projected_itemsets", projected_itemsets), ("projected_rules", projected_rules),
    ("frequent_itemsets", frequent_itemsets), ("itemsets_backoff", itemsets_backoff),
    ("association_rules", association_rules), ("itemsets_described", itemsets_described),
    ("rules_described", rules_described), ("top_rules_confidence", top_rules_confidence),
    ("top_rules_lift", top_rules_lift), ("friendly_rules", friendly_rules),
    ("top_itemsets", top_itemsets), ("mining_summary", mining_summary),
]}

"""Unit tests on hand-made frames (FIXTURES.md section 4)."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillroll.functions.columns import truncate_text
from tillroll.operators import basket as B
from tillroll.operators import clean as C
from tillroll.operators import filters as FL
from tillroll.operators import overview as K
from tillroll.operators import rfm as R
from tillroll.operators import timeline as TL
from tillroll.plans.ranking import global_row_number, kth_smallest


def test_modal_name_tie_goes_to_first_name(spark):
    df = spark.createDataFrame(
        [("a", "y"), ("a", "x"), ("a", "y"), ("a", "x"), ("b", "z")], "StockCode string, Description string")
    got = {r.StockCode: r.Description for r in C.modal_description(df).collect()}
    assert got == {"a": "x", "b": "z"}


def test_blank_and_null_names_are_not_counted_and_missing_get_unknown(spark):
    df = spark.createDataFrame([("a", ""), ("a", None), ("b", "n"), ("b", "")],
                               "StockCode string, Description string")
    out = {r.StockCode: r.Description for r in C.standardize_description(df).collect()}
    assert out == {"a": "Unknown Product", "b": "n"}
    assert C.missing_description(df).first().n_missing == 2


def test_strip_all_vs_trim(spark):
    df = spark.createDataFrame([(" 85 123a\t",)], "StockCode string")
    assert C.normalize_code(df, "strip_all").first().StockCode == "85123A"
    assert C.normalize_code(df, "trim").first().StockCode == "85 123A\t"


def test_bad_values_are_dropped(spark):
    raw = spark.createDataFrame(
        [("1", "c", "d", "2", "2011-01-02 10:00:00", "1.5", None, "X"),
         ("2", "c", "d", "bad", "2011-01-02 10:00:00", "1.5", None, "X"),
         ("3", "c", "d", "2", "not a date", "1.5", None, "X"),
         ("4", "c", "d", "-1", "2011-01-02 10:00:00", "1.5", None, "X"),
         ("5", "c", "d", "0", "2011-01-02 10:00:00", "n/a", None, "X"),
         ("6", "c", "d", "0", "2011-01-02 10:00:00", "0", None, "X")],
        "InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate string, "
        "UnitPrice string, CustomerID string, Country string")
    got = sorted(r.InvoiceNo for r in C.clean_sales(raw).collect())
    assert got == ["1", "6"]  # zero quantity and price are kept
    row = C.clean_sales(raw).filter("InvoiceNo = '1'").first()
    assert (row.TotalValue, row.Year, row.Hour, row.DayOfWeek) == (3.0, 2011, 10, 6)  # 2011-01-02 is a Sunday


def test_month_first_dates_parse(spark):
    df = spark.createDataFrame([("12/1/2010 8:26",), ("2011-12-09 12:50:00",), ("13/45/2010 8:26",)],
                               "InvoiceDate string")
    got = sorted(r.InvoiceDate for r in C.parse_dates(df).collect())
    assert got == [dt.datetime(2010, 12, 1, 8, 26), dt.datetime(2011, 12, 9, 12, 50)]


def test_floor_ms(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "InvoiceDate timestamp_ntz")
    assert C.floor_ms(df).first().InvoiceDate == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)


def test_end_day_is_included_whole(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2011, 3, 31, 23, 59, 59, 500000), "A"), (dt.datetime(2011, 4, 1, 0, 0, 0), "A"),
         (dt.datetime(2011, 3, 1, 0, 0, 0), "B")], "InvoiceDate timestamp_ntz, Country string")
    out = FL.filter_sales(df, start="2011-03-01", end="2011-03-31").collect()
    assert len(out) == 2
    assert FL.filter_sales(df, countries=["B"], start="2011-03-01", end="2011-03-31").count() == 1
    assert FL.filter_sales(df, start="2011-03-01").count() == 3  # one end only: no date filter


def test_growth_null_after_zero_and_across_gap(spark):
    df = spark.createDataFrame([("A", 2011, 1, 0.0), ("A", 2011, 2, 5.0), ("A", 2011, 4, 10.0)],
                               "Country string, Year int, Month int, TotalValue double")
    rows = {(r.Month): r.GrowthRate for r in TL.monthly_growth(df).collect()}
    assert rows[1] is None and rows[2] is None and rows[4] == 100.0
    signed = TL.growth_signed(df).collect()
    assert [(r.Month, r.Sign, r.MonthYear) for r in signed] == [(4, "Positive Growth", "April 2011")]


def _pandas_rank_terciles(values):
    s = pd.Series(values)
    return pd.qcut(s.rank(method="first"), 3, labels=[1, 2, 3]).astype(int).tolist()


@pytest.mark.parametrize("n", range(3, 13))
def test_fm_terciles_match_pandas_rank_qcut(spark, n):
    vals = [(i * 7) % 4 for i in range(n)]  # many ties
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "CustomerID long, Frequency long")
    got = {r.CustomerID: r.F_Score for r in R.rank_score(df, "Frequency", "F_Score").collect()}
    # pandas 'first' rank breaks ties by position, i.e. by CustomerID here
    assert [got[i] for i in range(n)] == _pandas_rank_terciles(vals)


@pytest.mark.parametrize("n", [3, 4, 5, 7, 10, 31])
def test_recency_terciles_match_pandas_value_qcut(spark, n):
    vals = sorted({(i * 37) % 97 for i in range(n)})[:n]
    n = len(vals)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "CustomerID long, Recency int")
    got = {r.CustomerID: r.R_Score for r in R.rfm_r_score(df).collect()}
    want = pd.qcut(pd.Series(vals), 3, labels=[3, 2, 1]).astype(int).tolist()
    assert [got[i] for i in range(n)] == want


def test_segments(spark):
    df = spark.createDataFrame([(s,) for s in (3, 4, 6, 7, 9)], "RFM_Score int")
    got = [r.s for r in df.select(R.segment_of("RFM_Score").alias("s")).collect()]
    assert got == ["Low Value", "Mid Value", "Mid Value", "High Value", "High Value"]


def test_segment_counts_keep_empty_segments(spark):
    df = spark.createDataFrame([("High Value",), ("High Value",), ("Mid Value",)], "Segment string")
    got = [(r.Segment, r.Count) for r in R.segment_counts(df).collect()]
    assert got == [("High Value", 2), ("Mid Value", 1), ("Low Value", 0)]


def test_truncation(spark):
    df = spark.createDataFrame([("a" * 74,), ("b" * 75,), ("c" * 76,)], "t string")
    got = [r.t for r in df.select(truncate_text("t", 75).alias("t")).collect()]
    assert got == ["a" * 74, "b" * 75, "c" * 75 + "..."]


def test_empty_baskets_give_no_itemsets(spark):
    lines = spark.createDataFrame([], "InvoiceNo string, StockCode string, Quantity long")
    run = B.mine_with_backoff(lines, ((0.5, 0.5),))
    assert run.itemsets.count() == 0 and run.rules.count() == 0


def test_rule_identities(spark):
    rows = [("1", "a"), ("1", "b"), ("2", "a"), ("2", "b"), ("3", "a"), ("4", "c"), ("4", "b")]
    lines = spark.createDataFrame([(i, s, 1) for i, s in rows], "InvoiceNo string, StockCode string, Quantity long")
    run = B.mine_with_backoff(lines, ((0.25, 0.1),))
    sets = {tuple(r["items"]): r.freq for r in run.itemsets.collect()}
    assert sets[("a",)] == 3 and sets[("a", "b")] == 2
    for r in run.rules.collect():
        union = tuple(sorted(r.antecedent + r.consequent))
        assert r.confidence == pytest.approx(sets[union] / sets[tuple(r.antecedent)])
        assert r.support == pytest.approx(sets[union] / 4)
        assert r.lift == pytest.approx(r.confidence / (sets[tuple(r.consequent)] / 4))
    # anti-monotone support
    for items, f in sets.items():
        for i in range(len(items)):
            sub = items[:i] + items[i + 1:]
            if sub:
                assert sets[sub] >= f


def test_describe_keeps_order_and_falls_back(spark):
    rules = spark.createDataFrame([(["b", "a"], ["z"], 0.5, 2.0, 0.1)],
                                  "antecedent array<string>, consequent array<string>, confidence double, "
                                  "lift double, support double")
    dim = spark.createDataFrame([("a", "Apple"), ("b", "Bread")], "StockCode string, Description string")
    r = B.describe_rules(rules, dim).first()
    assert r.antecedent_with_desc == ["b: Bread", "a: Apple"]
    assert r.consequent_with_desc == ["z: Không có mô tả"]
    f = B.friendly_rules(rules, dim).first()
    assert (f.rule_id, f.antecedent_codes, f.antecedent_descriptions) == (1, "b, a", "Bread; Apple")


def test_global_row_number_equals_single_partition_row_number(spark):
    import random

    rnd = random.Random(7)
    data = [(i, rnd.randint(0, 50), rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, k long, v double").repartition(5)
    want = {i: n + 1 for n, (i, _, _) in enumerate(sorted(data, key=lambda t: (t[1], t[0])))}
    for parts in (7, None):  # explicit count, and AQE-coalesced ranges
        got = {r.id: r["rank"] for r in global_row_number(df, ["k", "id"], num_partitions=parts).collect()}
        assert got == want


def test_kth_smallest_is_percentile_disc(spark):
    for n in (1, 2, 20, 21, 30, 101):
        df = spark.createDataFrame([(float(v),) for v in range(n, 0, -1)], "TotalValue double")
        got = kth_smallest(df, ["TotalValue"], p=0.95).first().TotalValue
        want = spark.createDataFrame([(float(v),) for v in range(1, n + 1)], "x double").agg(
            F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY x)").alias("p")).first().p
        assert got == want, n


def test_percentile_disc_window_and_fallback(spark):
    import random

    from tillroll.plans.ranking import percentile_disc

    rnd = random.Random(3)
    vals = [float(rnd.randint(0, 500)) for _ in range(5000)] + [250.0] * 3000  # a hot value
    df = spark.createDataFrame([(v,) for v in vals], "TotalValue double")
    want_sorted = sorted(vals)
    for p in (0.05, 0.5, 0.95, 1.0):
        import math
        k = max(math.ceil(p * len(vals) - 1e-9), 1)
        for acc in (100, 100_000):  # coarse sketch may miss: exact fallback
            got = percentile_disc(df, "TotalValue", p, accuracy=acc).first().TotalValue
            assert got == want_sorted[k - 1], (p, acc)
    assert percentile_disc(df.limit(0), "TotalValue", 0.5).count() == 0


def test_histogram_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)], "TotalValue double")
    h = K.histogram(df, bins=50).collect()
    assert len(h) == 50 and sum(r.n_orders for r in h) == 101 and h[-1].n_orders == 3
    same = spark.createDataFrame([(5.0,), (5.0,)], "TotalValue double")
    h = K.histogram(same, bins=50).collect()
    assert h[0].n_orders == 2 and sum(r.n_orders for r in h) == 2


def test_kpis_zero_orders(spark):
    df = spark.createDataFrame([], "TotalValue double, InvoiceNo string, CustomerID long")
    r = K.kpis(df).first()
    assert r.total_invoices == 0 and r.avg_order_value == 0.0

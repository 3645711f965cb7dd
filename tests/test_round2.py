"""Findings of the first review: sums, odd numbers, zones, sessions, mining."""

import datetime as dt
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tillroll.functions.columns import money_sum
from tillroll.operators import basket as B
from tillroll.operators import clean as C
from tillroll.operators import filters as FL
from tillroll.session import get_session

RAW = "InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate string, UnitPrice string, CustomerID string, Country string"


def raw(spark, cells):
    return spark.createDataFrame([("1", "A", "n", q, d, p, "7", "UK") for q, d, p in cells], RAW)


def test_money_sums_keep_parts_of_a_cent_and_do_not_overflow(spark):
    total = lambda rows: spark.createDataFrame([(x,) for x in rows], "x double").agg(money_sum("x")).first()[0]
    assert total([0.004] * 1000) == 4.0
    assert total([9e16] * 20) == 1.8e18
    assert total([0.1] * 10) == 1.0 and total([]) is None and total([None]) is None
    assert total([1e30, 1.0]) == 1e30 and total([float("inf"), 1.0]) == float("inf")


@pytest.mark.parametrize("text,value", [("5", 5.0), (" 1.5 ", 1.5), ("1e30", 1e30), ("-2", -2.0), (".5", 0.5), ("5.", 5.0), ("+3E2", 300.0), ("NaN", None),
                                        ("Infinity", None), ("-inf", None), ("1d", None), ("5f", None), ("1e400", None), ("", None), (None, None), ("0x1p3", None)])
def test_numbers(spark, text, value):
    got = C.coerce_numeric(raw(spark, [(text, "2011-01-01", "1")])).collect()
    assert [r["Quantity"] for r in got] == ([] if value is None else [value])
    got = C.coerce_numeric(raw(spark, [("1", "2011-01-01", text)])).collect()
    assert [r["UnitPrice"] for r in got] == ([] if value is None else [value])


def test_numbers_that_are_typed_already(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (1.5, float("inf")), (2.5, 0.5)], "Quantity double, UnitPrice double")
    assert [tuple(r) for r in C.coerce_numeric(df).collect()] == [(2.5, 0.5)]


def test_dropped_rows_are_counted_by_rule(spark):
    cells = [("1", "2011-01-01", "1"), ("x", "2011-01-01", "1"), ("1", "soon", "1"), ("-1", "2011-01-01", "1"), ("NaN", "never", "1"), ("1", "31.12.2011", "1")]
    assert tuple(C.dropped_counts(raw(spark, cells)).first()) == (6, 3, 1, 1, 1)
    assert tuple(C.dropped_counts(raw(spark, cells), ["dd.MM.yyyy"]).first()) == (6, 2, 1, 1, 2)
    assert C.clean_sales(raw(spark, cells), ["dd.MM.yyyy"]).count() == 2
    assert C.clean_basket_lines(raw(spark, cells), ["dd.MM.yyyy"]).count() == 2


def test_layouts_are_wall_clock_in_any_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = C.parse_dates(raw(spark, [("1", "3/13/2011 2:30", "1"), ("1", "2011-03-13 02:30:00", "1"), ("1", "12/1/10 8:26", "1")])).collect()
        assert [r["InvoiceDate"] for r in got] == [dt.datetime(2011, 3, 13, 2, 30)] * 2 + [dt.datetime(2010, 12, 1, 8, 26)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_running_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = get_session(shuffle_partitions=3)
        assert again.conf.get("spark.sql.session.timeZone") == "Asia/Kolkata"
        assert again.conf.get("spark.sql.adaptive.enabled") == "false" and again.conf.get("spark.sql.shuffle.partitions") == "8"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_bare_country_name_is_refused(spark):
    with pytest.raises(TypeError):
        FL.filter_sales(spark.createDataFrame([("UK",)], "Country string"), "UK")


def test_an_empty_ladder_is_refused(spark):
    with pytest.raises(ValueError):
        B.mine_with_backoff(spark.createDataFrame([("1", "a", 1)], "InvoiceNo string, StockCode string, Quantity int"), ())


def test_an_item_in_a_third_of_all_baskets_and_no_size_limit(spark):
    """Exact counts with one very common item and one very large basket."""
    sets = [{f"i{(k * j) % 23}" for j in range(1, 5)} | ({"hot"} if k % 3 == 0 else set()) for k in range(1, 301)]
    sets.append({f"i{k}" for k in range(23)} | {f"rare{k}" for k in range(40)})
    lines = spark.createDataFrame([(str(n), i, 1) for n, s in enumerate(sets) for i in s], "InvoiceNo string, StockCode string, Quantity int")
    run = B.mine_with_backoff(lines, ((0.05, 0.5),))
    got = {tuple(r["items"]): r["freq"] for r in run.itemsets.collect()}
    limits = run.limits.first()
    run.close()
    counts = Counter()
    for s in sets:
        frequent = sorted(x for x in s if not x.startswith("rare"))
        if len(frequent) < 10:  # the one large basket is added below
            for k in range(1, len(frequent) + 1):
                counts.update(combinations(frequent, k))
    for items in list(counts):
        counts[items] += set(items) <= sets[-1]
    assert got == {i: c for i, c in counts.items() if c >= 0.05 * len(sets)}
    assert limits["n_dropped"] == 0 and limits["n_kept"] == len(sets)


def test_mining_reports_number_rules_over_all_rules(spark):
    rules = spark.createDataFrame([([f"a{k % 7}", f"b{k}"], ["c"], 0.5 + k / 100, 1.0, 0.1) for k in range(30)],
                                  "antecedent array<string>, consequent array<string>, confidence double, lift double, support double")
    dim = spark.createDataFrame([("c", "C's")], "StockCode string, Description string")
    numbered = {(r["antecedent"][1]): r["rule_id"] for r in B.number_rules(rules).collect()}
    got = B.friendly_rules(rules, dim, 5)
    assert dict(got.dtypes)["rule_id"] == "bigint"
    for r in got.collect():
        assert r["rule_id"] == numbered[r["antecedent_codes"].split(", ")[1]]


def test_nothing_stays_persisted_after_a_mining_query(spark):
    from tillroll.plans import registry

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    out = registry.QUERIES["mining_summary"](spark, "/root/testdata/sf0.001")
    assert out.count() == 1 and F is not None
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_cut_keys_are_those_of_a_full_sort(spark):
    import random

    from tillroll.plans.ranking import kth_keys

    r = random.Random(0)
    rows = [(k, r.choice([1, 1, 1, 2, 5]), r.random() * 100, f"c{k % 50:03d}-{k}") for k in r.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "CustomerID int, Frequency int, Monetary double, Name string")
    for metric, ident, key in (("Frequency", "CustomerID", lambda x: (x[1], x[0])), ("Monetary", "CustomerID", lambda x: (x[2], x[0])), ("Frequency", "Name", lambda x: (x[1], x[3]))):
        ordered = sorted(map(key, rows))
        ks = [1, 233, 467, 700]
        assert kth_keys(df, metric, ident, ks, 700) == [ordered[k - 1] for k in ks]


def test_scores_leave_the_customer_table_unsorted(spark):
    from tillroll.operators import rfm as R
    from tillroll.sources import testdata as V

    out = R.rfm_scores(V.sales(spark, "/root/testdata/sf0.001", null_customers=True))
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString() and out.count() > 0

"""Cross-operator identities on the sf0.001 tables."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import basket as B
from tillroll.operators import country as G
from tillroll.operators import overview as K
from tillroll.operators import rfm as R
from tillroll.operators import timeline as TL
from tillroll.sources import testdata as V

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sales(spark):
    return V.sales(spark, SF, null_customers=True).persist()


def test_revenue_agrees_across_groupings(sales):
    total = K.kpis(sales).first().total_revenue
    by_month = K.monthly_revenue(sales).agg(F.sum("Revenue")).first()[0]
    by_country = G.country_metrics(sales).agg(F.sum("Revenue")).first()[0]
    by_day = TL.daily_trend(sales).agg(F.sum("Revenue")).first()[0]
    assert total == pytest.approx(by_month) == pytest.approx(by_country) == pytest.approx(by_day)


def test_orders_agree(sales):
    k = K.kpis(sales).first()
    assert K.order_values(sales).count() == k.total_invoices
    assert k.avg_order_value == pytest.approx(k.total_revenue / k.total_invoices)


def test_segments_cover_every_customer(sales):
    seg = R.rfm_segments(sales)
    n = sales.filter(F.col("CustomerID").isNotNull()).select("CustomerID").distinct().count()
    assert R.segment_counts(seg).agg(F.sum("Count")).first()[0] == n == seg.count()
    s = seg.agg(F.min("RFM_Score"), F.max("RFM_Score")).first()
    assert 3 <= s[0] <= s[1] <= 9


def test_histogram_counts_all_trimmed_orders(sales):
    trimmed = K.trimmed_order_values(sales, exact=True)
    hist = K.histogram(trimmed)
    assert hist.agg(F.sum("n_orders")).first()[0] == trimmed.count()
    assert hist.count() == 50


def test_heatmap_matrix_matches_long_form(spark):
    act = V.activity(spark, SF)
    long = {(r.DayOfWeek, r.Hour): r.Orders for r in TL.heatmap_long(act).collect()}
    wide = TL.heatmap_matrix(act).collect()
    assert [r.DayOfWeek for r in wide] == list(range(7))
    for r in wide:
        for h in range(24):
            assert r[f"h{h:02d}"] == long.get((r.DayOfWeek, h))


def test_itemset_support_is_anti_monotone(spark):
    run = B.mine_with_backoff(V.basket_source(spark, SF, "p_type"), ((0.01, 0.3),))
    sets = {tuple(r["items"]): r.freq for r in run.itemsets.collect()}
    assert sets
    for items, f in sets.items():
        for i in range(len(items)):
            sub = items[:i] + items[i + 1:]
            if sub:
                assert sets[sub] >= f
    n = run.used.count()
    for r in run.rules.collect():
        union = tuple(sorted(r.antecedent + r.consequent))
        assert r.support == pytest.approx(sets[union] / n)
        assert r.confidence >= 0.3

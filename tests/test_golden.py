
import pytest
from pyspark.sql import functions as F

from tillroll.operators import basket as B
from tillroll.operators import clean as C
from tillroll.operators import overview as K
from tillroll.operators import timeline as TL
from tillroll.sources import testdata as V

SF = "/root/testdata/sf0.01"


def test_cleaning_counts(spark):
    raw = V.raw_sales(spark, SF)
    clean = C.clean_sales(raw)
    assert clean.count() == 54_472
    assert clean.select("StockCode").distinct().count() == 50
    assert C.clean_basket_lines(raw).select("StockCode").distinct().count() == 25
    names = {r.StockCode: r.Description for r in C.clean_basket_lines(raw)
             .filter(F.col("StockCode") == "BRAND#13").select("StockCode", "Description").distinct().collect()}
    assert names == {"BRAND#13": "Unknown Product"}


def test_aggregate_sizes(spark):
    sales = V.sales(spark, SF)
    assert K.monthly_revenue(sales).count() == 80
    assert TL.monthly_growth(sales).count() == 1_975
    assert TL.heatmap_long(V.activity(spark, SF)).count() == 168
    assert K.order_values(sales).count() == 14_743


@pytest.mark.parametrize("item,ladder,itemsets,rules", [
    ("p_type", ((0.007, 0.6),), 63, 0),
    ("p_type", ((0.01, 0.45),), None, 184),
    ("p_type", ((0.01, 0.5),), None, 28),
    ("p_brand", ((0.007, 0.1),), 325, 600),
    ("l_partkey", ((0.007, 0.6), (0.003, 0.6)), 16, None),
])
def test_mining_counts(spark, item, ladder, itemsets, rules):
    run = B.mine_with_backoff(V.basket_source(spark, SF, item), ladder)
    if itemsets is not None:
        assert run.itemsets.count() == itemsets
    if rules is not None:
        assert run.rules.count() == rules
    if item == "l_partkey":
        assert run.min_support == 0.003
    run.close()


def test_basket_limit(spark):
    b = B.baskets(V.basket_source(spark, SF, "l_partkey"))
    s = B.basket_limit_summary(b, 5).first()
    assert (s.n_baskets, s.n_kept) == (14_743, 11_528)

"""Property-based checks of the distributed order statistics."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillroll.plans.ranking import global_row_number, percentile_disc

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=60),
       st.sampled_from([0.01, 0.33, 0.5, 0.95, 1.0]))
def test_percentile_disc_is_the_ceil_p_n_th_value(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "TotalValue double")
    k = max(math.ceil(round(p * len(values), 9)), 1)
    got = percentile_disc(df, "TotalValue", p, accuracy=50).first().TotalValue
    assert got == sorted(values)[k - 1]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 10_000)), min_size=1, max_size=80, unique_by=lambda t: t[1]))
def test_global_row_number_is_a_total_order_position(spark, rows):
    df = spark.createDataFrame(rows, "k int, id long")
    got = {r.id: r["rank"] for r in global_row_number(df, ["k", "id"], num_partitions=3).collect()}
    want = {i: n + 1 for n, (_, i) in enumerate(sorted(rows))}
    assert got == want

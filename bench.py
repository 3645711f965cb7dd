"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full (``noop`` sink: every row is produced, none
is collected) after one warm-up pass over the whole set; the median of
``$BENCH_RUNS`` timed runs is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.plans.registry import QUERIES  # noqa: E402
from tillroll.session import get_session  # noqa: E402

HEADLINE = [
    "clean_sales", "kpis", "monthly_revenue", "top_products", "order_value_histogram",
    "country_metrics", "daily_trend", "heatmap_matrix", "monthly_growth", "rfm_segments",
    "frequent_itemsets", "association_rules", "friendly_rules",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(f"local[{cpus}]", app_name="tillroll-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": "16g"})

    def run(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for name in HEADLINE:  # warm-up: JIT, file listing, Python workers
        run(name)
    times = {name: round(statistics.median(run(name) for _ in range(runs)), 3) for name in HEADLINE}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs,
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()

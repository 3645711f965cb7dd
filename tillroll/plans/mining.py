"""The mining program as one call: clean basket lines -> CSV reports.

Writes the four reports of a mining run (each a CSV folder with a header,
arrays as JSON text): frequent itemsets with names, all rules with names,
the top rules by confidence, and the readable top-rule report. Returns the
one-row run summary (B18).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.operators import basket as B
from tillroll.plans.lookup import lookup_table
from tillroll.sources.files import write_rules_csv

REPORTS = ("frequent_itemsets_with_desc", "association_rules_with_desc",
           "top_association_rules_with_desc", "friendly_top_rules")


def mine_and_report(lines: DataFrame, out_dir: str, ladder=B.DEFAULT_LADDER, max_items: int | None = None,
                    top_n: int = 20, num_partitions: int | None = None) -> DataFrame:
    """B1-B18 + A4 on clean basket lines. Give a table of them (C15 written):
    it is scanned twice, for the baskets and for the product table."""
    run = B.mine_with_backoff(lines, ladder, max_items, num_partitions=num_partitions)
    dim = lookup_table(B.product_dim(lines))
    rules = B.describe_rules(run.rules, dim)
    out = out_dir.rstrip("/")
    write_rules_csv(B.describe_itemsets(run.itemsets, dim), f"{out}/{REPORTS[0]}")
    write_rules_csv(rules.drop("antecedent_names", "consequent_names"), f"{out}/{REPORTS[1]}")
    write_rules_csv(B.top_rules(run.rules, "confidence", top_n, dim).drop("antecedent_names", "consequent_names", "rule"),
                    f"{out}/{REPORTS[2]}")
    write_rules_csv(B.friendly_rules(run.rules, dim, top_n), f"{out}/{REPORTS[3]}")
    summary = B.mining_summary(run)
    summary = summary.sparkSession.createDataFrame(summary.collect(), summary.schema)  # one row
    run.close()
    return summary

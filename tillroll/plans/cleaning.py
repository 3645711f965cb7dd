"""The cleaning program as one call: raw lines -> clean Parquet tables.

``clean_to_parquet`` reads the raw files once: the typed, valid lines are
written to a scratch table, from which the dashboard table (C14), the basket
table (C15, if wanted) and the name lookups of both come. It returns the
checks the cleaning run reports: row and code counts (C12) and the weekday
profile (C13), read back from the written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import clean as C
from tillroll.plans.lineage import Scratch
from tillroll.sources.files import BAD_LINE, read_raw, read_sales, split_bad_lines, write_sales


def clean_to_parquet(spark: SparkSession, raw_path: str, sales_path: str, basket_path: str | None = None,
                     fmt: str = "csv", partition_by: list[str] | None = None, formats: list[str] | None = None,
                     report_path: str | None = None, **read_options) -> tuple[DataFrame, DataFrame]:
    """Returns the summary (C12) and the weekday profile (C13). Lines that are
    no record are left out; with ``report_path`` they are written to
    ``bad_lines`` in that folder, and what was dropped by which rule to
    ``dropped_counts``."""
    raw = read_raw(spark, raw_path, fmt, bad_line=BAD_LINE, **read_options)
    with Scratch(spark) as scratch:
        if report_path:
            raw = scratch.table(raw, "raw_lines")
            C.dropped_counts(raw, formats, BAD_LINE).write.mode("overwrite").parquet(f"{report_path.rstrip('/')}/dropped_counts")
            split_bad_lines(raw)[1].write.mode("overwrite").parquet(f"{report_path.rstrip('/')}/bad_lines")
        valid = scratch.table(C.filter_valid(split_bad_lines(raw)[0], formats), "valid_lines")
        write_sales(C.sales_of_valid(valid), sales_path, partition_by=partition_by)
        if basket_path:
            write_sales(C.basket_lines_of_valid(valid), basket_path)
    clean = read_sales(spark, sales_path)
    return C.clean_summary(clean), C.weekday_profile(clean)

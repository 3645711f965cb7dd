"""Filters on the dashboard table.

Date bounds are timestamp literals compared with the column directly, so
the predicate reaches the Parquet scan (PushedFilters). A table that has the
calendar columns of C11 gets the same range on Year and Month beside it,
which prunes partitions when the table is laid out by them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d)[:10])


def _ts_literal(df: DataFrame, col: str, d: dt.date):
    typ = dict(df.dtypes)[col]
    kind = "TIMESTAMP_NTZ" if typ == "timestamp_ntz" else "TIMESTAMP"
    return F.expr(f"{kind} '{d.isoformat()} 00:00:00'")


def filter_sales(df: DataFrame, countries=None, start=None, end=None, col: str = "InvoiceDate") -> DataFrame:
    """Country in ``countries`` (empty or None = all) and, only when
    both ends are given, ``start <= ts < end + 1 day`` (the end day is
    included whole, fractions of its last second too)."""
    if isinstance(countries, str):
        raise TypeError("countries is a list of names; wrap a single name in a list")
    out = df
    if countries:
        out = out.filter(F.col("Country").isin(list(countries)))
    if start is not None and end is not None:
        lo, hi = _as_date(start), _as_date(end) + dt.timedelta(days=1)
        out = out.filter((F.col(col) >= _ts_literal(df, col, lo)) & (F.col(col) < _ts_literal(df, col, hi)))
        if col == "InvoiceDate" and {"Year", "Month"} <= set(df.columns):
            last, year, month = _as_date(end), F.col("Year"), F.col("Month")
            out = out.filter((year >= lo.year) & (year <= last.year)
                             & ((year > lo.year) | (month >= lo.month)) & ((year < last.year) | (month <= last.month)))
    return out


def list_countries(df: DataFrame) -> DataFrame:
    """sorted distinct countries."""
    return df.select("Country").distinct().orderBy("Country")


def date_bounds(df: DataFrame, col: str = "InvoiceDate") -> DataFrame:
    """first and last date (one row)."""
    return df.agg(F.to_date(F.min(col)).alias("min_date"), F.to_date(F.max(col)).alias("max_date"))


def filtered_count(df: DataFrame) -> DataFrame:
    """rows left after filtering (one row); 0 means the report stops."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))

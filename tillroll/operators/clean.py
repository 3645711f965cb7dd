"""Cleaning of raw invoice lines.

Raw columns are text; bad values become null through ``try_*`` functions
(ANSI mode stays on) and those rows are dropped. The product lookup is one
row per code, built by aggregation, checkpointed and counted, then joined
back: broadcast when it is small (the lines are never shuffled for it), a
shuffle join with AQE skew splitting when it is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import UNKNOWN_PRODUCT


# Text layouts accepted for InvoiceDate besides ISO
# ``yyyy-MM-dd[ HH:mm[:ss[.SSS]]]`` (month-first, as in the raw retail export).
DATE_FORMATS = ["M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yy H:mm"]
# Text that is a number: no NaN, no Infinity, no type suffix.
NUMBER = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)\s*$"


def _once(df: DataFrame, **columns) -> DataFrame:
    """``withColumns`` whose expressions are worked out once per row. A filter
    on a projected column is pushed below it, expression and all; parsing
    would then run two or three times per line and outgrow what is compiled.
    A one-row generator stops that."""
    rest = [c for c in df.columns if c not in columns]
    made = F.inline(F.array(F.struct(*[e.alias(c) for c, e in columns.items()])))
    return df.select(*rest, made).select(df.columns)


def _wall_clock(raw, fmt: str):
    """Text in a zone-free layout -> timestamp without time zone. The text is
    read at offset zero and counted from the epoch, so the session's zone and
    its daylight saving play no part."""
    at = F.try_to_timestamp(F.concat(raw, F.lit(" +0000")), F.lit(f"{fmt} xx"))
    seconds = (F.unix_micros(at).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)


def parse_dates(df: DataFrame, col: str = "InvoiceDate", formats: list[str] | None = None) -> DataFrame:
    """Text -> timestamp without time zone; unparsable -> null -> dropped.

    ISO text is cast directly (no zone involved); other layouts are tried in
    the order of ``formats`` and read as wall-clock time."""
    return _once(df, **{col: F.coalesce(*_date_tries(df, col, formats))}).filter(F.col(col).isNotNull())


def _date_tries(df: DataFrame, col: str, formats: list[str] | None) -> list:
    raw = F.col(col)
    if dict(df.dtypes)[col] != "string":
        return [raw]
    return [raw.try_cast("timestamp_ntz")] + [_wall_clock(raw, f) for f in (DATE_FORMATS if formats is None else formats)]


def _number(df: DataFrame, col: str):
    """A column as double, null for NaN and text that is no number."""
    c = F.col(col)
    if dict(df.dtypes)[col] != "string":
        return F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return F.regexp_extract(c, NUMBER, 1).try_cast("double")


def _finite(col: str):
    return F.col(col).isNotNull() & (F.abs(F.col(col)) < float("inf"))


def coerce_numeric(df: DataFrame) -> DataFrame:
    """Quantity and UnitPrice to doubles; whatever is no finite number
    (malformed, NaN, Infinity) -> null -> dropped. Fractions are kept."""
    numbers = _once(df, Quantity=_number(df, "Quantity"), UnitPrice=_number(df, "UnitPrice"))
    return numbers.filter(_finite("Quantity") & _finite("UnitPrice"))


def drop_returns(df: DataFrame) -> DataFrame:
    """Keep Quantity >= 0 and UnitPrice >= 0 (zero is kept)."""
    return df.filter((F.col("Quantity") >= 0) & (F.col("UnitPrice") >= 0))


def normalize_code(df: DataFrame, mode: str = "strip_all", col: str = "StockCode") -> DataFrame:
    """C4a (``strip_all``): upper-case, delete every whitespace character.
    C4b (``trim``): upper-case, trim spaces at both ends only."""
    c = F.col(col)
    if mode == "strip_all":
        out = F.upper(F.regexp_replace(c, r"\s+", ""))
    elif mode == "trim":
        out = F.trim(F.upper(c))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumn(col, out)


def description_counts(df: DataFrame) -> DataFrame:
    """Lines per (StockCode, Description), null and blank names left out."""
    named = df.filter(F.col("Description").isNotNull() & (F.col("Description") != ""))
    return named.groupBy("StockCode", "Description").agg(F.count(F.lit(1)).alias("n_lines"))


def modal_description(df: DataFrame) -> DataFrame:
    """Most frequent Description per StockCode; ties go to the
    alphabetically first name. Counts are aggregated first, so a hot code
    costs one row per distinct name, not one per line."""
    counts = description_counts(df)
    best = F.min_by("Description", F.struct(F.negative("n_lines"), F.col("Description")))
    return counts.groupBy("StockCode").agg(best.alias("Description"))


def standardize_description(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """C7 + C8: replace Description by the lookup's name (left join on the
    code); codes without one get ``Unknown Product``. The lookup is
    size-checked before the join (:func:`tillroll.plans.lookup.join_lookup`),
    so the lines are not shuffled when it is small."""
    from tillroll.plans.lookup import join_lookup

    lookup = modal_description(df) if lookup is None else lookup
    cols = df.columns
    joined = join_lookup(df.drop("Description"), lookup, "StockCode", "left")
    return joined.withColumn("Description", F.coalesce(F.col("Description"), F.lit(UNKNOWN_PRODUCT))).select(cols)


def missing_description(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """C8 check: rows left without a name after the join (one row)."""
    from tillroll.plans.lookup import join_lookup

    lookup = modal_description(df) if lookup is None else lookup
    joined = join_lookup(df.drop("Description"), lookup, "StockCode", "left")
    return joined.agg(F.count_if(F.col("Description").isNull()).alias("n_missing"))


def add_total_value(df: DataFrame) -> DataFrame:
    """TotalValue = Quantity * UnitPrice."""
    return df.withColumn("TotalValue", F.col("Quantity") * F.col("UnitPrice"))


def floor_ms(df: DataFrame, col: str = "InvoiceDate") -> DataFrame:
    """Floor the timestamp to the millisecond, keeping its type."""
    typ = dict(df.dtypes)[col]
    out = F.date_trunc("millisecond", F.col(col))
    return df.withColumn(col, out.cast(typ))


def add_calendar(df: DataFrame, col: str = "InvoiceDate") -> DataFrame:
    """C11: Year, Month, Day, Hour and DayOfWeek (Monday = 0)."""
    ts = F.col(col)
    return (df.withColumn("Year", F.year(ts)).withColumn("Month", F.month(ts))
              .withColumn("Day", F.dayofmonth(ts)).withColumn("Hour", F.hour(ts))
              .withColumn("DayOfWeek", F.weekday(ts)))


def clean_summary(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Rows and distinct codes after cleaning (+ lookup size if given)."""
    out = df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("StockCode").alias("n_codes"))
    if lookup is not None:
        out = out.withColumn("n_lookup", lookup.agg(F.count(F.lit(1))).scalar())
    return out


def weekday_profile(df: DataFrame) -> DataFrame:
    """Rows per DayOfWeek with names, and whether Saturday occurs (a
    scalar subquery over the same at-most-7-row aggregate)."""
    from tillroll.functions.columns import weekday_name

    per_day = df.groupBy("DayOfWeek").agg(F.count(F.lit(1)).alias("n_rows"))
    has_saturday = per_day.agg(F.bool_or(F.col("DayOfWeek") == 5)).scalar()
    return per_day.select("DayOfWeek", weekday_name("DayOfWeek").alias("Weekday"), "n_rows",
                          has_saturday.alias("has_saturday"))


def filter_valid(raw: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """C1-C3 in order: parse dates (ISO and ``formats``), coerce numbers,
    drop negatives."""
    return drop_returns(coerce_numeric(parse_dates(raw, formats=formats)))


def dropped_counts(raw: DataFrame, formats: list[str] | None = None, bad_line: str | None = None) -> DataFrame:
    """What :func:`filter_valid` drops, by rule (one row): rows in, without a
    date, then without numbers, then negative, and kept. One pass.

    With ``bad_line``, the column of lines that are no record (see
    :func:`tillroll.sources.files.read_raw`), those are counted first, as
    ``n_malformed``, and by no other rule."""
    whole = F.col(bad_line).isNull() if bad_line else F.lit(True)
    lines = raw.select(whole.alias("_whole"), "InvoiceDate", "Quantity", "UnitPrice")
    marked = _once(lines, InvoiceDate=F.coalesce(*_date_tries(raw, "InvoiceDate", formats)),
                   Quantity=_number(raw, "Quantity"), UnitPrice=_number(raw, "UnitPrice"))
    dated = F.col("_whole") & F.col("InvoiceDate").isNotNull()
    numbers = F.coalesce(_finite("Quantity"), F.lit(False)) & F.coalesce(_finite("UnitPrice"), F.lit(False))
    positive = (F.col("Quantity") >= 0) & (F.col("UnitPrice") >= 0)
    malformed = [F.count_if(~F.col("_whole")).alias("n_malformed")] if bad_line else []
    return marked.agg(F.count(F.lit(1)).alias("n_rows"), *malformed, F.count_if(F.col("_whole") & ~dated).alias("n_no_date"),
                      F.count_if(dated & ~numbers).alias("n_no_number"), F.count_if(dated & numbers & ~positive).alias("n_negative"),
                      F.count_if(dated & numbers & positive).alias("n_kept"))


def clean_sales(raw: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """C14: dashboard table from raw lines."""
    return sales_of_valid(filter_valid(raw, formats))


def sales_of_valid(valid: DataFrame) -> DataFrame:
    """C14 on typed lines (:func:`filter_valid`). Names are standardised on
    the raw code (codes are only normalised later, at load)."""
    df = standardize_description(valid)
    df = add_total_value(df)
    df = floor_ms(df)
    df = add_calendar(df)
    return df.select("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
                     "CustomerID", "Country", "TotalValue", "Year", "Month", "Day", "Hour", "DayOfWeek")


def clean_basket_lines(raw: DataFrame, formats: list[str] | None = None) -> DataFrame:
    """Basket table from raw lines."""
    return basket_lines_of_valid(filter_valid(raw, formats))


def basket_lines_of_valid(valid: DataFrame) -> DataFrame:
    """C15 on typed lines. Codes are normalised (strip-all) before the name
    lookup; no TotalValue and no calendar columns."""
    df = normalize_code(valid, "strip_all")
    df = standardize_description(df)
    df = floor_ms(df)
    return df.select("InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice",
                     "CustomerID", "Country")

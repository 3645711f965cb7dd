"""File sources and sinks."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Raw invoice lines arrive as text so that malformed values can be nulled
# by the cleaning steps instead of failing the read.
RAW_SCHEMA = T.StructType([
    T.StructField("InvoiceNo", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.StringType()),
    T.StructField("InvoiceDate", T.StringType()),
    T.StructField("UnitPrice", T.StringType()),
    T.StructField("CustomerID", T.StringType()),
    T.StructField("Country", T.StringType()),
])

# Flat text form of itemsets and rules (arrays as JSON text, see D9).
RULES_CSV_SCHEMA = T.StructType([
    T.StructField("antecedent", T.StringType()),
    T.StructField("consequent", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("lift", T.DoubleType()),
    T.StructField("support", T.DoubleType()),
    T.StructField("antecedent_with_desc", T.StringType()),
    T.StructField("consequent_with_desc", T.StringType()),
])
ITEMSETS_CSV_SCHEMA = T.StructType([
    T.StructField("items", T.StringType()),
    T.StructField("freq", T.LongType()),
    T.StructField("items_with_desc", T.StringType()),
])
FRIENDLY_CSV_SCHEMA = T.StructType([
    T.StructField("rule_id", T.LongType()),
    T.StructField("antecedent_codes", T.StringType()),
    T.StructField("antecedent_descriptions", T.StringType()),
    T.StructField("consequent_codes", T.StringType()),
    T.StructField("consequent_descriptions", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("lift", T.DoubleType()),
])


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """A1: scan a clean sales table written by :func:`write_sales`."""
    return spark.read.parquet(path)


# Column with the text of lines that are no record, see :func:`read_raw`.
BAD_LINE = "_bad_line"


def read_raw(spark: SparkSession, path: str, fmt: str = "csv", bad_line: str | None = None, **options) -> DataFrame:
    """A2: ingest raw invoice lines with every column as text.

    CSV and JSON are read with the declared string schema (no inference
    pass over the data); Parquet/ORC sources are read as stored and then
    cast to text so the same cleaning chain applies.

    Lines with too few or too many fields, with a quote that is never closed,
    or that are no JSON object, are padded or cut to the schema by the reader.
    Name a ``bad_line`` column (such as ``BAD_LINE``) to tell them apart: it
    holds their text and is null for records; :func:`split_bad_lines` divides
    the two.
    """
    if fmt in ("csv", "json"):
        schema = RAW_SCHEMA
        reader = spark.read
        if fmt == "csv":
            reader = reader.option("header", True)
        if bad_line:
            schema = T.StructType(RAW_SCHEMA.fields + [T.StructField(bad_line, T.StringType())])
            # Every field is parsed whatever a query reads: a line must not look whole because its end was skipped.
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad_line).option("columnPruning", False)
        for k, v in options.items():
            reader = reader.option(k, v)
        return reader.schema(schema).format(fmt).load(path)
    df = spark.read.format(fmt).load(path)
    df = df.select([F.col(f.name).cast("string").alias(f.name) for f in RAW_SCHEMA.fields])
    return df.withColumn(bad_line, F.lit(None).cast("string")) if bad_line else df


def split_bad_lines(raw: DataFrame, bad_line: str = BAD_LINE) -> tuple[DataFrame, DataFrame]:
    """(records, texts of bad lines) of a table read with ``bad_line``. Give a
    table that is written or persisted: Spark does not read the bad lines
    alone from CSV or JSON files."""
    return raw.filter(F.col(bad_line).isNull()).drop(bad_line), raw.filter(F.col(bad_line).isNotNull()).select(bad_line)


def own_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of its own on the same cluster, with the caller's settings
    and ``settings``; the caller's session stays as it is."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def _apart(df: DataFrame, settings: dict[str, str]) -> Iterator[DataFrame]:
    """``df`` in a session of its own."""
    session = own_session(df.sparkSession, settings)
    name = f"apart_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        yield session.table(f"global_temp.{name}")
    finally:
        df.sparkSession.catalog.dropGlobalTempView(name)


apart = contextmanager(_apart)
MILLIS = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS"}


def write_sales(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """A3: write a clean table as Snappy Parquet with millisecond timestamps.

    ``partition_by=["Year", "Month"]`` lays the table out for partition
    pruning by the date filter. Rows are first rebalanced on those columns
    (AQE ``rebalance``): each task then writes few folders, and a month
    holding a large share of the rows is split over several tasks instead
    of landing in one.

    The unit of timestamps is a session setting, so the write runs in a
    session of its own: writers of one session don't disturb each other.
    """
    # A timestamp without zone is always stored in microseconds; the table holds instants.
    df = df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})
    with apart(df, MILLIS) as own:
        if partition_by:
            own = own.hint("rebalance", *partition_by)
        writer = own.write.mode(mode).option("compression", "snappy")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)


def write_sales_bucketed(df: DataFrame, path: str, table: str, buckets: int, key: str = "InvoiceNo") -> None:
    """A3 with a layout: table ``table``, stored in ``path``, in ``buckets``
    buckets of ``key``, each sorted by it. What groups or counts by invoice
    (K4, B3, the invoices of K1) or joins on it then shuffles no line. Choose
    the buckets so that one fits a task, such as bytes / 256 MB; all lines of
    an invoice are in one bucket."""
    df = df.withColumns({c: F.col(c).cast("timestamp") for c, kind in df.dtypes if kind == "timestamp_ntz"})
    with apart(df, MILLIS) as own:
        # Dealt like the buckets, so that each is one file.
        (own.repartition(buckets, key).write.mode("overwrite").option("compression", "snappy").option("path", path)
            .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def read_sales_table(spark: SparkSession, table: str) -> DataFrame:
    """A1 for :func:`write_sales_bucketed`."""
    return spark.table(table)


def flatten_arrays(df: DataFrame) -> DataFrame:
    """Turn every array column into JSON text (CSV cannot hold arrays)."""
    return df.select([
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ])


def write_rules_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write itemsets, rules or a report as CSV with a header. Blanks
    at the ends of names are kept."""
    (flatten_arrays(df).write.mode(mode).option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("quote", '"').option("escape", '"').csv(path))


def parse_list_text(c) -> "F.Column":
    """List cell text -> array<string>. Accepts JSON (``["a","b"]``, what
    :func:`write_rules_csv` writes) and Python-list text (``['a', "it's"]``,
    either quote, backslash escapes). Text that is neither gives null."""
    c = F.col(c) if isinstance(c, str) else c
    either = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    return F.from_json(c, T.ArrayType(T.StringType()), either)


def read_rules_csv(spark: SparkSession, path: str, kind: str = "rules") -> DataFrame:
    """A5: read a rules (``kind="rules"``) or itemsets CSV back, arrays restored."""
    schema = RULES_CSV_SCHEMA if kind == "rules" else ITEMSETS_CSV_SCHEMA
    df = (spark.read.schema(schema).option("header", True).option("quote", '"')
          .option("escape", '"').csv(path))
    return df.select([
        parse_list_text(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in schema.fields
    ])


def read_friendly_rules(spark: SparkSession, path: str) -> DataFrame:
    """A5: read a readable rule report (B16 written by :func:`write_rules_csv`,
    or any CSV with its seven columns in that order, whatever they are called)
    back into rules: codes and names of both sides as arrays.

    Codes are parted at ``, ``, names at ``; ``. A name may itself hold
    ``; ``; if a side then has more parts than codes, its names can't be told
    apart and are null, the codes stay."""
    shown = (spark.read.schema(FRIENDLY_CSV_SCHEMA).option("header", True).option("enforceSchema", True)
             .option("quote", '"').option("escape", '"').csv(path))
    sides = {}
    for side in ("antecedent", "consequent"):
        codes = F.split(f"{side}_codes", ", ", -1)
        names = F.split(F.coalesce(f"{side}_descriptions", F.lit("")), "; ", -1)
        sides[side] = codes
        sides[f"{side}_names"] = F.when(F.size(names) == F.size(codes), names)
    return shown.select("rule_id", *[c.alias(name) for name, c in sides.items()], "confidence", "lift")


def friendly_text(rules: DataFrame) -> DataFrame:
    """The report's columns from what :func:`read_friendly_rules` returns."""
    return rules.select("rule_id", F.array_join("antecedent", ", ").alias("antecedent_codes"),
                        F.array_join("antecedent_names", "; ").alias("antecedent_descriptions"),
                        F.array_join("consequent", ", ").alias("consequent_codes"),
                        F.array_join("consequent_names", "; ").alias("consequent_descriptions"), "confidence", "lift")


def profile(df: DataFrame) -> DataFrame:
    """One row with the row count and the column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"))


# Parquet read so that counts, minima and maxima come from the files' footers.
# Groups by partition columns are only pushed down under case-sensitive names.
FOOTERS = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true",
           "spark.sql.caseSensitive": "true"}


def footer_months(spark: SparkSession, path: str) -> DataFrame:
    """``Year``, ``Month``, ``first_day``, ``last_day``, ``n_rows`` of a table
    written by ``write_sales(partition_by=["Year", "Month"])``, from folder
    names and file footers: no data page is read. One row per month."""
    table = own_session(spark, FOOTERS).read.parquet(path)
    return table.groupBy("Year", "Month").agg(F.min("Day").alias("first_day"), F.max("Day").alias("last_day"), F.count(F.lit(1)).alias("n_rows"))


def footer_bounds(spark: SparkSession, path: str) -> DataFrame:
    """F5 from footers: first and last date (one row)."""
    months = footer_months(spark, path).collect()
    days = [[datetime.date(r["Year"], r["Month"], r[c]) for r in months] for c in ("first_day", "last_day")]
    return spark.createDataFrame([(min(days[0], default=None), max(days[1], default=None))], "min_date date, max_date date")


def footer_profile(spark: SparkSession, path: str) -> DataFrame:
    """A7 from footers: row and column count of any Parquet table (one row)."""
    table = own_session(spark, FOOTERS).read.parquet(path)
    n_rows = table.agg(F.count(F.lit(1))).first()[0] or 0  # no row group at all gives null
    return spark.createDataFrame([(n_rows, len(table.columns))], "n_rows long, n_columns int")


def schema_table(df: DataFrame) -> DataFrame:
    """The schema as rows (position, column, type, nullable); metadata
    only, no job runs."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (a limit, reading only as many rows as needed)."""
    return df.limit(n)


def load_sales(spark: SparkSession, path: str, persist: bool = False) -> DataFrame:
    """A1 + C4b + A8: scan, normalise StockCode with trim(upper), optionally persist.

    Persist only when several queries follow on the same session and the
    filters are already applied; otherwise leave the plan lazy so filters and
    column pruning reach the Parquet scan.
    """
    from tillroll.operators.clean import normalize_code

    df = normalize_code(read_sales(spark, path), "trim")
    return df.persist() if persist else df

"""Helpers that several training-data operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.plans.lineage import Scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Rows numbered by one task of :func:`positions_within`.
ROWS_PER_BUCKET = 10_000
# Rows of an Arrow batch of texts.
BATCH_ROWS = 1_000


def finished(result: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``result`` written to a table of its own, and the intermediate tables
    of ``scratch`` deleted: nothing large outlives the operator."""
    table = Scratch(result.sparkSession).table(result, name)
    scratch.close()
    return table


def quoted(*names: str) -> list[str]:
    """Column names as they stand, dots and quotes included."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def own_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that ``df`` has none of, whatever the case."""
    taken, names = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def bound_batches(spark) -> None:
    """Texts go to Python in Arrow batches of 10,000 rows or 64 MB, whichever
    comes first; as Python strings and arrays that is several times as much. A
    session without a number of rows of its own gets ``BATCH_ROWS``, which
    keeps batches of usual texts small; the bytes still bound long ones."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, str(BATCH_ROWS))


def ascii_lower(c) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(F.col(c) if isinstance(c, str) else c, UPPER, UPPER.lower())


def content_tag(c="text") -> Column:
    """64-bit hash of a text. ``(doc_id, tag)`` names a document by what it
    holds, so it is the same in every job and after a lost executor; rows
    that repeat both are the same document as far as any decision goes."""
    return F.xxhash64(c)


def positions_within(df: DataFrame, keys: list[str], order: list[str], out: str, rows: int,
                     rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``out``: the 0-based gapless position of each row inside its key.

    A key may hold any share of the rows: rows are numbered inside
    ``(key, hash bucket of order)`` and shifted by the bucket's offset, which
    comes from one count per (key, bucket). ``order`` must tell rows apart.
    ``rows`` (the table's row count) only sets the number of buckets.
    """
    buckets = max(1, -(-rows // rows_per_bucket))
    salted = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (salted.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
               .select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.col("_bucket").alias("_o_bucket"),
                       F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    same = F.col("_bucket") == F.col("_o_bucket")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    return (salted.withColumn("_row", F.row_number().over(inside) - 1)
            .join(offsets, same)
            .withColumn(out, (F.col("_row") + F.col("_offset")).cast("long"))
            .drop("_row", "_offset", "_bucket", "_o_bucket", *[f"_o_{k}" for k in keys]))


# Labelled rows operator 2 fits its model of good text on, at most.
MAX_TARGET = 100_000


def good_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of all documents labelled good and not toxic, each once."""
    good = labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    return good.select("doc_id").distinct()


def target_ids(labels: DataFrame, most: int = MAX_TARGET) -> DataFrame:
    """:func:`good_ids`: all of them, or the ``most`` with the smallest hash.
    Bounded, so it may be broadcast."""
    ids = good_ids(labels).withColumn("_hash", F.xxhash64(F.lit("target"), "doc_id"))
    # Most rows that can't be among the first go before they are put in order.
    share = min(1.0, 1.05 * most / max(ids.count(), 1))
    some = ids.filter(F.pmod("_hash", F.lit(1 << 30)) / float(1 << 30) <= share)
    return F.broadcast(some.orderBy(F.pmod("_hash", F.lit(1 << 30)), "doc_id").limit(most).select("doc_id"))


def flag_target(docs: DataFrame, labels: DataFrame, most: int = MAX_TARGET) -> DataFrame:
    """``doc_id``, ``text`` and ``target`` (labelled as good)."""
    ids = target_ids(labels, most).select(F.col("doc_id").alias("_good"))
    return (docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_good"), "left")
            .select("doc_id", "text", F.col("_good").isNotNull().alias("target")))

"""Line dedup with range-partitioned hashes and keep bitmaps (operator 7).

A line's key is the line without ASCII white space at both ends, A-Z in lower
case. Keys of at least ``min_chars`` code points found in at least
``min_docs`` documents lose all their lines but those of the largest doc_id.

Every long line becomes two 64-bit hashes of its key with its place. These
rows are range-partitioned by hash, document (largest first) and position, so
a key or a document held by a third of all lines spreads over partitions that
follow one another in that order. Inside a partition the lines of a key are
streamed in it: the first one's document is the keeper, and a running count
numbers the documents. Only a key that goes on over a border needs more than
its own partition: there are at most as many such keys as partitions, and what
their partitions found (documents, first and last one) is carried over the
borders by a table of that size. What is returned is a keep bitmap per
document, compressed as runs of kept lines; texts are only read to make the
hashes and, if wanted, to apply the bitmaps.

Defined cases: a null or empty text is one empty line; a null doc_id is below
every other and not counted as a document; rows that repeat doc_id and text
are one document; rows that share a doc_id only are one holder of a key, each
with a bitmap of its own; other columns are kept by :func:`apply_bitmaps` and
ignored elsewhere; an empty table gives no rows. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.shared import ascii_lower, content_tag, finished, own_names
from tillroll.plans.lineage import Scratch

MIN_CHARS, MIN_DOCS = 40, 5
# Fixed value: the white space stripped from both ends of a line.
SPACE = " \t\n\x0b\x0c\r"


def _lines(c="text") -> Column:
    return F.split(F.coalesce(F.col(c), F.lit("")), "\n", -1)


def _lost_lines(lines: DataFrame, min_docs: int, scratch: Scratch) -> DataFrame:
    """``doc_id``, ``tag``, ``pos`` of the lines that go, from the hashes of
    long lines (``h1``, ``h2``) and their places; repeated rows once."""
    order = ["h1", "h2", F.desc_nulls_last("doc_id"), "tag", "pos"]
    dealt = (lines.repartitionByRange(*order).dropDuplicates(["h1", "h2", "doc_id", "tag", "pos"])
             .withColumn("part", F.spark_partition_id()))
    dealt = scratch.table(dealt, "dealt-lines", compression="zstd")

    inside = Window.partitionBy("part", "h1", "h2")
    streamed = inside.orderBy(F.desc_nulls_last("doc_id"), "tag", "pos")
    # Documents are numbered, not lines: the order by document alone is part of the streamed one.
    nth = F.dense_rank().over(inside.orderBy(F.desc_nulls_last("doc_id")))
    numbered = dealt.withColumn("first", F.first("doc_id").over(streamed)).withColumn("nth", F.when(F.col("doc_id").isNotNull(), nth))
    found = numbered.withColumn("holders", F.max("nth").over(inside)).drop("nth")

    # Keys that go on over a border are the last of one partition and the first of a later one.
    key = F.struct("h1", "h2")
    edges = dealt.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    over = (edges.select("part", F.explode(F.array("low", "high")).alias("key")).distinct()
            .groupBy("key").agg(F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("key.h1", "key.h2"))
    over = scratch.table(over, "keys-over-borders")
    here = (dealt.join(F.broadcast(over), ["h1", "h2"], "left_semi").groupBy("h1", "h2", "part")
            .agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("top"), F.min("doc_id").alias("last")))
    # A document that goes on over the border counts once.
    before = F.lag("last").over(Window.partitionBy("h1", "h2").orderBy("part"))
    each = here.withColumn("n", F.col("n") - F.coalesce((F.col("top") == before).cast("int"), F.lit(0)))
    carried = scratch.table(each.groupBy("h1", "h2").agg(F.sum("n").alias("all_holders"), F.max("top").alias("keeper")), "carried-keys")

    both = found.join(F.broadcast(carried), ["h1", "h2"], "left")
    keeper = F.when(F.col("all_holders").isNull(), F.col("first")).otherwise(F.col("keeper"))
    enough = F.coalesce("all_holders", "holders", F.lit(0)) >= min_docs
    return both.filter(enough & ~F.col("doc_id").eqNullSafe(keeper)).select("doc_id", "tag", "pos")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per different (``doc_id``, ``tag``), see
    :func:`shared.content_tag`: ``n_lines``, ``n_dropped`` and ``keep_runs``,
    an array of (start, length) of the lines that stay, in order."""
    scratch = Scratch(docs.sparkSession)
    lines = docs.select("doc_id", content_tag().alias("tag"), _lines().alias("lines"))
    keyed = (lines.select("doc_id", "tag", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
             .withColumn("line", F.btrim("line", F.lit(SPACE)))
             .withColumn("long", F.char_length("line") >= min_chars)
             .filter(F.col("long") | (F.col("pos") == 0)))
    key = ascii_lower("line")
    hashed = scratch.table(keyed.select(
        "doc_id", "tag", "pos", "n_lines", "long",
        F.when(F.col("long"), F.xxhash64(key)).alias("h1"), F.when(F.col("long"), F.xxhash64(F.lit(1), key)).alias("h2")), "line-hashes")

    lost = _lost_lines(hashed.filter("long").select("h1", "h2", "doc_id", "tag", "pos"), min_docs, scratch)

    # Positions to runs: neighbours have the same distance to their rank.
    own = Window.partitionBy("doc_id", "tag").orderBy("pos")
    runs = (lost.withColumn("island", F.col("pos") - F.row_number().over(own))
            .groupBy("doc_id", "tag", "island").agg(F.min("pos").alias("start"), F.count(F.lit(1)).cast("int").alias("length"))
            .groupBy("doc_id", "tag").agg(F.sum("length").alias("n_dropped"),
                                          F.sort_array(F.collect_list(F.struct("start", "length"))).alias("drops")))
    every = (hashed.filter("pos = 0").groupBy("doc_id", "tag").agg(F.max("n_lines").alias("n_lines"))
             .select("doc_id", "tag", "n_lines"))
    dropped = runs.select(F.col("doc_id").alias("_d"), F.col("tag").alias("_t"), "n_dropped", "drops")
    both = every.join(dropped, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tag") == F.col("_t")), "left")
    n = F.size("drops")
    gaps = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct(
        F.when(i == 0, 0).otherwise(F.get("drops", i - 1)["start"] + F.get("drops", i - 1)["length"]).alias("start"),
        F.when(i == n, F.col("n_lines")).otherwise(F.get("drops", i)["start"]).alias("end")))
    kept = F.transform(F.filter(gaps, lambda g: g["end"] > g["start"]),
                       lambda g: F.struct(g["start"].alias("start"), (g["end"] - g["start"]).alias("length")))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_lines").alias("length")))
    bitmaps = both.select("doc_id", "tag", "n_lines", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                          F.when(F.col("drops").isNull(), whole).otherwise(kept).alias("keep_runs"))
    return finished(bitmaps, scratch, "keep-bitmaps")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, info: str = "_lines") -> DataFrame:
    """``docs`` with ``text`` = its kept lines joined by line feeds (a text
    that loses nothing stays as it is, null included) and a struct column
    ``info`` (``n_lines``, ``n_dropped``), a name that ``docs`` does not have.
    Other columns stay, whatever their names."""
    doc, tag, keep, all_lines = own_names(docs, "b_doc", "b_tag", "b_runs", "b_all")
    runs = bitmaps.select(F.col("doc_id").alias(doc), F.col("tag").alias(tag), F.col("keep_runs").alias(keep),
                          F.struct(F.col("n_lines").cast("long").alias("n_lines"), "n_dropped").alias(info))
    joined = docs.join(runs, F.col("doc_id").eqNullSafe(F.col(doc)) & (content_tag() == F.col(tag)), "left")
    lost = F.col(f"{info}.n_dropped") > 0
    parts = F.transform(keep, lambda r: F.slice(F.col(all_lines), r["start"] + 1, r["length"]))
    return (joined.withColumn(all_lines, F.when(lost, _lines()))
            .withColumn("text", F.when(lost, F.array_join(F.flatten(parts), "\n")).otherwise(F.col("text")))
            .drop(doc, tag, keep, all_lines))


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = apply_bitmaps(docs, keep_bitmaps(docs))
    return kept.select("doc_id", "_lines.n_lines", "_lines.n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP7_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (keeper IS NOT NULL AND doc_id <> keeper)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (keeper IS NULL OR doc_id = keeper), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id
"""

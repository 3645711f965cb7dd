"""Benchmark decontamination with a positional inverted index (operator 6).

``build_index`` stores one posting per training token: (term, document,
position), written in term order inside each part file. A benchmark item
gives its windows of ``WINDOW`` consecutive words (a shorter item is one
window). ``phrase_matches`` ranks the terms of each window by how often the
corpus holds them and intersects offset-adjusted postings from the rarest
on: the rarest term's postings give candidate starts, the second rarest's
must agree, and the few candidates left are checked against the postings of
all remaining terms. ``proximity_matches`` asks only that a window's rarest terms
stand near each other, in any order, so it also finds passages with words
changed, left out or moved.

Only postings of wanted terms are shuffled. The set of wanted terms is
broadcast up to ``BROADCAST_TERMS`` terms and joined by shuffle above that;
the document filter of the last step is a set of at most ``DOC_BUCKETS`` hash
values, however many documents there are. Words are compared by a 64-bit hash.

Defined cases: a null text has no words, a text without words has no windows;
rows that repeat doc_id and text are one document in the index and each get
its result; a null doc_id is an id like any other; a null item_id counts for
hits but is not listed; other columns are ignored; with an empty table on
either side nothing matches. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.shared import ascii_lower, finished, own_names
from tillroll.plans.lineage import Scratch

WINDOW = 10
# Proximity: so many of a window's rarest terms within so many words.
RAREST, WITHIN = 3, 20
BROADCAST_TERMS = 2_000_000
DOC_BUCKETS = 1 << 20
# Fixed value: what separates words once A-Z are lower-case.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DOC = ["d1", "d2"]


def words(c="text") -> Column:
    """Words in order; a separator at either end leaves an empty string there."""
    return F.split(ascii_lower(F.coalesce(F.col(c), F.lit(""))), NOT_WORD, -1)


def doc_key() -> list[Column]:
    """A document by its id and text, in 128 bits."""
    return [F.xxhash64("doc_id", "text").alias("d1"), F.xxhash64(F.lit(7), "text", "doc_id").alias("d2")]


def build_index(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Postings ``term``, ``d1``, ``d2``, ``pos`` of every word, written."""
    # Two steps: an expression beside the explode would be worked out again for every word.
    split = docs.select(*doc_key(), words().alias("words"))
    tokens = split.select(*DOC, F.posexplode("words").alias("pos", "word")).filter("word <> ''")
    return scratch.table(tokens.select(F.xxhash64("word").alias("term"), "d1", "d2", "pos")
                         .sortWithinPartitions("term"), "postings", compression="zstd")


def item_windows(items: DataFrame, scratch: Scratch, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(windows: ``wid``, ``terms``), one row per different window, and
    (``wid``, ``item_id``) pairs, both written."""
    terms = F.transform(F.filter(words(), lambda w: w != ""), lambda w: F.xxhash64(w))
    item = items.select("item_id", terms.alias("all")).withColumn("n", F.size("all")).filter("n > 0")
    each = (item.withColumn("start", F.explode(F.sequence(F.lit(1), F.greatest(F.col("n") - window + 1, F.lit(1)))))
            .select("item_id", F.slice("all", F.col("start"), F.lit(window)).alias("terms")).distinct())
    windows = scratch.table(each.select("terms").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    return windows, scratch.table(each.join(windows, "terms").select("wid", "item_id"), "window-items")


def _of_terms(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings of some terms, each once."""
    wanted = terms.select("term").distinct()
    if wanted.count() <= BROADCAST_TERMS:
        wanted = F.broadcast(wanted)
    return postings.join(wanted, "term", "left_semi")


def ranked_terms(postings: DataFrame, windows: DataFrame, scratch: Scratch, whole: bool = True) -> DataFrame:
    """``wid``, ``size``, ``off``, ``term``, ``rank`` (1 = rarest in the
    corpus) for windows whose every term occurs, or, unless ``whole``, of the
    terms that do occur; written."""
    each = windows.select("wid", F.size("terms").alias("size"), F.posexplode("terms").alias("off", "term"))
    counts = _of_terms(postings, each).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("wid")
    known = each.join(counts, "term")
    if whole:
        known = known.withColumn("found", F.count(F.lit(1)).over(own)).filter("found = size")
    rarest = F.row_number().over(own.orderBy("n", "off"))
    return scratch.table(known.select("wid", "size", "off", "term", rarest.alias("rank")), "ranked-terms")


def phrase_matches(postings: DataFrame, windows: DataFrame, scratch: Scratch) -> DataFrame:
    """``d1``, ``d2``, ``wid``, ``start``, ``size``: every place where a
    window stands word for word; written."""
    ranked = ranked_terms(postings, windows, scratch)
    first = ranked.filter("rank = 1").drop("rank")
    starts = (_of_terms(postings, first).distinct().join(first, "term")
              .select(*DOC, "wid", "size", (F.col("pos") - F.col("off")).alias("start")))

    second = ranked.filter("rank = 2").select("wid", "off", "term")
    asked = starts.join(second, "wid").withColumn("pos", F.col("start") + F.col("off"))
    agreed = (asked.join(_of_terms(postings, second).distinct(), [*DOC, "term", "pos"])
              .select(*DOC, "wid", "size", "start"))
    agreed = scratch.table(agreed.unionByName(starts.filter("size = 1")), "agreed-starts")

    rest = ranked.filter("rank > 2").select("wid", "off", "term")
    bucket = F.pmod("d1", F.lit(DOC_BUCKETS)).cast("int").alias("bucket")
    near = F.broadcast(agreed.select(bucket).distinct())
    held = _of_terms(postings, rest).select("*", bucket).join(near, "bucket", "left_semi").drop("bucket").distinct()
    asked = agreed.filter("size > 2").join(rest, "wid").withColumn("pos", F.col("start") + F.col("off"))
    full = (asked.join(held, [*DOC, "term", "pos"]).groupBy(*DOC, "wid", "size", "start")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == F.col("size") - 2).drop("n"))
    return scratch.table(full.unionByName(agreed.filter("size <= 2").select(full.columns)), "phrase-matches")


def near_terms(postings: DataFrame, windows: DataFrame, scratch: Scratch, rarest: int = RAREST) -> DataFrame:
    """``wid``, ``rank`` (1 = rarest), ``term``, ``need``: the ``rarest``
    rarest different terms of each window, of those that the corpus holds,
    and how many these are."""
    ranked = ranked_terms(postings, windows, scratch, whole=False).groupBy("wid", "term").agg(F.min("rank").alias("rank"))
    own = Window.partitionBy("wid").orderBy("rank")
    return (ranked.withColumn("rank", F.row_number().over(own)).filter(F.col("rank") <= rarest)
            .withColumn("need", F.count(F.lit(1)).over(Window.partitionBy("wid"))))


def proximity_matches(postings: DataFrame, windows: DataFrame, scratch: Scratch, within: int = WITHIN, rarest: int = RAREST) -> DataFrame:
    """``d1``, ``d2``, ``wid``, ``first``, ``last``: spans of at most
    ``within`` consecutive words with a place of each of the ``rarest`` rarest
    different terms of a window (all, if fewer), of those that the corpus
    holds, in any order. One row per first word, with the farthest last one;
    written.

    It begins with the places of each window's rarest term and takes the
    others in one by one. A place of the next term is looked for in the blocks
    of ``within`` positions around a span, so a span meets no more places than
    stand near it, however common the term; of the spans of a round only
    the different ones go on."""
    wanted = scratch.table(near_terms(postings, windows, scratch, rarest), "near-terms")
    starts = wanted.filter("rank = 1").select("wid", "need", "term")
    spans = (_of_terms(postings, starts).distinct().join(starts, "term")
             .select(*DOC, "wid", "need", F.col("pos").alias("first"), F.col("pos").alias("last")))
    whole = [spans.filter("need = 1")]
    block = lambda pos: F.floor(pos / within).cast("int")
    for rank in range(2, rarest + 1):
        spans = scratch.table(spans.filter(F.col("need") >= rank), "spans")
        bucket = F.pmod("d1", F.lit(DOC_BUCKETS)).cast("int").alias("bucket")
        term = wanted.filter(F.col("rank") == rank).select("wid", "term")
        near = F.broadcast(spans.select(bucket).distinct())
        held = (_of_terms(postings, term).select("*", bucket).join(near, "bucket", "left_semi").drop("bucket").distinct()
                .withColumn("block", block(F.col("pos"))))
        around = F.sequence(block(F.greatest(F.col("last") - within + 1, F.lit(0))), block(F.col("first") + within - 1))
        asked = spans.join(term, "wid").withColumn("block", F.explode(around))
        met = asked.join(held, [*DOC, "term", "block"])
        first, last = F.least("first", "pos"), F.greatest("last", "pos")
        spans = met.filter(last - first < within).select(*DOC, "wid", "need", first.alias("first"), last.alias("last")).distinct()
        whole.append(spans.filter(F.col("need") == rank))
    every = whole[0]
    for more in whole[1:]:
        every = every.unionByName(more)
    return scratch.table(every.groupBy(*DOC, "wid", "first").agg(F.max("last").alias("last")), "proximity-matches")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, proximity: bool = False) -> DataFrame:
    """One row per different document: ``d1``, ``d2``, ``n_words``, ``n_hit``
    (words inside a match) and ``items`` (sorted item ids as text), with
    ``proximity`` also ``near_items``, those with a window whose rarest terms
    stand near each other. Documents without words have no row."""
    scratch = Scratch(docs.sparkSession)
    postings = build_index(docs.select("doc_id", "text"), scratch)
    windows, window_items = item_windows(items, scratch, window)
    matches = phrase_matches(postings, windows, scratch)
    counted = postings.groupBy(*DOC).agg((F.max("pos") - F.min("pos") + 1).cast("long").alias("n_words"))

    # Words under overlapping matches count once: what each adds beyond those before it.
    before = Window.partitionBy(*DOC).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = matches.select(*DOC, "start", (F.col("start") + F.col("size")).alias("end")).distinct()
    adds = F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.col("start")))
    hit = spans.withColumn("adds", F.greatest(adds, F.lit(0))).groupBy(*DOC).agg(F.sum("adds").alias("n_hit"))

    def items_of(places: DataFrame, name: str) -> DataFrame:
        return (places.select(*DOC, "wid").distinct().join(window_items, "wid")
                .groupBy(*DOC).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias(name)))

    found = counted.join(hit, DOC, "left").join(items_of(matches, "items"), DOC, "left")
    lists = ["items"]
    if proximity:
        found = found.join(items_of(proximity_matches(postings, windows, scratch), "near_items"), DOC, "left")
        lists.append("near_items")
    none = F.array().cast("array<string>")
    found = found.select(*DOC, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), *[F.coalesce(c, none).alias(c) for c in lists])
    return finished(found, scratch, "contamination")


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    first, second = doc_key()
    one, two = own_names(docs, "c1", "c2")
    hit = contamination(docs, items, window).filter("n_hit > 0").select(F.col("d1").alias(one), F.col("d2").alias(two))
    return docs.join(hit, (first == F.col(one)) & (second == F.col(two)), "left_anti")


def op6_positional_index(spark, sf_dir: str) -> DataFrame:
    """The exact matches, and ``n_near_items``, ``near_items_sha256``: the
    items with a proximity match."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), proximity=True)
    items, near = (F.coalesce(c, F.array().cast("array<string>")) for c in ("items", "near_items"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (docs.select("doc_id", *doc_key()).join(found, DOC, "left")
            .select("doc_id", F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"), n_hit.alias("n_hit"),
                    F.size(items).cast("long").alias("n_items"),
                    F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
                    F.size(near).cast("long").alias("n_near_items"), F.sha2(F.array_join(near, ","), 256).alias("near_items_sha256")))


OP6_SQL = r"""
WITH dw AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
starts AS (
  SELECT item_id, ws, least(len(ws), 10) AS size, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM iw WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(ws[s : s + size - 1], ' ') AS w FROM starts),
sizes AS (SELECT DISTINCT size FROM win),
places AS (
  SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS s FROM dw, sizes WHERE len(ws) >= size),
grams AS (SELECT doc_id, size, s, array_to_string(ws[s : s + size - 1], ' ') AS w FROM places),
hit AS (SELECT doc_id, s, size, item_id FROM grams JOIN win USING (size, w)),
pos AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM hit) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id),
windows AS (SELECT row_number() OVER () AS wid, w, list(DISTINCT item_id::VARCHAR) AS items FROM win GROUP BY w),
terms AS (SELECT wid, unnest(string_split(w, ' ')) AS term, unnest(range(len(string_split(w, ' ')))) AS off FROM windows),
post AS (SELECT doc_id, unnest(ws) AS term, unnest(range(len(ws))) AS pos FROM dw),
places_of AS (SELECT * FROM post SEMI JOIN terms USING (term)),
freq AS (SELECT term, count(*) AS n FROM places_of GROUP BY term),
rarest AS (
  SELECT wid, term, row_number() OVER (PARTITION BY wid ORDER BY n, off) AS rank
  FROM (SELECT wid, term, any_value(n) AS n, min(off) AS off FROM terms JOIN freq USING (term) GROUP BY wid, term) QUALIFY rank <= 3),
asked AS (
  SELECT wid, count(*) AS need, max(term) FILTER (rank = 1) AS t1, max(term) FILTER (rank = 2) AS t2, max(term) FILTER (rank = 3) AS t3
  FROM rarest GROUP BY wid),
s1 AS (SELECT wid, need, t2, t3, doc_id, pos AS a, pos AS b FROM asked JOIN places_of ON term = t1),
s2 AS (
  SELECT DISTINCT wid, need, t3, s.doc_id, least(a, pos) AS a, greatest(b, pos) AS b
  FROM s1 s JOIN places_of p ON p.term = s.t2 AND p.doc_id = s.doc_id AND greatest(b, pos) - least(a, pos) < 20),
s3 AS (
  SELECT DISTINCT wid, s.doc_id FROM s2 s JOIN places_of p ON p.term = s.t3 AND p.doc_id = s.doc_id AND greatest(b, pos) - least(a, pos) < 20),
near AS (
  SELECT wid, doc_id FROM s1 WHERE need = 1 UNION SELECT wid, doc_id FROM s2 WHERE need = 2 UNION SELECT wid, doc_id FROM s3),
near_named AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, unnest(items) AS item FROM near JOIN windows USING (wid)) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(named.items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  coalesce(near_named.n, 0)::BIGINT AS n_near_items, sha256(coalesce(near_named.items, '')) AS near_items_sha256
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN named USING (doc_id) LEFT JOIN near_named USING (doc_id)
"""

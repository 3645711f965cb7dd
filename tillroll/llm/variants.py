"""Spelling variant grouping by dense prefix-suffix tiling (operator 13).

Words are the runs of letters of all texts, some with one letter left out by
rule; those of enough letters and occurrences are kept. Two words are near if
they differ by exactly one inserted, deleted or replaced code point. Common
prefix and common suffix together are then at least as long as the longer
word less one, and only then.

One edit leaves the first half of a word as it is or the second. So a word is
sent, for each length ``c`` that the shorter word of a pair may have, to the
group of its first ``c // 2`` code points and to that of its last
``c - c // 2``. A group's words become padded matrices of code points, aligned
left and right; tiles of ``TILE`` rows are compared in blocks, column by column, which
gives the common prefixes and suffixes of all pairs of a tile at once. Small
groups share tiles. A pair that meets in both groups counts in the first.

A group above a bound of rows is dealt into blocks, and every pair of blocks
is a task's work of its own: no task holds more than two blocks, and no pair
is left out. That is quadratic in such a group, as its comparison is.

A word's form is its near word of largest count, if that is at least ``RATIO``
times its own. Forms are followed to the last by pointer doubling; counts grow
along the way, so it ends after a few steps.

Defined cases: a null or empty text has no words; repeated rows count each; a
null doc_id reads as nothing before the colon; ties of counts go to the word
smallest in code-point order; other columns are ignored; an empty table gives
no rows. A text or a word is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.shared import ascii_lower, finished
from tillroll.plans.lineage import Scratch

MIN_CHARS, MIN_COUNT, RATIO = 7, 2, 10
# Every so many checksums a letter is left out.
LEAVES_OUT = 31
# Fixed value: the letters of a run.
LETTERS = r"A-Za-zÀ-ÿ"
TILE = 32
# Code points of one block of a group, and its least rows.
BLOCK_CELLS, BLOCK_ROWS = 1 << 16, 16
# Pairs of rows compared at once, and rows or bytes gathered before.
PAIRS, ROWS, BYTES = 1 << 20, 1 << 15, 1 << 24
PREFIX, SUFFIX = 0, 1
KEY = ["shorter", "side", "part", "i", "j"]


def word_counts(docs: DataFrame, scratch: Scratch, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word``, ``n``, written."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                       F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(f"([{LETTERS}]{{{min_chars},}})")).alias("runs"))
    each = runs.select("doc", F.explode("runs").alias("run"))
    marked = each.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = marked.select(F.when(F.pmod("h", F.lit(LEAVES_OUT)) == 0, less).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.char_length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return scratch.table(counts.filter(F.col("n") >= min_count), "words", compression="zstd")


def grouped(words: DataFrame, scratch: Scratch, min_chars: int, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """``words`` once per group and pair of blocks: ``KEY``, ``block``,
    ``word``, ``n``."""
    size = F.char_length("word")
    sent = words.select("word", "n", F.explode(F.array(size - 1, size)).alias("shorter")).filter(F.col("shorter") >= min_chars)
    half = F.floor(F.col("shorter") / 2).cast("int")
    parts = F.array(F.substring("word", F.lit(1), half), F.substring("word", -(F.col("shorter") - half), F.col("shorter") - half))
    keyed = sent.select("word", "n", "shorter", F.posexplode(parts).alias("side", "part"))
    rows = F.greatest(F.floor(F.lit(block_cells) / F.col("shorter")), F.lit(BLOCK_ROWS))
    key = KEY[:3]
    hot = scratch.table(keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > rows)
                        .select(*key, F.ceil(F.col("rows") / rows).cast("int").alias("blocks")), "large-groups")
    dealt = (keyed.join(hot, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
             .withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select(*key, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "word", "n")


def padded(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points aligned left, aligned right, and lengths."""
    sizes = np.fromiter(map(len, words), "i8", len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    columns = np.arange(width)
    left, right = np.zeros((2, len(words), width), "u4")
    left[columns < sizes[:, None]] = flat
    right[columns >= width - sizes[:, None]] = flat
    return left, right, sizes


def common(first: np.ndarray, second: np.ndarray, columns) -> np.ndarray:
    """Equal columns from the first of ``columns`` on, for all pairs of rows
    of each pair of tiles."""
    same = np.ones((len(first), first.shape[1], second.shape[1]), bool)
    length = np.zeros(same.shape, "i4")
    for c in columns:
        same &= first[:, :, None, c] == second[:, None, :, c]
        if not same.any():
            break
        length += same
    return length


def near_in_tiles(words: list[str], group: np.ndarray, alone: np.ndarray, block: np.ndarray, suffix: np.ndarray, shorter: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the near pairs among words sorted by ``group``.
    ``alone``: the group is one block, whose rows meet each other."""
    n = len(words)
    left, right, sizes = padded(words, shorter + 1)
    tiles = -(-n // TILE)
    rows = np.minimum(np.arange(tiles * TILE), n - 1).reshape(tiles, TILE)
    ends = np.minimum(np.arange(1, tiles + 1) * TILE, n) - 1
    # A tile meets itself and those after it that its last group goes on in.
    reach = (np.searchsorted(group, group[ends], side="right") - 1) // TILE - np.arange(tiles)
    one = np.repeat(np.arange(tiles), reach + 1)
    two = one + np.arange(len(one)) - np.repeat(np.cumsum(reach + 1) - reach - 1, reach + 1)
    found = []
    step = max(1, PAIRS // TILE ** 2)
    for a in range(0, len(one), step):
        x, y = rows[one[a:a + step]], rows[two[a:a + step]]
        prefix = common(left[x], left[y], range(shorter + 1))
        tail = common(right[x], right[y], range(shorter, -1, -1))
        p, q = x[:, :, None], y[:, None, :]
        longer = np.maximum(sizes[p], sizes[q])
        near = (prefix + tail >= longer - 1) & (group[p] == group[q]) & (p < q)
        near &= (sizes[p] == shorter) | (sizes[q] == shorter)
        near &= alone[p] | (block[p] != block[q])
        near &= ~suffix[p] | (prefix < shorter // 2)
        # Rows that fill up the last tile repeat its last row.
        near &= (one[a:a + step, None] * TILE + np.arange(TILE) < n)[:, :, None] & (two[a:a + step, None] * TILE + np.arange(TILE) < n)[:, None, :]
        t, r, c = np.nonzero(near)
        found.append((x[t, r], y[t, c]))
    return tuple(np.concatenate(f) for f in zip(*found))


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by ``KEY``; groups are compared once whole."""
    held: pa.Table | None = None

    def changes(table: pa.Table) -> np.ndarray:
        new = np.zeros(len(table), bool)
        new[:1] = True
        for name in KEY:
            column = table.column(name).combine_chunks()
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        return new

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        group = np.cumsum(changes(table))
        some = np.flatnonzero(np.bincount(group)[group] > 1)
        table, group = table.take(pa.array(some)), group[some]
        length = table.column("shorter").to_numpy()
        for a, z in zip(*(lambda b: (b, [*b[1:], len(length)]))(np.flatnonzero(np.diff(length, prepend=-1)).tolist())):
            part = table.slice(a, z - a)
            words, n = part.column("word").to_pylist(), part.column("n").combine_chunks()
            i, j, block, side = (part.column(name).to_numpy() for name in ("i", "j", "block", "side"))
            p, q = near_in_tiles(words, group[a:z], i == j, block, side == SUFFIX, int(length[a]))
            word = part.column("word").combine_chunks()
            if len(p):
                yield pa.RecordBatch.from_arrays([word.take(pa.array(p)), n.take(pa.array(p)), word.take(pa.array(q)), n.take(pa.array(q))],
                                                 names=["word", "n", "near", "near_n"])

    for b in batches:
        held = pa.Table.from_batches([b] if held is None else [*held.to_batches(), b])
        if len(held) >= ROWS or held.nbytes >= BYTES:
            held = held.combine_chunks()
            cut = int(np.flatnonzero(changes(held))[-1])
            if cut:
                yield from compare(held.slice(0, cut))
                held = pa.Table.from_batches(held.slice(cut).to_batches()).combine_chunks()
    if held is not None and len(held):
        yield from compare(held)


def near_pairs(words: DataFrame, scratch: Scratch, min_chars: int = MIN_CHARS, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: each near pair of ``words``
    (``word``, ``n``) once."""
    rows = grouped(words, scratch, min_chars, block_cells).repartition(*KEY).sortWithinPartitions(*KEY)
    return rows.mapInArrow(_tiles, "word string, n long, near string, near_n long")


def followed(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word``, ``root`` from ``word``, ``root`` (the next form): pointers
    double their reach until none of them goes on."""
    up = scratch.table(forms, "roots")
    while True:
        ahead = up.select(F.col("word").alias("at"), F.col("root").alias("ahead"))
        step = up.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("at").isNotNull().alias("on"))
        further = scratch.table(step, "roots")
        if further.filter("on").isEmpty():
            return further.drop("on")
        up = further.drop("on")


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``,
    ``form_n``."""
    scratch = Scratch(docs.sparkSession)
    words = word_counts(docs.select("doc_id", "text"), scratch, min_chars, min_count)
    pairs = scratch.table(near_pairs(words, scratch, min_chars, block_cells), "near-pairs", compression="zstd")
    both = pairs.select("word", "near", "near_n").unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    formed = F.col("n") * ratio <= -F.col("best.less")
    known = scratch.table(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")), "forms", compression="zstd")
    roots = followed(known.filter("form is not null").select("word", F.col("form").alias("root")), scratch)
    result = known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    return finished(result, scratch, "variants")


def op13_prefix_suffix_tiling(spark, sf_dir: str) -> DataFrame:
    return variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# The checksum is worked out byte by byte: DuckDB has no crc32. A letter from U+00C0 on is two bytes.
OP13_SQL = r"""
WITH steps AS (
  SELECT b, list_reduce(range(8), lambda r, k: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END, b) AS v
  FROM (SELECT unnest(range(256)) AS b)),
codes AS (SELECT list(v ORDER BY b) AS t FROM steps),
low AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
runs AS (SELECT doc, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')) AS run FROM low),
tally AS (SELECT doc, run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT run, n, flatten(list_transform(string_split(doc || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) >= 192 THEN [195, unicode(c) - 64] ELSE [unicode(c)] END)) AS b FROM tally),
summed AS (
  SELECT run, n, xor(list_reduce(b, lambda r, x: xor(r >> 8, t[1 + (xor(r, x::BIGINT) & 255)]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM bytes, codes),
made AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word, n FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS (
  SELECT word, n, p, left(word, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
known AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form,
    CASE WHEN near_n >= 10 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
walk AS (
  WITH RECURSIVE w AS (
    SELECT word, word AS place, 0 AS depth FROM known
    UNION ALL SELECT w.word, k.form, depth + 1 FROM w JOIN known k ON k.word = w.place WHERE k.form IS NOT NULL)
  SELECT word, arg_max(place, depth) AS root FROM w GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM known JOIN walk USING (word)
"""

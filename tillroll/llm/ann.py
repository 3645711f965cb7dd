"""Nearest neighbours by a block matrix join (operator 10).

Queries and candidates are cut into blocks by hash; a tile is one block of
each, and every tile is one group of a cogrouped join, so no task and no
broadcast holds more than a block of either side. In a tile all products are
taken between int8 vectors (each scaled by its own largest component). The
part of a vector that rounding loses has a known length, so each product
gives a lower and an upper bound of the true distance; a candidate whose
lower bound is above the k-th smallest upper bound of its query can't be
among the k nearest of the tile. The others are measured again in double
precision on the original vectors, and the tiles' best are merged per query
by a heap of k rows. The result is exact.

Defined cases: vectors that are null, empty, all zero, or hold a null or
non-finite component take no part, nor do rows without an id; only vectors of
one length are compared; a query is one (id, vector), however often that row
is repeated, and rows with the query's id are not its candidates; repeated
candidates count each; ties go to the smaller id; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 10
QUERY_BLOCK, CANDIDATE_BLOCK = 16_384, 4_096
# Queries of one product inside a tile: bounds the tile's working memory.
STRIP = 512


def usable(vec: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def _matrix(table: pa.Table) -> np.ndarray:
    lists = table.column("vec").combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors, their scales, squared lengths once scaled, and the
    lengths of what rounding lost."""
    scale = np.abs(x).max(axis=1) / 127.0  # lengths may overflow: see the tile
    small = scale < 1e-290  # too small to divide by: nothing is kept, all is error
    q = np.rint(x / np.where(small, 1.0, scale)[:, None]).astype("int8")
    scale = np.where(small, 0.0, scale)
    kept = q * scale[:, None]
    with np.errstate(over="ignore"):
        return q, scale, (kept * kept).sum(axis=1), np.sqrt(((x - kept) ** 2).sum(axis=1))


def distances(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Euclidean, in double precision, components added from first to last.
    Where squares would overflow or vanish, the gap is scaled by a power of
    two first, which changes no digit."""
    with np.errstate(over="ignore"):
        gap = many - one
        largest = np.abs(gap).max(axis=1, initial=0.0)
        odd = np.isfinite(largest) & (largest > 0) & ((largest > 1e140) | (largest < 1e-140))
        power = np.where(odd, np.frexp(np.where(odd, largest, 1.0))[1], 0)
        gap = np.ldexp(gap, -power[:, None])
        return np.ldexp(np.sqrt(np.cumsum(gap * gap, axis=1)[:, -1]), power)


def _tile(k: int):
    def best(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, float]] = []
        if candidates.num_rows and queries.num_rows:
            c_id, q_id = (t.column("vec_id").to_numpy() for t in (candidates, queries))
            q_key = queries.column("q_key").to_numpy()
            c, q = _matrix(candidates), _matrix(queries)
            c8, c_scale, c_len, c_lost = quantise(c)
            q8, q_scale, q_len, q_lost = quantise(q)
            # Products of int8 sums stay below 2**24 up to 1040 components, below 2**53 always: exact in floats.
            exact = "float32" if c.shape[1] <= 1040 else "float64"
            c_t = np.ascontiguousarray(c8.astype(exact).T)
            for a in range(0, len(q), STRIP):
                s = slice(a, a + STRIP)
                product = (q8[s].astype(exact) @ c_t).astype("float64")
                with np.errstate(over="ignore", invalid="ignore"):
                    square = q_len[s, None] + c_len[None, :] - 2.0 * q_scale[s, None] * c_scale[None, :] * product
                    about = np.sqrt(np.maximum(square, 0.0))
                    # Rounding of the float arithmetic itself, generously.
                    slack = q_lost[s, None] + c_lost[None, :] + 1e-7 * (np.sqrt(q_len[s, None]) + np.sqrt(c_len[None, :]))
                    lower, upper = about - slack, about + slack
                # Vectors too large for these sums have no bounds: they are measured.
                unbounded = ~(np.isfinite(lower) & np.isfinite(upper))
                lower, upper = np.where(unbounded, 0.0, lower), np.where(unbounded, np.inf, upper)
                own = q_id[s, None] == c_id[None, :]
                upper[own] = np.inf
                limit = np.partition(upper, k - 1, axis=1)[:, k - 1] if len(c) > k else np.full(len(upper), np.inf)
                stays = ~own & (lower <= limit[:, None])
                for i in range(len(stays)):
                    at = np.flatnonzero(stays[i])
                    found = zip(distances(q[a + i], c[at]).tolist(), c_id[at].tolist())
                    out += [(int(q_key[a + i]), int(q_id[a + i]), v, d) for d, v in heapq.nsmallest(k, found)]
        return pa.Table.from_arrays([pa.array([r[n] for r in out], kind) for n, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                                    names=["q_key", "query_id", "vec_id", "score"])
    return best


def _merge(k: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come query by query; a heap of k holds the current query's best."""
        now, heap = None, []

        def flush() -> list[tuple]:
            return [(now[1], n + 1, -v, -d) for n, (d, v) in enumerate(sorted(heap, reverse=True))]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in enumerate(kinds)],
                                              names=["query_id", "rank", "vec_id", "score"])

        for b in batches:
            done: list[tuple] = []
            for key, query, vec, score in zip(*(b.column(n).to_pylist() for n in ("q_key", "query_id", "vec_id", "score"))):
                if (key, query) != now:
                    if now is not None:
                        done += flush()
                    now, heap = (key, query), []
                if len(heap) < k:
                    heapq.heappush(heap, (-score, -vec))
                else:
                    heapq.heappushpop(heap, (-score, -vec))
            if done:
                yield batch(done)
        if now is not None:
            yield batch(flush())
    return merge


def nearest(vectors: DataFrame, is_query: Column, k: int = K, query_block: int = QUERY_BLOCK,
            candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k``
    nearest (Euclidean) other rows of every row of ``vectors`` (``vec_id``,
    ``embedding``) for which ``is_query`` holds."""
    vec = F.col("embedding").cast("array<double>")
    rows = (vectors.filter(usable(vec) & F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"), F.size(vec).alias("dim"), is_query.alias("asks")))
    queries = (rows.filter("asks").withColumn("q_key", F.xxhash64("vec_id", "vec"))
               .dropDuplicates(["vec_id", "q_key"]).select("q_key", "vec_id", "vec", "dim"))
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    q_blocks = max(1, -(-counts["q"] // query_block))
    c_blocks = max(1, -(-counts["n"] // candidate_block))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = (rows.select("vec_id", "vec", "dim", F.pmod(F.xxhash64(F.lit(1), "vec_id", "vec"), F.lit(c_blocks)).cast("int").alias("cb"))
            .withColumn("qb", every(q_blocks)))
    right = (queries.withColumn("qb", F.pmod(F.xxhash64(F.lit(2), "vec_id", "vec"), F.lit(q_blocks)).cast("int"))
             .withColumn("cb", every(c_blocks)))
    tile = ["dim", "qb", "cb"]
    best = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInArrow(
        _tile(k), "q_key long, query_id long, vec_id long, score double")
    return (best.repartition("q_key", "query_id").sortWithinPartitions("q_key", "query_id")
            .mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score double"))


def op10_block_matrix_knn(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 100 == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND coalesce(isfinite(x), false)))
    AND list_bool_or(list_transform(embedding, lambda x: coalesce(x <> 0, false)))),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank, vec_id, score
FROM near QUALIFY rank <= 10
"""

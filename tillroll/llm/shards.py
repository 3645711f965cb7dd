"""Sharding by minimax contiguous partition (operator 5).

The rows of equal texts form an atomic group. Groups are put in the order of
a 64-bit hash of their text; the smallest shard capacity for which a greedy
left-to-right fill needs no more than ``shards`` shards is found by binary
search, and the order is cut where that fill cuts it.

The search needs prefix sums, not rows. Sizes are summed per hash range in
Spark; the driver holds at most about ``MAX_BLOCKS`` ranges. From the ranges
follow a capacity that surely suffices (whole ranges are kept together) and
one that is surely needed (ranges may be cut anywhere); only ranges that a
cut could still fall into are summed again, finer, until the two meet. So
the result is exact for any number of groups, and no group, however large, is
read by one task.

Defined cases: a null text has size 1 and is equal to other null texts only;
an empty text has size 1 too; repeated rows are separate rows of one group;
other columns are ignored; an empty table gives no rows; with fewer groups
than shards the last shards stay empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.shared import finished, positions_within
from tillroll.plans.lineage import Scratch

MAX_BLOCKS = 1 << 16
FIRST_BITS = 14
SHARDS = 16


def _sums(rows: DataFrame, bits: int, ranges: list[tuple[int, int]] | None) -> np.ndarray:
    """Size, lowest and highest key per range of keys with the same first
    ``bits``; ``ranges`` limits it to some such ranges (first, last)."""
    block = F.shiftright("key", 64 - bits)
    if ranges is not None:
        keep = F.lit(False)
        for first, last in ranges:
            keep = keep | F.col("key").between(first, last)
        rows = rows.filter(keep)
    got = rows.groupBy(block.alias("block")).agg(F.sum("size").alias("size"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    table = [(r["lo"], r["hi"], r["size"]) for r in got.collect()]
    return np.array(sorted(table), dtype=object).reshape(-1, 3)


def _fill(before: np.ndarray, capacity: int, shards: int, start: int = 0) -> list[int]:
    """Greedy fill of whole blocks: index of the first block after each shard."""
    cuts, at = [], start
    for _ in range(shards):
        at = int(np.searchsorted(before, before[at] + capacity, side="right")) - 1
        cuts.append(at)
    return cuts


def _reach(before: np.ndarray, atomic: np.ndarray, capacity: int, shards: int) -> list[int]:
    """As far as any fill can come: a block of several groups may be cut
    anywhere, an atomic one may not. Prefix sum after each shard."""
    ends, at = [], 0
    for _ in range(shards):
        at = min(at + capacity, int(before[-1]))
        block = int(np.searchsorted(before, at, side="right")) - 1
        if block < len(atomic) and atomic[block]:
            at = int(before[block])
        ends.append(at)
    return ends


def _smallest(feasible, low: int, high: int) -> int:
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(middle) else (middle + 1, high)
    return low


def minimax_cuts(rows: DataFrame, shards: int, max_blocks: int = MAX_BLOCKS, first_bits: int = FIRST_BITS) -> tuple[list[int], int]:
    """``rows`` has ``key`` (64-bit, equal for the rows of a group) and
    ``size``. Returns the first keys of shards 1, 2, ... and the capacity."""
    bits, blocks = first_bits, _sums(rows, first_bits, None)
    if not len(blocks):
        return [], 0
    while True:
        before = np.concatenate([[0], np.cumsum(blocks[:, 2])]).astype("int64")
        total, atomic = int(before[-1]), blocks[:, 0] == blocks[:, 1]
        low = max(-(-total // shards), int(blocks[atomic, 2].max()) if atomic.any() else 1)
        high = _smallest(lambda c: _fill(before, c, shards)[-1] == len(blocks), low, total)
        low = _smallest(lambda c: _reach(before, atomic, c, shards)[-1] == total, low, high)
        cuts = _fill(before, high, shards)
        if low == high:
            break
        least, most = _fill(before, low, shards), _reach(before, atomic, high, shards)
        windows = [(a, min(int(np.searchsorted(before, b, side="right")) - 1, len(blocks) - 1)) for a, b in zip(least, most) if a < len(blocks)]
        inside = np.zeros(len(blocks), dtype=bool)
        for a, b in windows:
            inside[a:b + 1] = True
        if bits == 64 or atomic[inside].all():
            break
        open_blocks = int((inside & ~atomic).sum())
        bits = min(64, bits + max(1, int(np.log2(max_blocks / max(open_blocks, 1)))))
        edge = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(int), [0]])))
        ranges = [(int(blocks[a, 0]), int(blocks[b - 1, 1])) for a, b in zip(edge[::2], edge[1::2])]
        finer = _sums(rows, bits, ranges)
        merged = np.concatenate([blocks[~inside], finer])
        blocks = merged[np.argsort(merged[:, 0].astype("int64"))]
    return [int(blocks[c, 0]) for c in cuts[:-1] if c < len(blocks)], high


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``text_crc32``, ``law``
    (``bytes``), ``shard``, ``slot`` (0-based, gapless) and ``grown_shard``
    (null: the law does not grow by one shard in place)."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.table(docs.select(
        "doc_id", F.monotonically_increasing_id().alias("uid"), F.xxhash64("text").alias("key"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")), "shard-rows")
    cuts, _ = minimax_cuts(rows, shards)
    shard = F.lit(0)
    for first in cuts:
        shard = shard + (F.col("key") >= F.lit(first)).cast("int")
    dealt = positions_within(rows.withColumn("shard", shard), ["shard"], ["uid"], "slot", rows.count())
    return finished(dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard")), scratch, "shards")


def op5_minimax_shards(spark, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

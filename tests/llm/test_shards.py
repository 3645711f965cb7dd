"""Sharding against exhaustive search."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from brute import awkward_rows, docs_frame

from tillroll.llm import shards


def least_capacity(sizes, parts):
    """Smallest largest sum of a contiguous partition, by trying every sum."""
    sums = {sum(sizes[a:b]) for a in range(len(sizes)) for b in range(a + 1, len(sizes) + 1)}
    for c in sorted(sums):
        need, room = 1, c
        for s in sizes:
            if s > c:
                break
            if s > room:
                need, room = need + 1, c
            room -= s
        else:
            if need <= parts:
                return c
    return 0


@pytest.mark.parametrize("seed,heavy", [(0, 1), (1, 1), (2, 400), (3, 4000)])
def test_cuts_are_minimax_with_few_blocks(spark, seed, heavy):
    r = np.random.default_rng(seed)
    keys = r.integers(-2**63, 2**63, 60, dtype="i8")
    sizes = r.integers(1, 50, 60)
    sizes[17] *= heavy
    rows = [(int(k), int(s)) for k, s in zip(keys, sizes) for _ in range(2)]
    frame = spark.createDataFrame(rows, "key long, size long")
    cuts, capacity = shards.minimax_cuts(frame, 7, max_blocks=16, first_bits=2)
    order = np.argsort(keys)
    assert capacity == least_capacity([2 * int(sizes[k]) for k in order], 7)
    load = defaultdict(int)
    for k, s in rows:
        load[sum(k >= c for c in cuts)] += s
    assert max(load.values()) == capacity and max(load) < 7


def test_awkward_documents(spark):
    rows = awkward_rows()
    got = shards.shard_documents(docs_frame(spark, rows), 4).collect()
    assert len(got) == len(rows)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, _ in rows)
    slots, where = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        where[(r["size"], r["text_crc32"])].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 4
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for k, s in where.items() if k[0] > 1)  # size 1: null and empty texts are two groups


def test_empty_table(spark):
    assert shards.shard_documents(docs_frame(spark, [(1, "x", "en")]).filter("false")).count() == 0


def test_sizes_are_near_equal_on_the_test_table(spark):
    got = shards.op5_minimax_shards(spark, "/root/testdata/sf0.01").groupBy("shard").sum("size").collect()
    load = [r[1] for r in got]
    assert len(load) == 16 and max(load) < 1.1 * sum(load) / 16

"""SimHash groups against plain Python."""

from collections import Counter

import numpy as np
import pytest
from brute import awkward_rows, docs_frame, fingerprint, groups, rooted

from tillroll.llm import simhash
from tillroll.plans.lineage import Scratch


def near_rows():
    base = " ".join(f"t{k}" for k in range(300))
    rows = [(k, base + f" tail{k}", "en") for k in range(20)]
    return rows + [(50 + k, " ".join(f"u{k}{j}" for j in range(40)), "en") for k in range(30)]


def found(spark, rows):
    got = simhash.simhash_groups(docs_frame(spark, rows)).collect()
    return Counter((r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in got)


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one two", "A b C d", "é É x y z", "a b c " * 500])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == fingerprint(text)


def test_awkward_and_near_documents(spark):
    rows = awkward_rows() + near_rows()
    assert found(spark, rows) == Counter(groups(rows))


def test_large_keys_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 3)
    rows = near_rows()
    assert found(spark, rows) == Counter(groups(rows))


def test_empty_table(spark):
    assert found(spark, []) == Counter()


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_bit_sliced_distances(radius):
    r = np.random.default_rng(radius)
    base = r.integers(0, 2**63, 150, dtype="u8")
    prints = [b ^ np.uint64(sum(1 << int(k) for k in r.choice(64, n, replace=False))) for b in base for n in (0, 1, 2, 3, 4)]
    prints = np.unique(np.array(prints, dtype="u8"))
    got = {(int(a), int(b)) for i, j in simhash.close_pairs(prints, radius) for a, b in zip(i, j)}
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(near, 1)))}


def test_components_of_a_long_chain(spark):
    n = 60
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)] + [(1000, 1001)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges, Scratch(spark)).collect()}
    assert got == {k: 0 for k in range(1, n + 1)} | {1001: 1000}


def test_one_row_of_each_group_stays(spark):
    rows = awkward_rows() + near_rows()
    docs = docs_frame(spark, rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    first = {}
    for i, _, _, root in rooted(rows):
        first[root] = min(first.get(root, (True, 0)), (i is None, i or 0))
    got = [(r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()]
    assert sorted(got) == sorted(first.values())

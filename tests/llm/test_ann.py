"""Block matrix nearest neighbours against plain numpy."""

import math

import numpy as np
import pytest

from pyspark.sql import functions as F

from tillroll.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, vec string, qb int, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, "y") for i, v in rows], SCHEMA)


def expected(rows, k, every):
    good = [(i, np.array(v, dtype="f4").astype(float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)]
    out, seen = [], set()
    for i, q in good:
        if i % every or (i, q.tobytes()) in seen:
            continue
        seen.add((i, q.tobytes()))
        near = sorted((float(np.sqrt(np.cumsum((c - q) ** 2)[-1])), j) for j, c in good if j != i and len(c) == len(q))
        out += [(i, n + 1, j, d) for n, (d, j) in enumerate(near[:k])]
    return sorted(out)


def found(spark, rows, k=10, every=10, **blocks):
    got = ann.nearest(frame(spark, rows), F.col("vec_id") % every == 0, k, **blocks).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


@pytest.mark.parametrize("blocks", [{}, {"query_block": 7, "candidate_block": 31}])
def test_exact_on_clustered_vectors(spark, blocks):
    r = np.random.default_rng(0)
    centers = r.normal(size=(5, 16))
    rows = [(k, [float(x) for x in (centers[k % 5] + r.normal(size=16) * (10.0 ** -(k % 4)))]) for k in range(400)]
    assert found(spark, rows, **blocks) == expected(rows, 10, 10)


def test_awkward_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(k, same) for k in range(15)] + [(0, same), (0, [5.0, 5.0, 5.0]), (20, None), (30, []), (40, [0.0, 0.0, 0.0]), (50, [1.0, None, 2.0]),
            (60, [1.0, float("nan"), 2.0]), (70, [1.0, float("inf"), 0.0]), (80, [1.0, 2.0]), (81, [1.0, 2.5]), (None, same),
            (90, [1e-30, 0.0, 0.0]), (91, [3e38, -3e38, 3e38]), (100, [1e-44, 1e-44, 0.0])]
    assert found(spark, rows) == expected(rows, 10, 10)


def test_fewer_candidates_than_k_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    assert found(spark, rows) == expected(rows, 10, 10)
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []


def test_huge_and_tiny_doubles(spark):
    """Squared lengths overflow or vanish; no neighbour is lost."""
    r = np.random.default_rng(7)
    rows = [(k, [float(x) for x in r.normal(size=3) * 7e200]) for k in range(7)] + [(10 + k, [float(x) for x in r.normal(size=3) * 1e-200]) for k in range(7)]
    rows += [(20 + k, [float(x) for x in r.normal(size=3)]) for k in range(7)] + [(30, [1.7e308, 0.0, 0.0]), (31, [-1.7e308, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for x in ann.nearest(frame, F.col("vec_id") % 10 == 0, 3).collect():
        got.setdefault(x["query_id"], []).append((x["rank"], x["vec_id"], x["score"]))
    for i, q in rows:
        if i % 10 == 0:
            with np.errstate(over="ignore"):
                near = sorted((math.hypot(*(float(a) - float(b) for a, b in zip(c, q))), j) for j, c in rows if j != i)
            mine = sorted(got[i])
            assert [m[1] for m in mine] == [j for _, j in near[:3]] and [m[2] for m in mine] == pytest.approx([d for d, _ in near[:3]], rel=1e-14)


def test_bounds_hold():
    r = np.random.default_rng(3)
    x, y = r.normal(size=(50, 33)) * 10.0 ** r.integers(-3, 3, (50, 1)), r.normal(size=(60, 33))
    for a, b in ((x, y), (y, x)):
        qa, sa, la, ea = ann.quantise(a)
        qb, sb, lb, eb = ann.quantise(b)
        about = np.sqrt(np.maximum(la[:, None] + lb[None] - 2 * sa[:, None] * sb[None] * (qa.astype(float) @ qb.T), 0))
        true = np.array([ann.distances(v, b) for v in a])
        assert (np.abs(about - true) <= ea[:, None] + eb[None] + 1e-6 * (np.sqrt(la)[:, None] + np.sqrt(lb)[None])).all()

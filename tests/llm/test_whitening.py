"""Whitening against numpy's full decomposition."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tillroll.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int, x string, dim int, w string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1, "y") for i, v in rows], SCHEMA)


def expected(rows, most=4):
    """{length: (n, sums, eigenvalues, vectors)} and the usable rows on the grid."""
    good = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    spaces = {}
    for d in {len(x) for _, x in good}:
        fit = sorted({x for _, x in good if len(x) == d})
        sums = [sum(col) for col in zip(*fit)]
        gap = np.array([[float(Fraction(c * len(fit) - s, len(fit))) for c, s in zip(x, sums)] for x in fit])
        v = gap.T @ gap / len(fit)
        e, u = np.linalg.eigh(v)
        spaces[d] = (len(fit), sums, e[::-1], u[:, ::-1], np.trace(v))
    return spaces, good


def check(spark, rows, most=4, tol=1e-7):
    spaces, good = expected(rows, most)
    got = {}
    for r in whitening.whiten(frame(spark, rows), most).collect():
        got.setdefault((r["component"], r["vec_id"]), []).append(r)
    n_rows = 0
    for d, (n, sums, e, u, trace) in spaces.items():
        real = [k for k in range(min(most, d)) if e[k] > 1e-11 * max(trace, 1e-300) * d]
        for k in real:
            gaps = [abs(e[k] - e[j]) for j in range(d) if j != k]
            ours, theirs = [], []
            for i, x in good:
                if len(x) != d:
                    continue
                n_rows += 1
                r = next(r for r in got[k + 1, i] if r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x, sums)))
                assert r["n"] == n and r["identity_error"] <= 1e-9
                assert abs(r["explained"] - e[k] / trace) <= 1e-10
                ours.append(r["whitened"])
                theirs.append(float(sum(float(Fraction(n * c - s, n)) * w for c, s, w in zip(x, sums, u[:, k]))) / math.sqrt(e[k]))
            if not gaps or min(gaps) > 1e-6 * e[0]:
                ours, theirs = np.array(ours), np.array(theirs)
                sign = 1 if ours @ theirs > 0 else -1
                assert np.abs(ours - sign * theirs).max() <= tol * max(np.abs(theirs).max(), 1)
    assert sum(map(len, got.values())) == n_rows
    return got


@pytest.mark.parametrize("seed", range(8))
def test_inertia_counts(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(1, 40))
    q, _ = np.linalg.qr(r.normal(size=(n, n)))
    e = np.round(r.normal(size=n), 1) * 10.0 ** r.integers(-3, 3)
    a = (q * e) @ q.T
    for shift in (0.0137, -0.4137, 2.0571, 50.013):
        assert whitening.positive_pivots((a + a.T) / 2 - shift * np.eye(n)) == int((e > shift).sum())
    assert whitening.positive_pivots(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1
    assert whitening.positive_pivots(np.zeros((3, 3))) == 0


@pytest.mark.parametrize("e", [[9, 4, 1, 0.5, 0.1], [5, 5, 5, 5, 5], [1, 1 - 1e-9, 1 - 2e-9, 0.3, 0.2], [7, 0, 0, 0, 0], [1e-200, 1e-201, 0, 0, 0], [1e200, 1e190, 1e3, 1, 0],
                               [3, 3, 1, 1, 1], [2]])
def test_leading_components(e):
    r = np.random.default_rng(3)
    q, _ = np.linalg.qr(r.normal(size=(len(e), len(e))))
    v = (q * np.array(e, float)) @ q.T
    v = (v + v.T) / 2
    values, vectors = whitening.leading_components(v, 4)
    want = [x for x in e[:4] if x > 1e-13 * e[0]]
    assert len(values) == len(want) and np.allclose(values, want, rtol=1e-10, atol=1e-13 * e[0])
    assert np.allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-10)
    assert np.abs(v @ vectors - vectors * values).max() <= 1e-12 * e[0]


def test_large_matrix():
    r = np.random.default_rng(4)
    x = r.normal(size=(900, 200)) * np.linspace(1, 3, 200)
    v = np.cov(x.T, bias=True)
    values, vectors = whitening.leading_components(v, 4)
    want, axes = np.linalg.eigh(v)
    assert np.allclose(values, want[::-1][:4], rtol=1e-12)
    assert np.allclose(np.abs((vectors * axes[:, ::-1][:, :4]).sum(axis=0)), 1, atol=1e-9)


def test_clustered_vectors_with_copies(spark):
    r = np.random.default_rng(0)
    centers = r.normal(size=(6, 12))
    rows = [(k, [float(c) for c in centers[k % 6] + r.normal(size=12) * 0.1]) for k in range(300)]
    check(spark, rows + [(1000 + k, rows[k % 3][1]) for k in range(400)])


def test_awkward_vectors(spark):
    r = np.random.default_rng(1)
    rows = [(k, [float(c) for c in r.normal(size=3)]) for k in range(40)]
    rows += [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [float("nan"), 0.0, 1.0]), (54, [1.0, float("-inf"), 0.0]), (None, [0.5, -0.5, 0.25]),
             (55, [-0.0, 0.0, -1e-30]), (56, [0.001, 0.002, 0.003]), (7, [5.0, 5.0, 5.0]), (60, [1.0, 2.0]), (61, [2.0, 1.0]), (62, [2.0, 1.0]), (70, [3.0])]
    check(spark, rows)


def test_few_or_flat_vectors(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [(k, [1.0, 2.0]) for k in range(9)])).count() == 0
    assert len(check(spark, [(1, [1.0, 2.0, 3.0, 4.0, 5.0]), (2, [1.5, 2.0, 0.0, 4.0, 5.0]), (3, [9.0, 2.0, 3.0, 1.0, 5.0])])) == 6
    assert len(check(spark, [(k, [float(k), float(-k)]) for k in range(10)])) == 10


def test_large_entries_keep_exact_deviations(spark):
    rows = [(1, [2e6, -1.0]), (2, [-1.9e6, 4.0]), (3, [1e5, 1e3])]
    got = check(spark, rows)
    assert all(r[0]["deviation"] > 1 << 53 for (_, i), r in got.items() if i < 3)
    huge = whitening.whiten(frame(spark, [(1, [1e17, 0.0]), (2, [0.0, 1e300]), (3, [-1e17, 5.0])])).collect()
    assert huge and all(r["deviation"] is None and math.isfinite(r["whitened"]) for r in huge)


def test_query_over_a_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    spaces, good = expected(rows)
    (n, sums, e, u, trace), = spaces.values()
    out = whitening.op12_spectrum_slicing(spark, sf).collect()
    assert len(out) == 4 * len(good)
    table = {(r["vec_id"], r["component"]): r for r in out}
    for k in range(4):
        want = np.array([sum((c - s / n) * w for c, s, w in zip(x, sums, u[:, k])) / math.sqrt(e[k]) for _, x in good])
        ours = np.array([table[i, k + 1]["whitened"] for i, _ in good])
        assert min(np.abs(ours - want).max(), np.abs(ours + want).max()) < 1e-8
    for i, x in good:
        r = table[i, 1]
        assert r["n"] == n and r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x, sums))
        assert abs(r["explained"] * trace / e[0] - 1) < 1e-10 and 0 <= r["identity_error"] < 1e-9

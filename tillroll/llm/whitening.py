"""Embedding whitening by spectrum slicing (operator 12).

Vectors become whole numbers, ``floor(256 c)``. The different ones are the
fit list; from its exact sums follow the means, and from products of centred
vectors its covariance. Both are added up per partition and then per row of
the matrix, so what moves has the size of the matrix, not of the table.

The leading components are found without a full decomposition. The number of
positive pivots of an LDL' factorisation of ``V - s I`` is the number of
eigenvalues above ``s`` (Sylvester). Halving intervals by that count isolates
the k-th eigenvalue, Rayleigh quotient iteration then converges cubically to
it, and two more counts, just below and just above, certify that it is number
k. Eigenvalues that no interval of rounding size can separate are numbered by
the count alone, with vectors orthogonal to those before.

The components are written once, so every row and every repeated task uses
the same ones, signs included. How far the whitened fit list is from unit
covariance is measured on the whitened vectors themselves.

Defined cases: rows whose vector is null or holds a null or non-finite entry
are dropped; an empty vector has no components and so no rows; vectors of
different lengths are different spaces, each whitened on its own (the driver
holds a few vectors per length); repeated rows are returned each and count
once in the fit list; a null vec_id stays null; an entry beyond 64 bits is
the nearest 64-bit number; eigenvalues that are zero up to rounding are no
components (fewer vectors than dimensions, constant dimensions), so equal
vectors alone give no rows; a deviation beyond 64 bits is null; other columns
are ignored; an empty table gives no rows. A matrix of one length has to fit
a worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.plans.lineage import Scratch

COMPONENTS = 4
GRID = 256.0
EPS = float(np.finfo("f8").eps)
# Fixed value of the pivoting rule (Bunch and Kaufman): the bound that lets elements grow least.
PIVOT = (1 + 17 ** 0.5) / 8


# ---- one symmetric matrix --------------------------------------------------

def positive_pivots(a: np.ndarray) -> int:
    """Positive eigenvalues of a symmetric matrix, from the pivots of its
    LDL' factorisation with 1 x 1 and 2 x 2 diagonal blocks."""
    a, n, k, positive = a.copy(), len(a), 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j], k:] = a[[j, i], k:]
            a[k:, [i, j]] = a[k:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1:, k])
        most = below.max() if len(below) else 0.0
        pair = False
        if most and abs(a[k, k]) < PIVOT * most:
            r = k + 1 + int(below.argmax())
            others = np.abs(a[r, k:])
            others[r - k] = 0.0
            row = others.max()
            if abs(a[k, k]) * row < PIVOT * most * most:
                pair = abs(a[r, r]) < PIVOT * row
                swap(k + 1 if pair else k, r)
        if pair:
            block, side = a[k:k + 2, k:k + 2], a[k + 2:, k:k + 2]
            apart = block[0, 0] * block[1, 1] < block[0, 1] ** 2
            positive += 1 if apart else 2 * int(block[0, 0] + block[1, 1] > 0)
            a[k + 2:, k + 2:] -= side @ np.linalg.solve(block, side.T)
            k += 2
        else:
            positive += int(a[k, k] > 0)
            if most:
                column = a[k + 1:, k].copy()
                a[k + 1:, k + 1:] -= np.outer(column, column / a[k, k])
            k += 1
    return positive


def _toward(a: np.ndarray, shift: float, x: np.ndarray, found: list[np.ndarray], nudge: float) -> np.ndarray:
    """One step of inverse iteration, orthogonal to what was found."""
    try:
        y = np.linalg.solve(a - shift * np.eye(len(a)), x)
    except np.linalg.LinAlgError:
        y = np.linalg.solve(a - (shift + nudge) * np.eye(len(a)), x)
    y /= np.abs(y).max()
    for _ in range(2):
        for u in found:
            y -= (u @ y) * u
    return y / np.sqrt(y @ y)


def leading_components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` largest eigenvalues of a covariance, falling, and their
    unit vectors as columns."""
    scale = float(np.abs(v).max()) if v.size else 0.0
    n, values, found = len(v), [], []
    if not scale:
        return np.zeros(0), np.zeros((n, 0))
    a = v / scale
    a = (a + a.T) / 2
    top = min(float(np.abs(a).sum(axis=1).max()), float(np.sqrt((a * a).sum()))) * (1 + 1e-6)
    noise = 4 * n * EPS * top
    counts = {noise: positive_pivots(a - noise * np.eye(n)), top: 0}

    def above(shift: float) -> int:
        if shift not in counts:
            counts[shift] = positive_pivots(a - shift * np.eye(n))
        return counts[shift]

    random = np.random.default_rng(0)
    for k in range(1, min(most, counts[noise]) + 1):
        low = max(s for s, c in counts.items() if c >= k)
        high = min(s for s, c in counts.items() if c < k and s > low)
        while True:
            while high - low > noise and not (above(low) == k and above(high) == k - 1):
                middle = (low + high) / 2
                low, high = (middle, high) if above(middle) >= k else (low, middle)
            narrow = high - low <= noise
            x = random.normal(size=n)
            for _ in range(3):
                x = _toward(a, (low + high) / 2, x, found, noise)
            value = float(x @ a @ x)
            for _ in range(0 if narrow else 30):
                if not low <= value <= high:
                    break
                x = _toward(a, value, x, found, noise)
                value = float(x @ a @ x)
                rest = float(np.abs(a @ x - value * x).max())
                if rest <= noise:
                    break
            # An eigenvalue is within the residual of the quotient; the counts say which one it is.
            rest = max(float(np.sqrt(((a @ x - value * x) ** 2).sum())), noise)
            if narrow or (rest <= 16 * noise and above(value - 2 * rest) >= k and above(value + 2 * rest) < k):
                break
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= k else (low, middle)
        values.append(value)
        found.append(x)
    # Neighbours closer than rounding may come out in either order.
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order] * scale, np.column_stack(found)[:, order] if found else np.zeros((n, 0))


# ---- the table -------------------------------------------------------------

def usable(vec: Column) -> Column:
    """Not null, every entry finite."""
    finite = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def on_grid(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``x`` of the usable rows that have any entry."""
    vec = F.col("embedding").cast("array<double>")
    return (vectors.select("vec_id", vec.alias("vec")).filter(usable(F.col("vec")) & (F.size("vec") > 0))
            .select("vec_id", F.transform("vec", lambda c: F.floor(c * GRID)).alias("x")))


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, whole-number matrix) of a batch's vectors."""
    lists = batch.column("x")
    sizes = np.diff(lists.offsets.to_numpy())
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        flat = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield int(d), rows, flat.astype("i8").reshape(len(rows), int(d))


def _highest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min()))


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}
    for b in batches:
        for d, rows, x in by_length(b):
            part = x.sum(axis=0) if _highest(x) * len(x) < 1 << 62 else x.astype(object).sum(axis=0)
            so_far = held.setdefault(d, [0, [0] * d])
            so_far[0] += len(rows)
            so_far[1] = [s + int(p) for s, p in zip(so_far[1], part)]
    for d, (n, sums) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
             pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0))], names=["dim", "at", "n", "total"])


@dataclass
class Space:
    """What is known of the vectors of one length."""
    n: int
    sums: list[int]
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None
    explained: np.ndarray | None = None
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2; None beyond 64 bits."""
        most = self.n * _highest(x) + max(map(abs, self.sums))
        small = most * most * x.shape[1] < 1 << 63
        gap = self.n * (x if small else x.astype(object)) - np.array(self.sums, "i8" if small else object)
        return [s if s < 1 << 63 else None for s in (gap * gap).sum(axis=1).tolist()]


def _partial_products(means: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for b in batches:
            for d, _, x in by_length(b):
                gap = x - means[d]
                held[d] = held.get(d, 0.0) + gap.T @ gap
        for d, products in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([r.tobytes() for r in products], pa.binary())],
                names=["dim", "at", "products"])
    return run


def _added(rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(r.as_py(), "<f8") for r in rows.column("products"))
    return pa.table({"dim": rows.column("dim")[:1], "at": rows.column("at")[:1], "products": pa.array([total.tobytes()], pa.binary())})


def _solved(sizes: dict[int, int], most: int):
    def run(rows: pa.Table) -> pa.Table:
        d = rows.column("dim")[0].as_py()
        order = np.argsort(rows.column("at").to_numpy())
        v = np.array([np.frombuffer(rows.column("products")[int(i)].as_py(), "<f8") for i in order]) / sizes[d]
        values, vectors = leading_components(v, most)
        m = len(values)
        return pa.table({"dim": pa.array([d] * m, pa.int32()), "component": pa.array(range(1, m + 1), pa.int32()), "value": pa.array(values, pa.float64()),
                         "explained": pa.array(values / np.trace(v), pa.float64()), "vector": pa.array(list(vectors.T.copy()), pa.list_(pa.float64()))})
    return run


def fitted(fit: DataFrame, scratch: Scratch, most: int = COMPONENTS) -> dict[int, Space]:
    """The space of each length in ``fit`` (``x``, each once)."""
    spaces: dict[int, Space] = {}
    sums = (fit.mapInArrow(_partial_sums, "dim int, at int, n long, total decimal(38,0)")
            .groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")))
    for r in sorted(sums.collect()):
        spaces.setdefault(r["dim"], Space(r["n"], [])).sums.append(int(r["total"]))
    sizes, means = {d: s.n for d, s in spaces.items()}, {d: s.mean for d, s in spaces.items()}
    products = "dim int, at int, products binary"
    matrix = fit.mapInArrow(_partial_products(means), products).groupBy("dim", "at").applyInArrow(_added, products)
    components = scratch.table(matrix.groupBy("dim").applyInArrow(
        _solved(sizes, most), "dim int, component int, value double, explained double, vector array<double>"), "components")
    held: dict[int, list] = {d: [] for d in spaces}
    for r in sorted(components.collect()):
        held[r["dim"]].append(r)
    for d, rows in held.items():
        spaces[d].values, spaces[d].explained = (np.array([r[name] for r in rows]) for name in ("value", "explained"))
        spaces[d].vectors = np.array([r["vector"] for r in rows]).reshape(len(rows), d).T
    for r in _measured(fit, spaces, most).collect():
        spaces[r["dim"]].identity_error = r["identity_error"] or 0.0
    return spaces


def _measured(fit: DataFrame, spaces: dict[int, Space], most: int) -> DataFrame:
    """``dim``, ``identity_error``: the whitened fit list's covariance
    against the identity, largest absolute difference."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, rows, x in by_length(b):
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(rows), pa.int32()), pa.array(list(spaces[d].whitened(x)), pa.list_(pa.float64()))],
                                                 names=["dim", "w"])

    w = [F.get("w", F.lit(i)) for i in range(most)]
    gaps = [F.abs(F.covar_pop(w[i], w[j]) - float(i == j)) for i in range(most) for j in range(i, most)]
    worst = F.greatest(*gaps, F.lit(0.0))
    return fit.mapInArrow(run, "dim int, w array<double>").groupBy("dim").agg(worst.alias("identity_error"))


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """One row per usable row of ``vectors`` (``vec_id``, ``embedding``) and
    component: ``vec_id``, ``component``, ``n`` (size of the fit list),
    ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    scratch = Scratch(vectors.sparkSession)
    rows = on_grid(vectors)
    spaces = fitted(scratch.table(rows.select("x").distinct(), "fit-list", compression="zstd"), scratch, most)
    scratch.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, at, x in by_length(b):
                space = spaces[d]
                m = len(space.values)
                each = np.repeat(np.arange(len(at)), m)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id").take(pa.array(at[each])), pa.array(np.tile(np.arange(1, m + 1, dtype="i4"), len(at))),
                     pa.array(np.full(len(each), space.n, "i8")), pa.array(space.deviations(x), pa.int64()).take(pa.array(each)),
                     pa.array(space.whitened(x).ravel()), pa.array(np.tile(space.explained, len(at))), pa.array(np.full(len(each), space.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def op12_spectrum_slicing(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))

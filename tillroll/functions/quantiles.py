"""Equal-count cut points as the dashboard computes them (pandas ``qcut``).

``qcut(x, 3)`` takes the linearly interpolated 1/3 and 2/3 quantiles of the
sorted values (position ``(n - 1) * q``). The float rounding of that
position decides where ties of the cut fall (it is exactly 10.0 for
n = 31 but just under 1.0 for n = 4), so the positions are computed here
with the same float64 steps, from ``n`` alone. Only the values at two
positions are then needed from the data.
"""

from __future__ import annotations

import math

import numpy as np


def cut_positions(n: int, k: int = 3) -> list[tuple[int, int, float]]:
    """For each inner edge of a k-quantile cut of ``n`` sorted values:
    (lower 0-based position, upper position, interpolation weight)."""
    qs = np.true_divide(np.linspace(0, 1, k + 1)[1:-1] * 100, 100)
    out = []
    for q in qs:
        v = float((n - 1) * q)
        lo = math.floor(v)
        if v >= n - 1:
            out.append((n - 1, n - 1, 0.0))
        else:
            out.append((lo, lo + 1, v - lo))
    return out


def lerp(a: float, b: float, t: float) -> float:
    """Interpolate between a and b the way numpy does (from b when t >= 0.5)."""
    d = b - a
    return b - d * (1 - t) if t >= 0.5 else a + d * t


def rank_cuts(n: int, k: int = 3) -> list[int]:
    """Highest rank (1-based) inside each of the first k-1 bins of a qcut
    over the ranks 1..n."""
    return [math.floor(lerp(lo + 1.0, hi + 1.0, t)) for lo, hi, t in cut_positions(n, k)]

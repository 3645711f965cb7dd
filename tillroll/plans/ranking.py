"""Global order statistics without a single-task window.

``row_number()`` over an unpartitioned window moves every row into one
task. Here rows are range-partitioned on the order keys and sorted inside
each partition; ``monotonically_increasing_id`` then encodes (partition,
position). The table is checkpointed to the reliable checkpoint folder so
the sampled range bounds and positions are fixed (a lost executor re-reads
the checkpoint instead of re-sampling). A tiny per-partition count table,
one row per partition, gives each partition its offset and is broadcast.
"""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.plans.lineage import checkpointed

_ID_BITS = 33  # monotonically_increasing_id: partition index << 33 | position


def _key(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def global_row_number(df: DataFrame, order_cols: list, out: str = "rank",
                      total: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position in the ascending order of
    ``order_cols`` (give a unique tie-break last), and optionally ``total``
    = the row count. Equal to ``row_number() OVER (ORDER BY ...)``.
    """
    keys = [_key(c) for c in order_cols]
    # Without an explicit count AQE may coalesce the range partitions; it
    # only merges neighbours, so partition order still follows key order.
    ranged_by = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = checkpointed(ranged_by.sortWithinPartitions(*keys)
                          .withColumn("_rid", F.monotonically_increasing_id()))
    pid = F.shiftright("_rid", _ID_BITS)
    pos = F.col("_rid").bitwiseAND(F.lit((1 << _ID_BITS) - 1))
    # One row per partition: bounded by the partition count, so the unpartitioned
    # window and the broadcast below are over a few thousand rows at most.
    counts = ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(Window.partitionBy()).alias("_total"))
    res = (ranged.join(F.broadcast(offsets), pid == F.col("_pid"))
                 .withColumn(out, F.col("_off") + pos + 1))
    if total:
        res = res.withColumn(total, F.col("_total"))
    return res.drop("_rid", "_pid", "_off", "_total")


def kth_smallest(df: DataFrame, order_cols: list, k: int | None = None, p: float | None = None,
                 tie_break: bool = False) -> DataFrame:
    """One row: the k-th smallest row in the order of ``order_cols`` or, with
    ``p``, the ``ceil(p * n)``-th (percentile_disc). Empty input -> no row.

    ``tie_break=True`` appends a generated row id to the order so that many
    equal keys (one value held by a third of the rows) spread over several
    range partitions instead of one; use it when only the key value of the
    k-th row matters, which does not depend on how ties are ordered."""
    keys = list(order_cols)
    if tie_break:
        df = df.withColumn("_tb", F.monotonically_increasing_id())
        keys.append("_tb")
    ranked = global_row_number(df, keys, "_k", total="_n")
    if k is not None:
        target = F.lit(k)
    else:
        target = F.greatest(F.ceil(F.lit(Decimal(str(p))) * F.col("_n")), F.lit(1))
    out = ranked.filter(F.col("_k") == target).drop("_k", "_n")
    return out.drop("_tb") if tie_break else out


def percentile_disc(df: DataFrame, col: str, p: float, accuracy: int = 100_000) -> DataFrame:
    """Exact ``percentile_disc(p)`` of a numeric column as a one-row table
    (column ``col``; no row for empty input), without sorting the table.

    ``percentile_approx`` places the k-th value (k = ceil(p n)) inside a
    window whose rank width is about 4 n / ``accuracy``. One counting pass
    gives the rows under the window; only the rows inside it are ranked
    (distributed). Should the window miss k, the whole column is ranked
    instead, so the answer is exact either way. Read ``df`` from a
    checkpoint or table: it is scanned up to three times.
    """
    eps = 2.0 / accuracy
    v = F.col(col)
    head = df.agg(F.count(F.lit(1)).alias("n"),
                  F.percentile_approx(v, [max(p - eps, 0.0), min(p + eps, 1.0)], accuracy).alias("b")).first()
    n = head["n"]
    if n == 0:
        return df.select(col).limit(0)
    k = max(math.ceil(Fraction(str(p)) * n), 1)
    lo, hi = head["b"]
    inside = (v >= F.lit(lo)) & (v <= F.lit(hi))
    counts = df.agg(F.count_if(v < F.lit(lo)).alias("below"), F.count_if(inside).alias("m")).first()
    if counts["below"] < k <= counts["below"] + counts["m"]:
        return kth_smallest(df.filter(inside).select(col), [col], k=k - counts["below"], tie_break=True)
    return kth_smallest(df.select(col), [col], k=k, tie_break=True)


def kth_many(df: DataFrame, picks: list[tuple[Column, int, int]], accuracy: int = 100_000) -> list[tuple]:
    """For each pick (a numeric column, k, and how many rows have a value
    there): the k-th smallest value, how many are below it and how many equal
    it. Nothing is sorted, and all picks share three passes: approximate
    percentiles bracket the values, one pass counts the rows under the
    brackets, and only the different values inside them (about 4 n /
    ``accuracy`` and a few common ones) are counted and added up in order.
    Read ``df`` from a checkpoint."""
    eps = 2.0 / accuracy
    df = df.select(*[v.alias(f"v{i}") for i, (v, _, _) in enumerate(picks)])
    whole = [kind in ("tinyint", "smallint", "int", "bigint") for _, kind in df.dtypes]
    cols = [F.col(c) for c in df.columns]
    bounds = df.agg(*[F.percentile_approx(v, [max(k / n - eps, 0.0), min(k / n + eps, 1.0)], accuracy) for v, (_, k, n) in zip(cols, picks)]).first()
    counts = df.agg(*[c for v, (lo, hi) in zip(cols, bounds) for c in (F.count_if(v < F.lit(lo)), F.count_if(v <= F.lit(hi)))]).first()
    spans = []
    for v, (_, k, _), (lo, hi), below, upto in zip(cols, picks, bounds, counts[::2], counts[1::2]):
        spans.append((k, v.between(lo, hi), below) if below < k <= upto else (k, v.isNotNull(), 0))
    none = F.lit(None)
    held = [F.when(inside, F.struct(F.lit(i).alias("cut"), (v if w else none).cast("long").alias("whole"), (none if w else v).cast("double").alias("real")))
            for i, (v, w, (_, inside, _)) in enumerate(zip(cols, whole, spans))]
    tally = (df.select(F.explode(F.array(*held)).alias("x")).filter("x is not null")
             .groupBy("x.cut", "x.whole", "x.real").agg(F.count(F.lit(1)).alias("same")))
    upto = F.sum("same").over(Window.partitionBy("cut").orderBy("whole", "real"))
    need = F.element_at(F.array(*[F.lit(k - below) for k, _, below in spans]), F.col("cut") + 1)
    found = {r["cut"]: r for r in tally.withColumn("upto", upto).filter((F.col("upto") >= need) & (F.col("upto") - F.col("same") < need)).collect()}
    return [(found[i]["whole" if whole[i] else "real"], below + found[i]["upto"] - found[i]["same"], found[i]["same"]) for i, (_, _, below) in enumerate(spans)]


def kth_values(df: DataFrame, col: str, ks: list[int], n: int, accuracy: int = 100_000) -> list[tuple]:
    """:func:`kth_many` of one column that has a value in all ``n`` rows."""
    return kth_many(df, [(F.col(col), k, n) for k in ks], accuracy)


# Bytes of a text compared at once: seven and their number fit a long.
CHUNK = 7


def _text_chunk(c, start: int) -> Column:
    """``CHUNK`` bytes of a text from ``start`` on, as a number in the order
    of texts: the bytes, filled up with zeros, then how many there are."""
    part = F.substring(F.col(c).cast("binary"), start + 1, CHUNK)
    return F.conv(F.rpad(F.hex(part), 2 * CHUNK, "0"), 16, 10).cast("long") * 8 + F.octet_length(part)


def kth_text(df: DataFrame, col: str, k: int, n: int) -> str:
    """The k-th smallest of ``n`` texts, without sorting them: the k-th
    smallest first bytes, then among the texts that begin so the next bytes,
    until one text is left or the text ends. Each step is a
    :func:`kth_values` over numbers."""
    rows, start = df.select(col), 0
    while True:
        chunks = rows.withColumn("_chunk", _text_chunk(col, start))
        value, below, same = kth_values(chunks, "_chunk", [k], n)[0]
        rows = chunks.filter(F.col("_chunk") == F.lit(value)).select(col)
        if same == 1 or value % 8 < CHUNK:
            return rows.first()[0]
        k, n, start = k - below, same, start + CHUNK


def kth_keys(df: DataFrame, metric: str, ident: str, ks: list[int], n: int) -> list[tuple]:
    """For each k: the k-th smallest (``metric``, ``ident``) of ``n`` rows,
    ``ident`` telling rows apart, without sorting the table."""
    return kth_keys_of(df, ident, [(metric, k) for k in ks], n)


def kth_keys_of(df: DataFrame, ident: str, wanted: list[tuple[str, int]], n: int) -> list[tuple]:
    """:func:`kth_keys` of several metrics (``metric``, ``k``) in the same
    passes: three for the values and three for the idents among ties."""
    if not wanted:
        return []
    kind = dict(df.dtypes)[ident]
    found = kth_many(df, [(F.col(m), k, n) for m, k in wanted])
    among = [F.when(F.col(m) == F.lit(value), F.col(ident)) for (m, _), (value, _, _) in zip(wanted, found)]
    keys = list(df.agg(*[F.max(c) for c in among]).first())  # right where nothing ties
    tied = [i for i, (_, _, same) in enumerate(found) if same > 1]
    if kind in ("int", "bigint", "smallint", "tinyint", "float", "double"):
        picks = [(among[i], wanted[i][1] - found[i][1], found[i][2]) for i in tied]
        for i, (value, _, _) in zip(tied, kth_many(df, picks) if picks else []):
            keys[i] = value
    else:
        for i in tied:
            (metric, k), (value, below, same) = wanted[i], found[i]
            rows = df.filter(F.col(metric) == F.lit(value)).select(ident)
            keys[i] = kth_text(rows, ident, k - below, same) if kind == "string" else kth_smallest(rows, [ident], k=k - below).first()[0]
    return [(value, key) for (value, _, _), key in zip(found, keys)]

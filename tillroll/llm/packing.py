"""Best-fit packing with linear grouping (operator 1).

Documents become token ids and a closing id, and pieces of at most
``capacity`` tokens. Then, on the histogram of lengths (at most ``capacity``
rows, whatever the corpus holds):

1. the large lengths, sorted, are cut into ``GROUPS`` groups of equal
   cardinality and rounded up to the largest of their group;
2. for these few sizes the best mix of configurations (which sizes share a
   sequence) is found by column generation; its whole part is used as is, the
   few items left over are placed by best fit decreasing;
3. actual documents take the places of their group's rounded sizes;
4. small pieces go, largest first, into the sequence with the least room that
   still takes them. Sequences with equal room are interchangeable, so this
   too is worked out on runs of sequences with equal room.

A few borders between large and small are planned, the best is used.

The driver only sees histograms and the resulting intervals of ranks. Which
document takes which place follows from its rank among the pieces of its
length, which is numbered in Spark (:func:`shared.positions_within`), so a
length held by any share of the rows is no hot spot.

Token ids are those of ``tokenizers`` for ``byte_bpe_50k.json`` without added
special tokens; they are computed by ``tiktoken`` from the same vocabulary as
ranks, which gives the same ids (tested against ``tokenizers``) several times
faster. The string ``<|endoftext|>`` in a text is that token, as there. Runs of
about a million blanks or line feeds are too long for ``tiktoken``'s pattern
engine; a text that holds one gets its ids from ``tokenizers`` itself.

Defined cases: a null text is empty, which is one token, the closing id;
repeated rows are packed each; a null doc_id is kept as null; other columns
are ignored; an empty table gives no rows. A text is read whole.
"""

from __future__ import annotations

import base64
import functools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm.shared import bound_batches, finished, positions_within
from tillroll.plans.lineage import Scratch

CAPACITY = 2_048
CLOSING_ID = 0
GROUPS = 128
# A length is large above capacity / border; the border that needs the fewest sequences is taken.
BORDERS = (2, 3, 4)
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
# The same vocabulary as ``tokenizers`` reads it.
PLAIN = public_tokenizers.path("byte_bpe_50k.json")
# Fixed values of that vocabulary.
SPECIAL = {"<|endoftext|>": 50256}


@functools.lru_cache(maxsize=2)
def encoding(vocabulary: str) -> tiktoken.Encoding:
    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


@functools.lru_cache(maxsize=2)
def tokenizer(plain: str) -> Tokenizer:
    return Tokenizer.from_file(plain)


def text_ids(text: str, vocabulary: str = VOCABULARY, plain: str = PLAIN) -> np.ndarray:
    try:
        return encoding(vocabulary).encode_to_numpy(text, allowed_special="all")
    except ValueError:  # the pattern engine gives up
        return np.array(tokenizer(plain).encode(text, add_special_tokens=False).ids, "<u4")


def _pieces(vocabulary: str, capacity: int, plain: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                row, number, start, ids = [], [], [], []
                for n, text in enumerate(part.column("text").to_pylist()):
                    tokens = np.append(text_ids(text or "", vocabulary, plain), CLOSING_ID).astype("<u4")
                    cuts = [0, *range(len(tokens) % capacity or capacity, len(tokens) + 1, capacity)]
                    for k, (b, e) in enumerate(zip(cuts, cuts[1:])):
                        row.append(n), number.append(k), start.append(b), ids.append(tokens[b:e].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int32())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                     pa.array([len(x) // 4 for x in ids], pa.int32()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])
    return run


def tokenise(docs: DataFrame, scratch: Scratch, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, plain: str = PLAIN) -> DataFrame:
    """Pieces, written: ``uid``, ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids`` (little-endian unsigned 32-bit)."""
    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = docs.select("doc_id", "text").mapInArrow(
        _pieces(vocabulary, capacity, plain), f"doc_id {kind}, piece int, start long, length int, ids binary")
    return scratch.table(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces", compression="zstd")


# ---- what follows works on histograms: at most ``capacity`` rows ----------

def _best_pattern(sizes: list[int], worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack: the multiset of sizes that fits and is worth most."""
    best = np.zeros(capacity + 1)
    copies = np.zeros((len(sizes), capacity + 1), dtype="u2")
    for i, (size, value) in enumerate(zip(sizes, worth)):
        if value <= 1e-12:
            continue
        old = best.copy()
        for c in range(1, capacity // size + 1):
            more = old[:capacity + 1 - c * size] + c * value
            better = more > best[c * size:] + 1e-12
            best[c * size:][better] = more[better]
            copies[i, c * size:][better] = c
    pattern, room = np.zeros(len(sizes)), int(best.argmax())
    for i in range(len(sizes) - 1, -1, -1):
        pattern[i] = copies[i, room]
        room -= int(pattern[i]) * sizes[i]
    return float(best.max()), pattern


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """The mix of patterns that covers ``demand`` with the least sequences,
    fractions allowed: revised simplex, patterns generated as needed."""
    m = len(sizes)
    patterns = [np.eye(m)[i] * (capacity // s) for i, s in enumerate(sizes)]
    inverse = np.diag([1.0 / (capacity // s) for s in sizes])
    amount = inverse @ np.asarray(demand, dtype=float)
    for _ in range(20 * m):
        value, pattern = _best_pattern(sizes, inverse.sum(axis=0), capacity)
        if value <= 1 + 1e-7:
            break
        change = inverse @ pattern
        up = change > 1e-9
        if not up.any():
            break
        leaving = int(np.where(up, amount / np.where(up, change, 1), np.inf).argmin())
        step = amount[leaving] / change[leaving]
        amount = np.maximum(amount - step * change, 0)
        amount[leaving] = step
        inverse[leaving] /= change[leaving]
        others = np.arange(m) != leaving
        inverse[others] -= np.outer(change[others], inverse[leaving])
        patterns[leaving] = pattern
    return list(zip(patterns, amount))


def _best_fit(items: list[int], capacity: int) -> list[list[int]]:
    """Best fit decreasing of a few items; returns item numbers per sequence."""
    by_room: dict[int, list[list[int]]] = defaultdict(list)
    for n in sorted(range(len(items)), key=lambda n: -items[n]):
        room = min((r for r, s in by_room.items() if s and r >= items[n]), default=None)
        held = by_room[room].pop() if room is not None else []
        held.append(n)
        by_room[(capacity if room is None else room) - items[n]].append(held)
    return [held for s in by_room.values() for held in s]


@dataclass
class Share:
    """Ranks ``low`` to ``high`` (excluded) among the pieces of ``length`` go
    round robin into ``count`` sequences from ``first`` on."""
    length: int
    low: int
    high: int
    first: int
    count: int


def plan_large(histogram: dict[int, int], capacity: int, groups: int = GROUPS) -> tuple[list[Share], int]:
    """Places for the large lengths of ``histogram`` and the sequences used."""
    lengths = sorted(histogram, reverse=True)
    total = sum(histogram.values())
    if not total:
        return [], 0
    begins = np.cumsum([0] + [histogram[n] for n in lengths])  # rank of each length's first item
    per_group = -(-total // groups)
    demand: dict[int, int] = defaultdict(int)  # rounded size -> items, largest first
    for rank in range(0, total, per_group):
        size = lengths[int(np.searchsorted(begins, rank, side="right")) - 1]
        demand[size] += min(per_group, total - rank)
    sizes = list(demand)
    starts = dict(zip(sizes, np.cumsum([0] + [demand[s] for s in sizes]).tolist()))  # rank of each size's next item
    left, used = dict(demand), 0
    taken: list[tuple[int, int, int, int]] = []  # first rank, items, first sequence, sequences

    def take(size: int, items: int, first: int, count: int) -> None:
        taken.append((starts[size], items, first, count))
        starts[size] += items
        left[size] -= items

    for pattern, amount in configurations(sizes, [demand[s] for s in sizes], capacity):
        times = int(amount + 1e-9)
        for i in np.flatnonzero(pattern):
            times = min(times, left[sizes[i]] // int(pattern[i]))
        if times:
            for i in np.flatnonzero(pattern):
                take(sizes[i], int(pattern[i]) * times, used, times)
            used += times
    rest = [s for s in sizes for _ in range(left[s])]
    for held in _best_fit(rest, capacity):
        for n in held:
            take(rest[n], 1, used, 1)
        used += 1

    shares = []
    for rank, items, first, count in taken:
        at = rank
        while at < rank + items:
            k = int(np.searchsorted(begins, at, side="right")) - 1
            end = min(rank + items, int(begins[k + 1]))
            turn = (at - rank) % count
            # Round robin from ``turn``: at most one short run up to the last sequence, then whole rounds.
            upto = min(end, at + (count - turn) if turn else end)
            shares.append(Share(lengths[k], at - int(begins[k]), upto - int(begins[k]), first + turn, count if not turn else count - turn))
            at = upto
    return shares, used


def rooms_left(shares: list[Share], used: int, capacity: int) -> list[tuple[int, int, int]]:
    """(room, first sequence, sequences) for runs of sequences with equal room."""
    change: dict[int, int] = defaultdict(int)
    for s in shares:
        each, more = divmod(s.high - s.low, s.count)
        change[s.first] += (each + 1) * s.length
        change[s.first + more] -= s.length
        change[s.first + s.count] -= each * s.length
    edges, room, runs = sorted(k for k in change if k < used), capacity, []
    for first, end in zip(edges, [*edges[1:], used]):
        room -= change[first]
        if end > first:
            runs.append((room, first, end - first))
    return runs


def plan_small(histogram: dict[int, int], runs: list[tuple[int, int, int]], used: int, capacity: int) -> tuple[list[Share], int]:
    """Best fit decreasing of small lengths into ``runs`` of sequences with
    equal room; sequences from ``used`` on are new. Also the number in use."""
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first, count)
    for room, first, count in runs:
        free[room].append((first, count))
    shares: list[Share] = []
    for length in sorted(histogram, reverse=True):
        todo, done = histogram[length], 0

        def put(first: int, count: int, room: int) -> None:
            nonlocal todo, done
            each = room // length
            whole = min(count, todo // each)
            for n, copies in ((whole, each), (1, todo - whole * each if whole < count else 0)):
                if n and copies:
                    shares.append(Share(length, done, done + n * copies, first, n))
                    free[room - copies * length].append((first, n))
                    done, todo, first, count = done + n * copies, todo - n * copies, first + n, count - n
            if count:
                free[room].append((first, count))

        for room in range(length, capacity):
            if not todo:
                break
            runs_here, free[room] = free[room], []
            for n, run in enumerate(runs_here):
                if not todo:
                    free[room] += runs_here[n:]
                    break
                put(*run, room)
        if todo:
            count = -(-todo // (capacity // length))
            put(used, count, capacity)
            used += count
    return shares, used


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[list[Share], int]:
    """Places for every length, and the sequences used: the best of a few
    borders between large and small."""
    full = counts.get(capacity, 0)
    plans = []
    for border in BORDERS:
        large = {n: c for n, c in counts.items() if capacity // border < n < capacity}
        shares, used = plan_large(large, capacity, groups)
        small = {n: c for n, c in counts.items() if n <= capacity // border}
        more, used = plan_small(small, rooms_left(shares, used, capacity), used, capacity)
        plans.append((used, shares + more))
    used, shares = min(plans, key=lambda p: p[0])
    return shares + ([Share(capacity, 0, full, used, full)] if full else []), used + full


# ---- distributed placement -------------------------------------------------

def place(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``uid``, ``sequence_id``, ``offset`` for every row of ``pieces``
    (``uid``, ``length``). The plan is broadcast: its rows are bounded by the
    possible lengths and configurations, not by the corpus."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    shares, _ = plan(counts, capacity, groups)
    ranks = F.broadcast(pieces.sparkSession.createDataFrame(
        [(s.length, s.low, s.high, s.first, s.count) for s in shares], "at_length int, low long, high long, first long, count long"))
    ranked = positions_within(pieces.select("uid", "length"), ["length"], ["uid"], "rank", sum(counts.values()))
    dealt = (ranked.join(ranks, (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
             .select("uid", "length", (F.col("first") + F.pmod(F.col("rank") - F.col("low"), F.col("count"))).alias("sequence_id")))
    inside = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "uid")
    before = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return dealt.select("uid", "sequence_id", F.coalesce(before, F.lit(0)).cast("long").alias("offset"))


@dataclass
class Packing:
    """``pieces`` (with token ids) and their ``places``, joined on ``uid``.
    ``scratch`` holds the pieces; close it once they are read."""
    pieces: DataFrame
    places: DataFrame
    scratch: Scratch

    def sequences(self) -> DataFrame:
        """``sequence_id`` and ``ids``: the packed sequences themselves."""
        parts = self.pieces.select("uid", "ids").join(self.places, "uid")
        ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
        joined = F.concat_ws("", F.transform(ordered, lambda p: F.hex(p["ids"])))
        return parts.groupBy("sequence_id").agg(F.unhex(joined).alias("ids"))


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, groups: int = GROUPS, plain: str = PLAIN) -> Packing:
    scratch = Scratch(docs.sparkSession)
    pieces = tokenise(docs, scratch, vocabulary, capacity, plain)
    return Packing(pieces, place(pieces, capacity, groups), scratch)


def packed_pieces(docs: DataFrame) -> DataFrame:
    """One row per piece: where it comes from, where it went, and the
    checksum of its ids."""
    packing = pack(docs)
    own = packing.pieces.select("uid", "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"))
    placed = own.join(packing.places, "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    return finished(placed, packing.scratch, "packed-pieces")


def op1_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return packed_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""SimHash near-dedup by bit-sliced comparison (operator 9).

A document's fingerprint has a bit set where over half of the XXH64 hashes of
its word shingles have it set. Documents with one fingerprint are one node;
nodes link at ``RADIUS`` or fewer differing bits, and a group is everything
that links reach.

Two fingerprints within 2 bits agree on at least two of their four 16-bit
parts, so each is dealt out under six keys of 32 bits. Inside a key the
fingerprints are stored as 64 vertical bit planes, one machine word holding
one bit of 64 fingerprints. A query's bit XOR a plane adds one to up to 64
distances at a time in a carry-save counter of two planes that overflows just
beyond the radius; words in which all 64 have overflowed are abandoned. A
key with more than ``TILE`` fingerprints is cut into tiles that are compared
pairwise in tasks of their own. Each comparison returns a spanning forest,
never all pairs; components are found by alternating star contraction.

Defined cases: a null text or one without words has fingerprint zero and
links like any other; repeated rows each get a row; a null doc_id never
names a group of others; other columns are ignored; an empty table gives no
rows. Texts are read whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.shared import bound_batches, content_tag, finished, own_names
from tillroll.plans.lineage import Scratch

SHINGLE, RADIUS, SEED = 3, 2, 42
TILE = 2_048
# Fingerprints compared at once, and hashes unpacked to bits at once.
STRIP, UNPACK = 256, 1 << 16
PARTS = [(a, b) for a in range(4) for b in range(a + 1, 4)]


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text, as an unsigned number."""
    words = (text or b"").lower().split()  # bytes: A-Z and the six ASCII white spaces only
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        whole = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]).tolist()
        starts = [0, *ends[:-1]]
        parts = [whole[a:b - 1] for a, b in zip(starts, ends[shingle - 1:])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(p, SEED) for p in parts], dtype="<u8")
    ones = np.zeros(64, dtype="int64")
    for a in range(0, len(hashes), UNPACK):
        ones += np.unpackbits(hashes[a:a + UNPACK].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").cast(pa.binary())
        found = np.array([fingerprint(t.as_py()) for t in texts], dtype="u8").view("i8")
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("tag"), pa.array(found)], names=["doc_id", "tag", "fp"])


def close_pairs(prints: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of fingerprints (uint64) within ``radius`` bits."""
    n = len(prints)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    words = -(-n // 64)
    bits = np.zeros((words * 64, 64), dtype="u1")
    bits[:n] = np.unpackbits(prints.astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
    planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")
    real = np.packbits(np.arange(words * 64) < n, bitorder="little").view("<u8")
    masks = np.where(np.ascontiguousarray(bits[:n].T).astype(bool), full, np.uint64(0))
    size = radius.bit_length()
    begin = (1 << size) - 1 - radius  # so that a counter overflows at radius + 1
    for a in range(0, n, STRIP):
        b, w0 = min(a + STRIP, n), a // 64
        rows, cols = np.divmod(np.arange((b - a) * (words - w0)), words - w0)
        cols += w0
        over = ~real[cols]
        counter = [np.full(len(cols), full if begin >> k & 1 else np.uint64(0)) for k in range(size)]
        for plane in range(64):
            carry = planes[plane][cols] ^ masks[plane][a + rows]
            for k in range(size):
                counter[k], carry = counter[k] ^ carry, counter[k] & carry
            over |= carry
            if plane % 4 == 3:
                live = over != full
                if not live.all():
                    rows, cols, over = rows[live], cols[live], over[live]
                    counter = [c[live] for c in counter]
        if len(rows):
            near = np.unpackbits((~over).astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
            at, bit = np.nonzero(near)
            i, j = a + rows[at], cols[at] * 64 + bit
            yield i[i < j], j[i < j]


def spanning_forest(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the close pairs, at most n - 1 that connect the same fingerprints."""
    pairs = [p for p in close_pairs(prints) if len(p[0])]
    label = np.arange(len(prints))
    if pairs:
        i, j = (np.concatenate(x) for x in zip(*pairs))
        while True:
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, label[i], low)
            np.minimum.at(label, label[j], low)
            label = label[label]
            if (label[i] == label[j]).all():
                break
        while not (label == label[label]).all():
            label = label[label]
    own = np.flatnonzero(label != np.arange(len(label)))
    return prints[own], prints[label[own]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (``grp``, ``fp``) come in order of ``grp``; whole groups are put
    together up to TILE fingerprints and compared."""
    group, prints = np.empty(0, "i8"), np.empty(0, "u8")

    def compare(g: np.ndarray, p: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        sizes = np.diff(np.append(first, len(g)))
        keep = np.repeat(sizes > 1, sizes)
        p, sizes = p[keep], sizes[sizes > 1]
        ends = np.cumsum(sizes)
        at = k = 0
        while k < len(sizes):
            start = at
            k += 1
            while k < len(sizes) and ends[k] - start <= TILE:
                k += 1
            at = int(ends[k - 1])
            a, b = spanning_forest(np.unique(p[start:at]))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view("i8")), pa.array(b.view("i8"))], names=["a", "b"])

    for batch in batches:
        group = np.concatenate([group, batch.column("grp").to_numpy()])
        prints = np.concatenate([prints, batch.column("fp").to_numpy().view("u8")])
        if len(group) and group[0] != group[-1]:
            last = int(np.flatnonzero(group != group[-1])[-1]) + 1
            yield from compare(group[:last], prints[:last])
            group, prints = group[last:], prints[last:]
    if len(group):
        yield from compare(group, prints)


def links(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(``a``, ``b``): pairs of fingerprints of ``nodes`` (``fp``, each once)
    that connect whatever the radius connects; written."""
    part = lambda k: F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))
    keys = F.array(*[F.shiftleft(F.lit(n).cast("long"), 32).bitwiseOR(F.shiftleft(part(a), 16)).bitwiseOR(part(b))
                     for n, (a, b) in enumerate(PARTS)])
    keyed = nodes.select("fp", F.explode(keys).alias("grp"))
    sizes = keyed.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    large = scratch.table(sizes.filter(F.col("n") > TILE).withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int")), "large-keys")
    some = keyed.join(sizes.filter(F.col("n").between(2, TILE)).select("grp"), "grp", "left_semi")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    tiles = (keyed.join(large, "grp").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .select("fp", F.xxhash64("grp", F.least("own", "other"), F.greatest("own", "other")).alias("grp")))
    dealt = some.unionByName(tiles).repartition("grp").sortWithinPartitions("grp")
    return scratch.table(dealt.select("grp", "fp").mapInArrow(_links, "a long, b long").distinct(), "links")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``a``, ``b``) that is
    not its component's smallest. Alternates large-star and small-star steps,
    each a grouped minimum and a join, until the edges stay the same; every
    round is written, so nothing has a long lineage."""
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = scratch.table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "star")
    seen = state(now)
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        met = large.join(lowest, "a")
        small = met.select("a", F.col("m").alias("b")).union(met.select(F.col("b").alias("a"), F.col("m").alias("b"))).filter("a <> b")
        after = scratch.table(small.distinct(), "star")
        scratch.drop(now)
        now, before, seen = after, seen, state(after)
        if seen == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def simhash_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``tag`` (hash of the text), ``fp``
    (64 bits, signed), ``root`` (a fingerprint that names the group) and
    ``component_id``, the smallest doc_id reachable over links."""
    bound_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    prints = scratch.table(docs.select("doc_id", "text", content_tag().alias("tag"))
                           .mapInArrow(_fingerprints, f"doc_id {kind}, tag long, fp long"), "fingerprints")
    nodes = scratch.table(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    found = components(links(nodes.select("fp"), scratch), scratch)
    placed = nodes.join(found, nodes.fp == found.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = scratch.table(placed.join(names, "root").select("fp", "root", "component_id"), "groups")
    return finished(prints.join(named, "fp").select("doc_id", "tag", "fp", "root", "component_id"), scratch, "simhash-groups")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id, of
    rows that share it the one with the smallest text hash, of rows that
    repeat both any one."""
    groups = simhash_groups(docs).groupBy("root", "doc_id", "tag").agg(F.count(F.lit(1)).alias("rows"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag", "rows")
    first = groups.groupBy("root").agg(F.min(order).alias("k"))
    doc, tag, rows = own_names(docs, "k_doc", "k_tag", "k_rows")
    kept = Scratch(docs.sparkSession).table(first.select(
        F.col("k.doc_id").alias(doc), F.col("k.tag").alias(tag), F.col("k.rows").alias(rows)), "kept")
    marked = docs.join(kept, F.col("doc_id").eqNullSafe(F.col(doc)) & (content_tag() == F.col(tag)))
    if not kept.filter(F.col(rows) > 1).isEmpty():  # a kept row is there several times
        marked = marked.filter(F.col(rows) == 1).unionByName(marked.filter(F.col(rows) > 1).dropDuplicates([doc, tag]))
    return marked.drop(doc, tag, rows)


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    groups = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

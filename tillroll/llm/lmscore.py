"""Language-model scoring by cross-entropy difference (operator 3).

Two bigram models, one of text labelled good (target) and one of all text
(background), share one vocabulary, one order and one smoothing. A document's
score is the difference of its losses per token: the lower, the more it is
like the target rather than like the corpus.

Counts are exact and grow with the corpus, those of the target with all its
labelled rows, which meet the documents' ids in a shuffle join. The vocabulary
is every different word of the corpus, and every pair of neighbours has a
count of its own. A document is scored by the counts of all others: its own
words and pairs are taken out of both models first, so that a document of the
target scores like one that is not, and a word that only it has is unseen.

A pair falls back on its second word by a Dirichlet prior of ``PRIOR`` tokens,
a word of the target falls back on the background by one of ``WORD_PRIOR``
tokens, and a word of the background on the even distribution over all
different words. So what no other document holds costs most in both models,
and in the target more than in the background: noise scores worse than text.
What a word's row lacks to one is the end of a text, which is not scored.
Words and pairs are compared by 64-bit hashes, as in operator 6.

The corpus is written once as blocks of about ``BLOCK`` tokens: the block's
different words and, for each token, its place among them. A document is in one block; one
of more than a block's tokens goes on in the next, and each of its parts is
then scored by the counts of all but that part. Each block sends its sorted words, and later its
pairs, with their counts to buckets of the hash range, which hold about
``BUCKET_BYTES`` of text each, however large the corpus. A bucket adds up and
sends every block the totals of what it asked for, and the block's documents
are scored by them. A word or pair reaches its bucket once from a block, so a
very common one is no larger than others.

Defined cases: a null text or one without words has 0 tokens and null losses
and score; rows are scored each, however often repeated; without any labels
the target model is the even one; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.shared import bound_batches, finished, good_ids
from tillroll.plans.lineage import Scratch

PRIOR, WORD_PRIOR, ADDED = 1_000.0, 10.0, 0.5
# Key before those of the words.
BEGIN = 1
# A block ends after so many tokens, or bytes of text.
BLOCK, BLOCK_BYTES = 1 << 21, 1 << 25
# Bytes of one text split into words at once.
CHUNK = 1 << 20
BUCKET_BYTES = 6 << 20
SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
# Kinds of rows that a block gets.
GOOD, WORDS, PAIRS = 0, 1, 2
SLICE = "block long, bucket int, keys binary, counts binary"
TOTALS = "block long, at int, totals binary, words long, target long, background long"


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words in order, of some ``CHUNK`` bytes at a time."""
    at = 0
    while at < len(text):
        gap = SPACE.search(text, at + CHUNK)
        end = gap.start() if gap else len(text)
        yield text[at:end].lower().split()
        at = end


def planes(values: np.ndarray) -> bytes:
    """First bytes of all values, then second ones: high ones are mostly 0."""
    return np.ascontiguousarray(values).view("u1").reshape(-1, values.itemsize).T.tobytes()


def from_planes(held: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(held, "u1").reshape(size, -1).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(held: bytes) -> np.ndarray:
    return np.cumsum(from_planes(held, "<u8"), dtype="u8")


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(block: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.Table:
    """Sorted keys and their (target, background) counts, a row per bucket."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype("i4")
    starts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(starts[1:], len(keys))
    return pa.table({"block": pa.array(np.full(len(starts), block)), "bucket": pa.array(bucket[starts]),
                     "keys": pa.array([packed_keys(keys[a:z]) for a, z in zip(starts, ends)], pa.binary()),
                     "counts": pa.array([planes(counts[a:z].astype("<u4").ravel()) for a, z in zip(starts, ends)], pa.binary())})


def bucket_totals(rows: pa.Table) -> pa.Table:
    """For each slice of a bucket the totals of its keys. The first row also
    has sums over the bucket's words: different ones, and all occurrences in
    both models."""
    keys = [unpacked_keys(k) for k in rows.column("keys").to_pylist()]
    counts = np.concatenate([from_planes(c, "<u4") for c in rows.column("counts").to_pylist()]).reshape(-1, 2)
    every, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.column_stack([np.bincount(at, counts[:, m], len(every)) for m in (0, 1)]).astype("<i8")
    totals = np.split(sums[at], np.cumsum([len(k) for k in keys])[:-1])
    word = every != BEGIN
    stats = [word.sum(), *sums[word].sum(axis=0)]
    return pa.table({"block": rows.column("block"), "at": rows.column("bucket"), "totals": pa.array([planes(t.ravel()) for t in totals], pa.binary()),
                     **{name: pa.array([int(s)] + [0] * (len(keys) - 1), pa.int64()) for name, s in zip(("words", "target", "background"), stats)}})


def written_blocks(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` as blocks: ``keys`` of the different words, sorted after
    ``BEGIN``; ``tokens``, places in ``keys`` of each piece's words after the
    one before them; ``doc_ids``, ``rows`` and ``lengths`` of the pieces. A
    row's number is the same in all its pieces."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        made = row = 0
        places: defaultdict = defaultdict()
        places.default_factory = places.__len__  # a new word gets the next number
        ids: list = []
        numbers: list = []
        lengths: list = []
        tokens: list = []
        held = size = own = 0

        def block() -> pa.RecordBatch:
            nonlocal made, held, size
            hashed = np.frombuffer(b"".join(blake2b(w, digest_size=8).digest() for w in places), "<u8")
            keys, at = np.unique(np.maximum(hashed, BEGIN + 1), return_inverse=True)
            at = np.append(at + 1, 0).astype("<u4")  # BEGIN is -1 until here
            out = pa.RecordBatch.from_arrays(
                [pa.array([base + made], pa.int64()), pa.array([ids], pa.list_(kind)), pa.array([numbers], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int32())),
                 pa.array([pa.compress(planes(at[np.concatenate(tokens)]), "zstd", asbytes=True)], pa.binary()),
                 pa.array([packed_keys(np.append(np.uint64(BEGIN), keys))], pa.binary())],
                names=["block", "doc_ids", "rows", "lengths", "tokens", "keys"])
            made += 1
            held = size = 0
            for x in (places, ids, numbers, lengths, tokens):
                x.clear()
            return out

        for b in batches:
            kind = b.schema.field("doc_id").type
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary())):
                before = None
                if ids and size + len(text.as_py() or b"") >= BLOCK_BYTES:
                    yield block()
                for part in words(text.as_py() or b"") if text.as_py() else [[]]:
                    ids.append(doc_id), numbers.append(base + row), lengths.append(len(part))
                    tokens.append(np.array([-1 if before is None else places[before], *map(places.__getitem__, part)]))
                    before = part[-1] if part else before
                    held, size, own = held + len(part) + 1, size + sum(map(len, part)) + len(part), own + len(part)
                    if own >= BLOCK or size >= BLOCK_BYTES:  # more than a block by itself
                        yield block()
                        own = 0
                row, own = row + 1, 0
                if held >= BLOCK:
                    yield block()
        if ids:
            yield block()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"block long, doc_ids array<{id_type}>, rows array<long>, lengths array<int>, tokens binary, keys binary"
    return scratch.table(docs.select("doc_id", "text").mapInArrow(cut, schema), "blocks", compression="zstd")


class Opened:
    """A block with what it has got so far."""

    def __init__(self, block: pa.Table, got: pa.Table):
        self.row = {name: block.column(name)[0] for name in block.column_names}
        self.number = self.row["block"].as_py()
        self.lengths = self.row["lengths"].values.to_numpy()
        self.keys = unpacked_keys(self.row["keys"].as_py())
        size = 4 * int((self.lengths + 1).sum())
        self.tokens = from_planes(pa.decompress(self.row["tokens"].as_py(), size, "zstd", asbytes=True), "<u4")
        self.first = np.cumsum(self.lengths + 1) - self.lengths - 1  # the place before each piece
        own = np.ones(len(self.tokens), dtype=bool)
        own[self.first] = False
        self.at = np.flatnonzero(own)
        self.kind, self.place = got.column("kind").to_numpy(), got.column("at").to_numpy()
        self.held = got.column("totals")
        self.good = np.zeros(len(self.lengths), dtype=bool)
        self.good[self.place[self.kind == GOOD]] = True

    def totals(self, kind: int) -> np.ndarray:
        """(target, background) totals, in the order of the keys sent."""
        rows = np.flatnonzero(self.kind == kind)
        parts = [from_planes(self.held[int(r)].as_py(), "<i8") for r in rows[np.argsort(self.place[rows])]]
        return np.concatenate(parts or [np.zeros(0, "<i8")]).reshape(-1, 2)

    def counts(self, at: np.ndarray, size: int, good: np.ndarray) -> np.ndarray:
        return np.column_stack([np.bincount(at[good], minlength=size), np.bincount(at, minlength=size)])

    def word_counts(self) -> np.ndarray:
        begins = self.first[self.tokens[self.first] == 0]
        good = np.repeat(self.good, self.lengths)
        return (self.counts(self.tokens[self.at], len(self.keys), good)
                + self.counts(self.tokens[begins], len(self.keys), self.good[self.tokens[self.first] == 0]))

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of the different pairs, and each token's place there.
        A pair with a word that occurs once occurs once itself: no other
        document holds it, it has no key and its place is -1."""
        known = self.totals(WORDS)[:, 1] > 1
        known[0] = True
        first, second = self.tokens[self.at - 1], self.tokens[self.at]
        asked = known[first] & known[second]
        keys, places = np.unique(pair_keys(self.keys[first[asked]], self.keys[second[asked]]), return_inverse=True)
        at = np.full(len(self.at), -1)
        at[asked] = places
        return keys, at

    def row_of(self) -> np.ndarray:
        """Number, inside the block, of each piece's document."""
        return np.unique(self.row["rows"].values.to_numpy(), return_inverse=True)[1]


def own_counts(row: np.ndarray, key: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """How often the row of each entry has its key, among entries ``counted``."""
    _, at = np.unique(row * (int(key.max(initial=0)) + 1) + key, return_inverse=True)
    return np.bincount(at[counted], minlength=len(at))[at]


def cross_entropy_difference(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, ``target_loss``,
    ``background_loss`` (per token) and ``score``, their difference."""
    spark = docs.sparkSession
    bound_batches(spark)
    scratch = Scratch(spark)
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Several buckets a task even out what tasks get.
    buckets = max(-(-n_bytes // BUCKET_BYTES), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = written_blocks(docs, scratch)
    ids = good_ids(labels).select(F.col("doc_id").alias("_good")).hint("merge")  # grows with the labels
    pieces = blocks.select("block", F.posexplode("doc_ids").alias("at", "doc_id"))
    good = scratch.table(pieces.join(ids, F.col("doc_id") == F.col("_good")).select("block", "at"), "good-pieces")
    nothing = F.lit(None).cast("binary").alias("totals")
    got = good.select("block", F.lit(GOOD).alias("kind"), "at", nothing)

    def per_block(more: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        return blocks.groupBy("block").cogroup(more.groupBy("block")).applyInArrow(run, schema)

    def send_words(block: pa.Table, more: pa.Table) -> pa.Table:
        b = Opened(block, more)
        return slices(b.number, b.keys, b.word_counts(), buckets)

    word_totals = scratch.table(per_block(got, send_words, SLICE).groupBy("bucket").applyInArrow(bucket_totals, TOTALS), "word-totals", compression="zstd")
    names = ("words", "target", "background")
    n_words, *n_tokens = (x or 0 for x in word_totals.agg(*[F.sum(name) for name in names]).first())
    got = got.unionByName(word_totals.select("block", F.lit(WORDS).alias("kind"), "at", "totals"))

    def send_pairs(block: pa.Table, more: pa.Table) -> pa.Table:
        b = Opened(block, more)
        keys, at = b.pairs()
        asked = at >= 0
        return slices(b.number, keys, b.counts(at[asked], len(keys), np.repeat(b.good, b.lengths)[asked]), buckets)

    pair_totals = per_block(got, send_pairs, SLICE).groupBy("bucket").applyInArrow(bucket_totals, TOTALS)
    got = got.unionByName(pair_totals.select("block", F.lit(PAIRS).alias("kind"), "at", "totals"))

    def score(block: pa.Table, more: pa.Table) -> pa.Table:
        b = Opened(block, more)
        _, at = b.pairs()
        row = b.row_of()
        token_row = np.repeat(row, b.lengths)
        # What a document adds itself: to its words, those before them and their pairs; to the target only if it is there.
        counted = np.zeros(len(b.tokens), bool)
        counted[b.at] = True
        begins = b.first[b.tokens[b.first] == 0]
        counted[begins] = True
        own_word = own_counts(np.repeat(row, b.lengths + 1), b.tokens.astype("i8"), counted)
        asked = at >= 0
        own_pair = np.zeros(len(at), "i8")
        own_pair[asked] = own_counts(token_row[asked], at[asked], np.ones(int(asked.sum()), bool))
        length = np.bincount(token_row, minlength=int(row.max(initial=0)) + 1)[token_row]
        good = np.repeat(b.good, b.lengths)
        word, pair = b.totals(WORDS), np.vstack([b.totals(PAIRS), np.zeros((1, 2), "i8")])
        piece = np.repeat(np.arange(len(b.lengths)), b.lengths)
        sums, alone = {}, ADDED / (ADDED * n_words) if n_words else 0.0
        for m, prior, in_model in ((1, ADDED * n_words, True), (0, WORD_PRIOR, good)):  # the background, then the target on top of it
            own, last = (word[b.tokens[x], m] - own_word[x] * in_model for x in (b.at, b.at - 1))
            alone = (own + prior * alone) / (n_tokens[m] - length * in_model + prior)
            likely = (pair[at, m] - own_pair * in_model + PRIOR * alone) / (last + PRIOR)
            sums[m] = np.bincount(piece, -np.log(likely), len(b.lengths))
        return pa.table({"row": b.row["rows"].values, "doc_id": b.row["doc_ids"].values, "n": pa.array(b.lengths.astype("i8")),
                         "target": pa.array(sums[0]), "background": pa.array(sums[1])})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = (per_block(got, score, f"row long, doc_id {id_type}, n long, target double, background double")
              .groupBy("row", "doc_id").agg(F.sum("n").alias("n_tokens"), F.sum("target").alias("t"), F.sum("background").alias("b")))
    n = F.nullif(F.col("n_tokens"), F.lit(0))
    lost = scored.select("doc_id", "n_tokens", (F.col("t") / n).alias("target_loss"), (F.col("b") / n).alias("background_loss"))
    return finished(lost.withColumn("score", F.col("target_loss") - F.col("background_loss")), scratch, "scores")


def op3_cross_entropy_difference(spark, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

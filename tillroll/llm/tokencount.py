"""Token counts by rank-synchronous array merging (operator 11).

Counts the tokens that a byte-level BPE vocabulary gives each text, without
making the tokens. The texts of a batch are one array of code points; classes
of code points (letter, number, white space, other) give the borders of all
pre-tokens at once. Pre-tokens not met before become ragged arrays: one array
of symbol ids and one of the sequence each symbol belongs to. In a round
every sequence merges all places of its own lowest-ranked pair, all sequences
at the same time; a sequence without a pair to merge leaves with the count of
its surviving symbols. A batch needs as many rounds as its hardest pre-token.

Pre-tokens above ``LONG`` bytes would need many rounds over many symbols.
They are merged together in the order of ranks on linked arrays, so a round
only touches the places of its pair: a merge never makes a pair of a lower
rank (checked when the vocabulary is read), so both orders are the same.

The counts equal those of ``tokenizers`` for the same file without added
special tokens: texts are cut at the strings of the file's added tokens, each
of which is one token, and classes of code points come from that library's
own patterns.

Texts are worked on ``CHUNK`` code points at a time; a longer text is cut
where white space follows something else, which is a border of pre-tokens
anyway. A text without such a place is worked on whole. Counts of up to
``CACHED`` short pre-tokens are kept by a worker.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted each; a null doc_id stays null; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers

from tillroll.llm.shared import bound_batches

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
LONG = 256
CHUNK = 1 << 20
CACHED = 1 << 19
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# Fixed values of the pre-token pattern: what may follow an apostrophe.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")
# Where a text may be cut: a blank or line feed after something that is no white space.
GAP = re.compile(r"(?<=\S)[ \n]")
NONE = np.iinfo("i4").max


@dataclass
class Merges:
    """A vocabulary's merges: ``keys`` sorted with their ``ranks``; what the
    pair of a rank consists of and becomes; the id of each byte."""
    keys: np.ndarray
    ranks: np.ndarray
    left: np.ndarray
    right: np.ndarray
    made: np.ndarray
    byte_id: np.ndarray
    size: int
    added: re.Pattern | None
    cache: dict[bytes, int]

    def lookup(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where the vocabulary has no such pair."""
        wanted = first.astype("i8") * self.size + second
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)


def byte_letters() -> list[str]:
    """The letter by which a byte-level vocabulary file writes each byte:
    printable Latin-1 as it is, the others from code point 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def merges(vocabulary: str) -> Merges:
    with open(vocabulary, encoding="utf-8") as f:
        held = json.load(f)
    ids = held["model"]["vocab"]
    pairs = [p if isinstance(p, list) else p.split(" ") for p in held["model"]["merges"]]
    left, right, made = (np.array(x, "i4") for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in pairs)))
    size = max(ids.values()) + 1
    born = np.full(size, -1)
    born[made] = np.arange(len(pairs))
    if (np.maximum(born[left], born[right]) >= np.arange(len(pairs))).any():
        raise ValueError("a merge uses a symbol that a later merge makes")
    keys = left.astype("i8") * size + right
    order = np.argsort(keys)
    added = [re.escape(t["content"]) for t in held["added_tokens"]]
    return Merges(keys[order], order.astype("i4"), left, right, made, np.array([ids[c] for c in byte_letters()], "i4"), size,
                  re.compile("|".join(added)) if added else None, {})


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point, by the tokenizer library's patterns."""
    points = np.array([*range(0xD800), *range(0xE000, 0x110000)], "u4")
    every = points.tobytes().decode("utf-32-le")
    kinds = np.zeros(0x110000, "u1")
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        rest = normalizers.Replace(Regex(pattern), "").normalize_str(every)
        is_kind = np.ones(0x110000, bool)
        is_kind[np.frombuffer(rest.encode("utf-32-le"), "<u4")] = False
        is_kind[0xD800:0xE000] = False
        kinds[is_kind] = kind
    return kinds


def pretoken_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where pre-tokens start; ``first`` marks the first point of each part."""
    kind = classes()[points]
    starts = first.copy()
    starts[1:] |= kind[1:] != kind[:-1]
    # The last of several white spaces before something else stands alone, or goes with it if it is a blank.
    after = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:]) + 1
    starts[after - 1] = True
    starts[after] = points[after - 1] != 0x20
    # A contraction: an apostrophe that starts a pre-token and stands alone before letters.
    mark = np.flatnonzero((points[:-1] == 0x27) & starts[:-1] & (kind[1:] == LETTER) & ~first[1:])
    for ending in CONTRACTIONS:
        at = mark[mark + len(ending) < len(points)]
        for n, letter in enumerate(ending, 1):
            at = at[(points[at + n] == ord(letter)) & ~first[at + n]]
        starts[at + 1] = False
        end = at + 1 + len(ending)
        starts[end[end < len(points)]] = True
    return starts


def _alternate(hit: np.ndarray) -> np.ndarray:
    """Of neighbouring hits (equal symbols in a row) the 1st, 3rd, ... of each run."""
    at = np.flatnonzero(hit)
    begins = np.diff(at, prepend=-2) > 1
    return at[(at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0]


def merge_together(table: Merges, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Symbols left of each sequence: in a round all sequences merge their
    lowest-ranked pair."""
    left = lengths.copy()
    owner = np.repeat(np.arange(len(lengths)), lengths)
    rank = np.full(len(ids), NONE, "i4")
    rank[:-1] = np.where(owner[:-1] == owner[1:], table.lookup(ids[:-1], ids[1:]), NONE)
    while len(ids):
        begin = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(begin, append=len(ids))
        best = np.minimum.reduceat(rank, begin)
        left[owner[begin]] = sizes
        lowest = np.repeat(best, sizes)
        live = lowest < NONE
        at = _alternate(live & (rank == lowest))
        if not len(at):
            break
        ids[at] = table.made[rank[at]]
        live[at + 1] = False
        changed = np.zeros(len(ids), bool)
        changed[at] = True
        ids, owner, rank, changed = ids[live], owner[live], rank[live], changed[live]
        changed[:-1] |= changed[1:]
        again = np.flatnonzero(changed)
        inner = again[again + 1 < len(ids)]
        rank[again] = NONE
        rank[inner] = np.where(owner[inner] == owner[inner + 1], table.lookup(ids[inner], ids[inner + 1]), NONE)
    return left


def merge_in_order(table: Merges, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The same for long sequences: one rank after the other, for all
    sequences together, on linked arrays."""
    n = len(ids)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    last = np.cumsum(lengths) - 1
    after[last] = -1
    before[last - lengths + 1] = -1
    alive = np.ones(n, bool)
    waiting: dict[int, list[np.ndarray]] = defaultdict(list)
    heap: list[int] = []

    def wait(at: np.ndarray) -> None:
        at = at[after[at] >= 0]
        rank = table.lookup(ids[at], ids[after[at]])
        at, rank = at[rank < NONE], rank[rank < NONE]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        begin = np.flatnonzero(np.diff(rank, prepend=-1))
        for r, places in zip(rank[begin].tolist(), np.split(at, begin[1:])):
            if r not in waiting:
                heapq.heappush(heap, r)
            waiting[r].append(places)

    wait(np.arange(n))
    while heap:
        r = heapq.heappop(heap)
        at = np.unique(np.concatenate(waiting.pop(r)))
        follow = after[at]
        at = at[alive[at] & (ids[at] == table.left[r]) & (follow >= 0) & (ids[follow] == table.right[r])]
        if not len(at):
            continue
        if table.left[r] == table.right[r]:
            joined = np.append(False, after[at[:-1]] == at[1:])
            number = np.arange(len(at))
            at = at[(number - np.maximum.accumulate(np.where(joined, 0, number))) % 2 == 0]
        gone = after[at]
        ids[at], alive[gone], after[at] = table.made[r], False, after[gone]
        inner = at[after[at] >= 0]
        before[after[inner]] = inner
        wait(np.unique(np.concatenate([at, before[at][before[at] >= 0]])))
    return np.bincount(owner[alive], minlength=len(lengths))


def pretoken_counts(table: Merges, pieces: list[bytes]) -> list[int]:
    """Tokens of each of some different pre-tokens."""
    lengths = np.fromiter(map(len, pieces), "i8", len(pieces))
    out = np.zeros(len(pieces), "i8")
    for merge, some in ((merge_together, np.flatnonzero(lengths <= LONG)), (merge_in_order, np.flatnonzero(lengths > LONG))):
        if len(some):
            ids = table.byte_id[np.frombuffer(b"".join([pieces[i] for i in some]), "u1")]
            out[some] = merge(table, ids, lengths[some])
    return out.tolist()


def part_counts(table: Merges, parts: list[str]) -> np.ndarray:
    """Tokens of each part, a text without added tokens."""
    sizes = np.fromiter(map(len, parts), "i8", len(parts))
    text = "".join(parts)
    if not text:
        return np.zeros(len(parts), "i8")
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    ends = np.cumsum(sizes)
    first = np.zeros(len(points), bool)
    first[(ends - sizes)[sizes > 0]] = True
    starts = np.flatnonzero(pretoken_starts(points, first))
    width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    at = np.append(0, np.cumsum(width))[starts].tolist()
    data, cache = text.encode(), table.cache
    pieces = [data[a:z] for a, z in zip(at, [*at[1:], len(data)])]
    new = set(pieces).difference(cache)
    if len(cache) + len(new) > CACHED:
        cache.clear()
        new = set(pieces)
    new = list(new)
    cache.update(zip(new, pretoken_counts(table, new)))
    so_far = np.append(0, np.cumsum(np.fromiter(map(cache.__getitem__, pieces), "i8", len(pieces))))
    for piece in new:
        if len(piece) > LONG:
            del cache[piece]
    return so_far[np.searchsorted(starts, ends)] - so_far[np.searchsorted(starts, ends - sizes)]


def cut_text(text: str) -> Iterator[str]:
    """A text in parts of some ``CHUNK`` code points, cut between pre-tokens."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + CHUNK)
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


def token_counts(texts: list[str | None], vocabulary: str) -> np.ndarray:
    """Tokens of each text."""
    table = merges(vocabulary)
    out = np.zeros(len(texts), "i8")
    parts: list[str] = []
    owner: list[int] = []
    held = 0

    def flush() -> None:
        nonlocal held
        np.add.at(out, owner, part_counts(table, parts))
        parts.clear(), owner.clear()
        held = 0

    for n, text in enumerate(texts):
        between = table.added.split(text) if text and table.added else [text or ""]
        out[n] = len(between) - 1
        for part in between:
            for piece in cut_text(part):
                parts.append(piece), owner.append(n)
                held += len(piece)
                if held >= CHUNK:
                    flush()
    flush()
    return out


def counted(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of every row of
    ``docs`` (``doc_id``, ``text``)."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_tokens = token_counts(b.column("text").to_pylist(), path)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n_tokens)], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    sent = docs.select("doc_id", n_bytes, "text")
    return (sent.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))


def op11_token_counts(spark, sf_dir: str) -> DataFrame:
    return counted(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Packing: ids against tokenizers, places against the rules and best fit."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from brute import awkward_rows, docs_frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillroll.llm import packing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_tokenizers(text):
    assert packing.encoding(packing.VOCABULARY).encode(text, allowed_special="all") + [0] == ids_of(text)


@pytest.mark.parametrize("text", ["a<|endoftext|>b", " <|endoftext|>", "<|endoftext", "  \n\n x", "it's 'S", "\u0085　﻿ x", "1" * 5000, " " * 5000 + "x"])
def test_special_and_odd_texts(text):
    assert packing.encoding(packing.VOCABULARY).encode(text, allowed_special="all") + [0] == ids_of(text)


@pytest.mark.parametrize("gap", [" ", "\n", "\t", " \n\t "])
@pytest.mark.parametrize("around", [("", ""), ("first", "last")])
def test_very_long_runs_of_white_space(gap, around):
    text = around[0] + gap * (2_000_000 // len(gap)) + around[1]
    assert packing.text_ids(text).tolist() + [0] == ids_of(text)


def best_fit_decreasing(lengths, capacity):
    room, n = [0] * (capacity + 1), 0
    for x in sorted(lengths, reverse=True):
        at = next((r for r in range(x, capacity + 1) if room[r]), None)
        if at is None:
            n, at = n + 1, capacity
        else:
            room[at] -= 1
        room[at - x] += 1
    return n


R = np.random.default_rng(0)
LENGTHS = {
    "uniform": R.integers(1, 257, 1500), "thirds": np.full(100, 80), "halves": R.integers(100, 140, 400), "small": R.integers(1, 12, 500),
    "large": R.integers(130, 257, 300), "one": [5], "none": [], "mixed": np.concatenate([R.integers(75, 100, 300), R.integers(1, 20, 100), np.full(20, 256)]),
}


@pytest.mark.parametrize("name", LENGTHS)
def test_plan_places_every_length_once(name):
    counts = Counter(int(x) for x in LENGTHS[name])
    shares, used = packing.plan(counts, 256, groups=24)
    load, ranks = np.zeros(used, int), {n: [] for n in counts}
    for s in shares:
        for i in range(s.low, s.high):
            load[s.first + (i - s.low) % s.count] += s.length
            ranks[s.length].append(i)
    assert {n: list(range(c)) for n, c in counts.items()} == {n: sorted(r) for n, r in ranks.items()}
    assert not used or (load.max() <= 256 and load.min() > 0)
    assert used <= best_fit_decreasing(LENGTHS[name], 256) + 1


def check(spark, rows):
    docs = docs_frame(spark, rows)
    packed = packing.pack(docs)
    got = packed.pieces.join(packed.places, "uid").collect()
    texts = {}
    for r in got:
        texts.setdefault((r["doc_id"], r["uid"] - r["piece"]), []).append(r)
    joined = []
    for (i, _), parts in texts.items():
        parts.sort(key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(len(parts)))
        assert [p["start"] for p in parts] == np.cumsum([0] + [p["length"] for p in parts])[:-1].tolist()
        assert all(p["length"] == 2048 for p in parts[1:]) and all(1 <= p["length"] <= 2048 for p in parts)
        joined.append((i, b"".join(p["ids"] for p in parts)))
    want = Counter((i, np.array(ids_of(t), "<u4").tobytes()) for i, t, _ in rows)
    assert Counter(joined) == want
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packed.sequences().collect()}
    for r in got:
        a = 4 * r["offset"]
        assert whole[r["sequence_id"]][a:a + 4 * r["length"]] == bytes(r["ids"])
    for s, ids in whole.items():
        assert len(ids) == 4 * sum(r["length"] for r in got if r["sequence_id"] == s) <= 4 * 2048
    sums = Counter((r["doc_id"], r["length"], r["ids_crc32"]) for r in packing.packed_pieces(docs).collect())
    assert sums == Counter((r["doc_id"], r["length"], zlib.crc32(r["ids"])) for r in got)
    return len(whole), -(-sum(len(b) // 4 for b in whole.values()) // 2048)


def test_awkward_documents(spark):
    check(spark, awkward_rows() + [(70, "x" + " " * 1_100_000 + "y", "en"), (71, "\n" * 1_100_000, "en")])


def test_many_documents(spark):
    r = np.random.default_rng(1)
    rows = [(k, " ".join(map(str, r.integers(0, 500, r.integers(1, 1500)))), "en") for k in range(150)]
    used, least = check(spark, rows)
    assert used <= least + 3


def test_empty_table(spark):
    assert packing.packed_pieces(docs_frame(spark, [])).count() == 0

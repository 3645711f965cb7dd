"""Token counts against the tokenizers library."""

import sys

import numpy as np
import public_tokenizers
import pytest
from brute import awkward_rows, docs_frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillroll.llm import tokencount

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ODD = ["a<|endoftext|>b", " <|endoftext|> ", "<|endoftext|><|endoftext|>", "<|endoftext", "  \n\n x", " \n", "x  ", "it's 'S 's's ''s '", "I'll we've 'tis 'r 're'",
       "a'd<|endoftext|>'s", "'l'l'll 'll", "\u0085　﻿ x", "don't  'stop", "x\n's", "1'm2've", "\x1c\x1d a\x1f", "é'sé ñ'll", "\U0001f600\U0001f600 \U0001f468‍\U0001f469"]


def want(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


def got(texts):
    return tokencount.token_counts(texts, PATH).tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=80), st.text(alphabet="ab 's\n'tlrevmd1.é一", max_size=80)), max_size=6))
def test_random_texts(texts):
    assert got(texts) == [want(t) for t in texts]


def test_odd_texts():
    assert got(ODD) == [want(t) for t in ODD]
    assert got([None, "", None]) == [0, 0, 0] and got([]) == []


def test_every_code_point():
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    texts = ["a" + c + "1" + c + " " + c + "." + c for c in points[::7]] + ["".join(points[a:a + 64]) for a in range(0, len(points), 640)]
    assert got(texts) == [len(e.ids) for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("alphabet", ["a", "ab", "etaoin", "abcdefghijklmnopqrstuvwxyz", "=-", " ", "\n ", "一二三人"])
def test_both_orders_of_merging(alphabet):
    """Sequences above and below ``LONG`` go different ways."""
    r = np.random.default_rng(len(alphabet))
    texts = ["".join(r.choice(list(alphabet), n)) for n in (1, 2, 3, 50, 255, 256, 257, 258, 3000, 20_000)]
    assert got(texts) == [want(t) for t in texts]
    table = tokencount.merges(PATH)
    pieces = [t.encode() for t in texts[:8]]
    ids = lambda: table.byte_id[np.frombuffer(b"".join(pieces), "u1")]
    sizes = np.array([len(p) for p in pieces])
    assert tokencount.merge_together(table, ids(), sizes).tolist() == tokencount.merge_in_order(table, ids(), sizes).tolist()


def test_texts_longer_than_a_chunk(monkeypatch):
    monkeypatch.setattr(tokencount, "CHUNK", 50)
    r = np.random.default_rng(5)
    texts = [" ".join("".join(r.choice(list("abc'st1.\n \u0085　"), r.integers(0, 9))) for _ in range(60)) for _ in range(40)]
    assert got(texts) == [want(t) for t in texts]


def test_cache_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokencount, "CACHED", 40)
    tokencount.merges(PATH).cache.clear()
    for k in range(20):
        texts = [f"w{k}x{j} " + "q" * 300 for j in range(7)]
        assert got(texts) == [want(t) for t in texts]
        assert len(tokencount.merges(PATH).cache) <= 40 + 60


@pytest.mark.parametrize("text", [" " * 2_000_000 + "x", "\n" * 1_500_000, "ab" * 700_000, "x" + "\t" * 1_200_000], ids=["blanks", "feeds", "letters", "tabs"])
def test_very_long_runs(text):
    assert got([text]) == [want(text)]


def test_a_vocabulary_out_of_order_is_refused(tmp_path):
    path = tmp_path / "v.json"
    path.write_text('{"added_tokens": [], "model": {"vocab": {"a": 0, "b": 1, "ab": 2, "aab": 3}, "merges": [["a", "ab"], ["a", "b"]]}}')
    with pytest.raises(ValueError):
        tokencount.merges(str(path))


def test_operator(spark):
    rows = awkward_rows() + [(90 + k, t, "en") for k, t in enumerate(ODD)]
    out = tokencount.counted(docs_frame(spark, rows)).collect()
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, out), key=key) == sorted(
        ((i, len((t or "").encode()), want(t), want(t) > 512) for i, t, _ in rows), key=key)
    assert tokencount.counted(docs_frame(spark, [])).count() == 0


def test_query_over_a_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    out = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokencount.op11_token_counts(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert out == {r["doc_id"]: (len((r["text"] or "").encode()), n := want(r["text"]), n > 512) for r in rows}

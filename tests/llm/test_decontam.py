"""The positional index against plain Python."""

import random
from collections import Counter

import numpy as np
import pytest
from brute import awkward_rows, contamination, docs_frame, words

from pyspark.sql import functions as F

from tillroll.llm import decontam
from tillroll.plans.lineage import Scratch

ITEM_SCHEMA = "item_id long, text string, wid string, term int"


def items_frame(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], ITEM_SCHEMA)


def found(spark, rows, items):
    docs = docs_frame(spark, rows)
    got = decontam.contamination(docs.select("doc_id", "text"), items_frame(spark, items))
    full = docs.select("doc_id", *decontam.doc_key()).join(got, decontam.DOC, "left")
    return Counter((r["doc_id"], r["n_words"] or 0, r["n_hit"] or 0, tuple(r["items"] or ())) for r in full.collect())


def expected(rows, items):
    return Counter((i, n, h, tuple(x)) for i, n, h, x in contamination(rows, items))


def corpus(seed, n_docs=60, vocab=12):
    r = random.Random(seed)
    word = [f"w{k}" for k in range(vocab)]
    items = [(k, " ".join(r.choices(word, k=r.choice([1, 2, 3, 9, 10, 11, 25])))) for k in range(12)]
    rows = []
    for d in range(n_docs):
        text = " ".join(r.choices(word, k=r.randrange(0, 60)))
        if d % 3 == 0:
            text += " " + r.choice(items)[1].upper().replace(" ", ", ") + ". " + " ".join(r.choices(word, k=5))
        rows.append((d, text, "en"))
    return rows, items


@pytest.mark.parametrize("seed", [0, 1])
def test_small_vocabulary_with_many_partial_matches(spark, seed):
    rows, items = corpus(seed)
    rows += [rows[0], rows[3], (3, rows[0][1], "en"), (None, rows[0][1], "en")]
    assert found(spark, rows, items) == expected(rows, items)


def test_shuffled_terms_instead_of_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_TERMS", 0)
    rows, items = corpus(2, n_docs=20)
    assert found(spark, rows, items) == expected(rows, items)


def test_awkward_documents_and_items(spark):
    rows = awkward_rows()
    items = [(1, None), (2, ""), (3, "..."), (None, "same text in several rows here"), (5, " ".join(f"WORD{k}" for k in range(960, 977))),
             (5, "no id"), (6, "x" * 200_000), (7, "word976 word0 word1"), (7, "word976 word0 word1"), (8, "never there at all")]
    assert found(spark, rows, items) == expected(rows, items)


def test_empty_tables(spark):
    rows, items = awkward_rows()[:3], [(1, "same text")]
    assert found(spark, rows, [])[(2, 0, 0, ())] == 1
    assert found(spark, [], items) == Counter()


def test_proximity(spark):
    rows = [(1, "alpha x x beta x gamma", "en"), (2, "gamma beta alpha", "en"), (3, "alpha x x x x x x x x beta gamma", "en"), (4, "alpha beta", "en")]
    scratch = Scratch(spark)
    index = decontam.build_index(docs_frame(spark, rows), scratch)
    windows, _ = decontam.item_windows(items_frame(spark, [(1, "alpha beta gamma")]), scratch)
    got = decontam.proximity_matches(index, windows, scratch, within=6, rarest=3).select("d1", "first", "last")
    names = {r["d1"]: r["doc_id"] for r in docs_frame(spark, rows).select("doc_id", *decontam.doc_key()).collect()}
    want = set()
    for i, t, _ in rows:
        ws = words(t)
        for s, w in enumerate(ws):
            near = [k for k in range(s, min(s + 6, len(ws))) if ws[k] in ("alpha", "beta", "gamma")]
            if w in ("alpha", "beta", "gamma") and {ws[k] for k in near} == {"alpha", "beta", "gamma"}:
                want.add((i, s, max(near)))
    assert {(names[r["d1"]], r["first"], r["last"]) for r in got.collect()} == want


def test_proximity_without_a_word_the_corpus_lacks(spark):
    """A copied passage with one word replaced, of an item shorter and one longer than a window."""
    passage = [f"p{k}" for k in range(14)]
    rows = [(1, " ".join(passage), "en"), (2, "other words", "en")]
    items = [(1, " ".join([*passage[:4], "absent", *passage[5:9]])), (2, " ".join([*passage[:7], "missing", *passage[8:]]))]
    scratch = Scratch(spark)
    index = decontam.build_index(docs_frame(spark, rows), scratch)
    windows, window_items = decontam.item_windows(items_frame(spark, items), scratch)
    got = decontam.proximity_matches(index, windows, scratch).join(window_items, "wid").select("item_id", "wid").distinct().collect()
    assert {r["item_id"] for r in got} == {1, 2} and len(got) == windows.count()
    assert decontam.phrase_matches(index, windows, scratch).count() == 0


@pytest.mark.parametrize("within, rarest", [(6, 3), (20, 3), (4, 2), (20, 1)])
def test_proximity_against_brute_force(spark, within, rarest):
    r = np.random.default_rng(within + rarest)
    rows = [(i, " ".join(f"w{int(k)}" for k in r.exponential(8, 60)), "en") for i in range(25)]
    items = [(j, " ".join(f"w{int(k)}" for k in r.exponential(10, n))) for j, n in enumerate((1, 2, 3, 8, 10, 14))] + [(9, "w0 w0 w1"), (8, "w0 absent")]
    freq = Counter(w for _, t, _ in rows for w in words(t))
    want = set()
    for item, text in items:
        ws = words(text)
        for s in range(max(len(ws) - 9, 1)):
            known = sorted({w for w in ws[s:s + 10] if freq[w]}, key=lambda w: (freq[w], ws[s:s + 10].index(w)))[:rarest]
            for i, t, _ in rows:
                held = words(t)
                for first in range(len(held)) if known else ():
                    if all(w in held[first:first + within] for w in known) and held[first] in known:
                        want.add((i, item))
    with Scratch(spark) as scratch:
        index = decontam.build_index(docs_frame(spark, rows), scratch)
        windows, window_items = decontam.item_windows(items_frame(spark, items), scratch)
        spans = decontam.proximity_matches(index, windows, scratch, within, rarest)
        names = {r["d1"]: r["doc_id"] for r in docs_frame(spark, rows).select("doc_id", *decontam.doc_key()).collect()}
        got = {(names[r["d1"]], r["item_id"]) for r in spans.join(window_items, "wid").collect()}
        assert got == want and want
        assert spans.filter(F.col("last") - F.col("first") >= within).isEmpty()


def test_clean_documents_stay(spark):
    rows, items = corpus(4, n_docs=20)
    docs = docs_frame(spark, rows)
    kept = decontam.without_contaminated(docs, items_frame(spark, [i for i in items if len(words(i[1])) > 8]))
    assert kept.columns == docs.columns
    clean = [r[0] for r in contamination(rows, [i for i in items if len(words(i[1])) > 8]) if not r[2]]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(clean)


def test_no_python_in_the_plan(spark):
    rows, items = corpus(5, n_docs=5)
    plan = decontam.contamination(docs_frame(spark, rows), items_frame(spark, items))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and F is not None

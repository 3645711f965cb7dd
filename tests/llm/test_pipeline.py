"""The corpus pipeline, stage by stage, and the registered queries."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from brute import awkward_rows, contamination, docs_frame, line_dedup, rooted
from oracle_compare import compare, duck

import corpus_pipeline
from tillroll.llm import registry
from tillroll.plans.lineage import Scratch
from tillroll.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"


def test_registered_names():
    assert [int(k[2:].split("_")[0]) for k in registry.QUERIES if k.startswith("op")] == list(range(1, 14))
    assert "pipeline" in registry.QUERIES and set(registry.ORACLE_SQL) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    got = compare(spark, name, registry.QUERIES[name], registry.ORACLE_SQL[name], SF, duck(SF))
    assert got["status"] == "match", got


def test_every_stage_against_brute_force(spark):
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = lambda d: [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in d.collect()]
    given, columns = rows(docs), docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.table(stage(spark, docs, SF), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
            kept[name] = rows(docs)
    assert sorted(kept["language_id"]) == sorted(given)  # all of it is language
    want = [(i, t, *r[2:4], len(t) if n else r[4]) for r, (i, _, n, t) in zip(kept["language_id"], line_dedup(kept["language_id"]))]
    assert sorted(kept["line_dedup"]) == sorted(want)
    first = {}
    for r, (i, _, _, root) in zip(kept["line_dedup"], rooted(kept["line_dedup"])):
        first[root] = min(first.get(root, r), r)
    assert sorted(kept["near_dedup"]) == sorted(first.values())
    clean = [r for r, (_, _, hit, _) in zip(kept["near_dedup"], contamination(kept["near_dedup"], items)) if not hit]
    assert sorted(kept["decontamination"]) == sorted(clean) and len(clean) < len(kept["near_dedup"])
    assert {r["doc_id"] for r in docs.collect()} == {r[0] for r in clean}


def tables_now(spark):
    folder = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark).rstrip("/") + "/tables")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in store.listStatus(folder)} if store.exists(folder) else set()


def test_run_gives_the_last_stage_and_leaves_nothing_else(spark):
    before = tables_now(spark)
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[:4] == ["doc_id", "piece", "start", "length"] and got.count() > 100
    left = tables_now(spark) - before
    assert len(left) == 1 and next(iter(left)).startswith("stage-best_fit_packing")


HELPERS = ["language", "language_", "_language", "lines", "_lines", "b_doc", "b_tag", "b_runs", "b_all", "_b_runs", "B_ALL_", "k_doc", "k_tag", "k_rows", "_k_doc",
           "c1", "c2", "_c1", "d1", "d2", "first", "part", "nth", "keeper", "holders", "uid", "tag", "h1", "h2", "pos", "lang.code", "with`tick", "a b"]


def test_columns_named_like_the_helpers(spark):
    scratch = Scratch(spark)
    plain = spark.read.parquet(f"{SF}/documents.parquet")
    odd = plain.select("*", *[F.concat(F.lit(name), F.col("doc_id")).alias(name) for name in HELPERS])
    docs, same = scratch.table(odd, "odd"), scratch.table(plain, "plain")
    for name, stage in corpus_pipeline.STAGES:
        docs, same = scratch.table(stage(spark, docs, SF), name), scratch.table(stage(spark, same, SF), name)
        if name != "best_fit_packing":
            assert docs.columns == odd.columns
            rows = docs.collect()
            assert sorted(r[:5] for r in rows) == sorted(r[:5] for r in same.collect())
            assert all(r[5 + n] == f"{h}{r['doc_id']}" for r in rows for n, h in enumerate(HELPERS))
    assert docs.count() == same.count() > 0
    scratch.close()


@pytest.mark.parametrize("rows", [awkward_rows(), []], ids=["awkward", "empty"])
def test_awkward_tables_pass_through(spark, rows):
    scratch = Scratch(spark)
    docs = scratch.table(docs_frame(spark, rows), "docs")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.table(stage(spark, docs, SF), name)
        assert name == "best_fit_packing" or docs.columns == columns
        if rows and name == "language_id":
            # Letterless texts go, and a run of one letter, which is far from every language.
            letters = Counter(t for _, t, _ in rows if any(c.isalpha() for c in t or "") and t[:9] != "x" * 9)
            assert Counter(r["text"] for r in docs.collect()) == letters
    assert (docs.count() > 0) == bool(rows)

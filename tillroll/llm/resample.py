"""Quality by importance resampling (operator 2).

Word uni- and bigrams are hashed to ``BUCKETS`` places. Two generative models
of these places, one of text labelled good and one of all text, give every
document the log of the ratio of its probabilities. Adding a Gumbel draw and
keeping the largest k samples k documents without replacement in proportion
to that ratio. The draw is a hash of seed, id and text, so it repeats.

The model of raw text counts every document. The target is what
:func:`shared.target_ids` gives: a bounded number of labelled rows. Each task
returns one row per bucket; the driver holds ``BUCKETS`` sums.

Defined cases: a null text or one without words has weight 0 (ratio 1); rows
that repeat id and text get equal keys, so they are taken or left by their
order of id and text alone; a null doc_id is an id like any other; without
any labels the target is empty and smoothed to even; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.shared import MAX_TARGET, bound_batches, flag_target
from tillroll.plans.lineage import Scratch
from tillroll.plans.ranking import global_row_number

BUCKETS = 1 << 14
SEED = 42


def gram_buckets(text: bytes | None, buckets: int = BUCKETS) -> np.ndarray:
    """Places of all word uni- and bigrams, A-Z in lower case."""
    one = np.array([zlib.crc32(w) for w in (text or b"").lower().split()], dtype="u8")
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return (np.concatenate([one, two >> np.uint64(32)]) % np.uint64(buckets)).astype("int64")


def bucket_counts(flagged: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(target, raw) counts over all rows of ``flagged`` (``text``, ``target``)."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, buckets), dtype="int64")
        for b in batches:
            for text, target in zip(b.column("text").cast(pa.binary()), b.column("target")):
                found = np.bincount(gram_buckets(text.as_py(), buckets), minlength=buckets)
                sums[1] += found
                if target.as_py():
                    sums[0] += found
        at = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0][at]), pa.array(sums[1][at])], names=["bucket", "target", "raw"])

    parts = flagged.select("text", "target").mapInArrow(counted, "bucket long, target long, raw long")
    target, raw = np.zeros(buckets), np.zeros(buckets)
    for r in parts.groupBy("bucket").agg(F.sum("target").alias("t"), F.sum("raw").alias("r")).collect():
        target[r["bucket"]], raw[r["bucket"]] = r["t"], r["r"]
    return target, raw


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    return np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))


def importance(docs: DataFrame, labels: DataFrame, most: int = MAX_TARGET, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id``, ``tag`` (hash of the text), ``n_grams``, ``log_weight``."""
    bound_batches(docs.sparkSession)
    ratio = log_ratio(*bucket_counts(flag_target(docs, labels, most), buckets))

    @F.pandas_udf("n_grams long, log_weight double")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [gram_buckets(t.encode() if t else None, buckets) for t in texts]
            yield pd.DataFrame({"n_grams": [len(f) for f in found], "log_weight": [float(ratio[f].sum()) for f in found]})

    weighed = docs.select("doc_id", F.xxhash64("text").alias("tag"), weigh("text").alias("w"))
    return weighed.select("doc_id", "tag", "w.n_grams", "w.log_weight")


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = SEED, most: int = MAX_TARGET) -> DataFrame:
    """One row per document: ``doc_id``, ``n_grams``, ``log_weight``,
    ``gumbel_key`` and ``selected``, true for the k largest keys. k is
    ``share`` of the rows; without it, the share of good rows among labelled."""
    if share is None:
        seen = labels.agg(F.count_if((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).alias("good"), F.count(F.lit(1)).alias("n")).first()
        share = seen["good"] / seen["n"] if seen["n"] else 1.0
    scratch = Scratch(docs.sparkSession)
    draw = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "tag"), 11) + 0.5) / float(1 << 53)
    keyed = scratch.table(importance(docs, labels, most).withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(draw))), "importance")
    k = round(share * keyed.count())
    ranked = global_row_number(keyed, [F.col("gumbel_key").desc(), "doc_id", "tag"], "place")
    scratch.close()  # the ranking is a checkpoint of its own
    return ranked.select("doc_id", "n_grams", "log_weight", "gumbel_key", (F.col("place") <= k).alias("selected"))


def op2_importance_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function). Each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``docs``, extra
ones included; the last returns the packed pieces.

What is dropped or changed: documents whose text is no known language (null
and letterless ones too), repeated lines, all but one document of each group
of near copies, and documents that hold a benchmark passage. An empty table
passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontam, langid, linededup, packing, simhash
from tillroll.llm.shared import own_names, quoted
from tillroll.plans.lineage import Scratch, released


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that it rejects go."""
    found, = own_names(docs, "language")
    return langid.identify(docs, found).filter(~F.col(f"{found}.rejected")).drop(found)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: texts lose their repeated lines; ``n_chars`` follows."""
    info, = own_names(docs, "lines")
    kept = linededup.apply_bitmaps(docs, linededup.keep_bitmaps(docs), info)
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col(f"{info}.n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return kept.select(quoted(*docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each group stays, the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that hold a window of a benchmark item go."""
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: what is left becomes sequences of 2048 tokens."""
    return packing.packed_pieces(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# The language model and the tokenizer have no SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. Of what they write only the last one's table stays: a
    stage's own tables and its input go once its result is written."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with released():
            after = scratch.table(stage(spark, docs, sf_dir), f"stage-{name}")
        if docs in scratch.paths:
            scratch.drop(docs)
        docs = after
    return docs

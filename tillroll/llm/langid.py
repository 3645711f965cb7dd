"""Language identification by nearest centroid (operator 8).

A text becomes counts of its 1- to 3-letter grams (letters in lower case, a
run of anything else is one blank), hashed to ``DIMS`` places, damped by
1 + log, weighted by inverse document frequency and scaled to length one.
Each language has several centroids, clustered by cosine from labelled rows;
a text gets the language of the nearest centroid of all, and the cosine to
it as score.

Rejection is by distance: each language has a floor of its own, a part of a
low quantile of the cosines that its long training texts have to its nearest
centroid, so that a few rows under a wrong label don't lower it; it falls with
the root of the letters for short texts. Below its nearest language's floor a
text is ``rejected``; that language is still named.

The model is fitted on at most about ``PER_LANGUAGE`` labelled rows of each
language, chosen by a hash of their id, and on the ``MOST_LANGUAGES`` labels
with the most rows (ties: first by name), ``MOST_ROWS`` rows in all, so that
a label column full of junk costs no more. Prediction reads whole texts of
all rows, and nothing but the text.

Defined cases: a null text, or one without letters, is ``und`` with score 0
and rejected, as is everything if nothing was learned; rows without a
language or id are not learned from, a null id counts as held out; repeated
rows are predicted each; ties go to the language first by name; other
columns are kept by :func:`identify`; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.shared import bound_batches

DIMS = 4_096
PER_LANGUAGE = 400
CENTROIDS = 4
MOST_LANGUAGES, MOST_ROWS = 200, 8_000
FLOOR_PART, FLOOR_QUANTILE = 0.55, 0.02
LONG = 7  # texts of at least 2**LONG letters are long
UNKNOWN = "und"
ROWS_AT_ONCE = 128


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def gram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed grams (a row per text) and letters per text."""
    codes, row = [], []
    for n, text in enumerate(texts):
        c = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        letter = _letters()[c]
        # One blank before, after and between words.
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        c = np.where(letter, c, 32)[keep]
        c = np.concatenate([[32], c, [32] if not len(c) or c[-1] != 32 else []]).astype("u4")
        codes.append(c), row.append(np.full(len(c), n))
    code, row = np.concatenate(codes), np.concatenate(row)
    one = code * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0xC2B2AE35) + one[2:]
    size = len(texts) * DIMS
    total = np.zeros(size)
    for n, gram in enumerate((one, two, three)):
        end = len(code) - n
        same = (row[:end] == row[n:]) & ((code[:end] != 32) | (n > 0))
        place = row[:end][same] * DIMS + ((gram[same] ^ (gram[same] >> np.uint32(16))) % np.uint32(DIMS)).astype("int64")
        total += np.bincount(place, minlength=size)
    letters = np.bincount(row[code != 32], minlength=len(texts))
    return total.reshape(len(texts), DIMS), letters


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _size_class(letters: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(letters, 1)).astype(int)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray  # by centroid and size class

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * self.idf)

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        counts, letters = gram_counts(texts)
        if not self.languages:
            return pd.DataFrame({"lang": [UNKNOWN] * len(texts), "score": 0.0, "rejected": True})
        near = self.vectors(counts) @ self.centroids.T
        best = near.argmax(axis=1)
        score = np.clip(near.max(axis=1), 0.0, 1.0)
        known = letters > 0
        floor = self.floors[best, np.minimum(_size_class(letters), LONG)]
        return pd.DataFrame({"lang": np.where(known, np.array(self.languages, dtype=object)[best], UNKNOWN),
                             "score": np.where(known, score, 0.0), "rejected": ~known | (score < floor)})


def _clusters(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, seeded by the row farthest from what is chosen."""
    centers = _unit(x.mean(axis=0, keepdims=True))
    while len(centers) < min(k, len(x)):
        centers = np.vstack([centers, x[(x @ centers.T).max(axis=1).argmin()]])
    for _ in range(20):
        own = (x @ centers.T).argmax(axis=1)
        moved = np.vstack([_unit(x[own == j].sum(axis=0, keepdims=True)) if (own == j).any() else centers[j:j + 1] for j in range(len(centers))])
        if np.allclose(moved, centers):
            break
        centers = moved
    return centers


def _sampled(docs: DataFrame, learn: Column, per_language: int) -> DataFrame:
    rows = docs.select("doc_id", "text", "lang").filter(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    if not counts:
        return rows.select("lang", "text")
    per_language = min(per_language, max(MOST_ROWS // len(counts), 1))
    share = {r["lang"]: per_language / r["n"] for r in counts}
    by_lang = F.create_map(*[F.lit(x) for pair in share.items() for x in pair])
    at = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return rows.filter(at < by_lang[F.col("lang")]).select("lang", "text")


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Model:
    """Learns from rows of ``docs`` (``doc_id``, ``text``, ``lang``) for which
    ``learn`` holds. Only the counts of the bounded sample reach the driver."""
    def counted(batches):
        for b in batches:
            for a in range(0, len(b), ROWS_AT_ONCE):
                part = b.iloc[a:a + ROWS_AT_ONCE]
                counts, letters = gram_counts(part["text"].tolist())
                yield pd.DataFrame({"lang": part["lang"].to_numpy(), "letters": letters,
                                    "counts": [r.astype("<f4").tobytes() for r in counts]})

    rows = _sampled(docs, learn, per_language).mapInPandas(counted, "lang string, letters long, counts binary").filter("letters > 0").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["counts"])))
    if not rows:
        return Model([], np.zeros((0, DIMS)), np.ones(DIMS), np.zeros((0, LONG + 1)))
    counts = np.array([np.frombuffer(r["counts"], dtype="<f4") for r in rows], dtype=float)
    lang = np.array([r["lang"] for r in rows], dtype=object)
    model = Model([], np.zeros((0, DIMS)), np.log((1 + len(rows)) / (1 + (counts > 0).sum(axis=0))) + 1, np.zeros((0, LONG + 1)))
    x = model.vectors(counts)
    parts = {name: _clusters(x[lang == name], centroids) for name in sorted(set(lang))}
    model.languages = [name for name, c in parts.items() for _ in c]
    model.centroids = np.vstack(list(parts.values()))
    own = np.array([(x[n] @ parts[lang[n]].T).max() for n in range(len(x))])
    long = _size_class(np.array([r["letters"] for r in rows])) >= LONG
    # A short text shares fewer grams with a centroid: its cosine falls as the root of its letters.
    shorter = 2.0 ** (np.minimum(np.arange(LONG + 1) - LONG, 0) / 2)
    low = {name: np.quantile(own[at], FLOOR_QUANTILE) for name in parts if (at := long & (lang == name)).any()}
    # A language without long texts takes the lowest floor of the others.
    least = min(low.values(), default=0.0)
    model.floors = FLOOR_PART * np.array([low.get(name, least) for name in model.languages])[:, None] * shorter
    return model


def predicted(model: Model, text="text") -> Column:
    """Struct (``lang``, ``score``, ``rejected``) of a text column."""
    @F.pandas_udf("lang string, score double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = [model.predict(texts.iloc[a:a + ROWS_AT_ONCE].tolist()) for a in range(0, len(texts), ROWS_AT_ONCE)]
            yield pd.concat(parts) if parts else pd.DataFrame({"lang": [], "score": [], "rejected": []})
    return run(F.col(text))


def held_out() -> Column:
    """One in five documents by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def identify(docs: DataFrame, name: str = "language") -> DataFrame:
    """``docs`` and a struct column ``name``: (``lang``, ``score``, ``rejected``)."""
    bound_batches(docs.sparkSession)
    return docs.select("*", predicted(fit(docs, ~held_out())).alias(name))


def op8_nearest_centroid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"),
                                 F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"))

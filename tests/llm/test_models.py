"""Language ID, importance resampling and LM scoring."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import awkward_rows, docs_frame

from pyspark.sql import functions as F

from tillroll.llm import langid, lmscore, resample

SF = "/root/testdata/sf0.01"


def labels_frame(spark, rows):
    return spark.createDataFrame([(i, q, t, "x") for i, q, t in rows], "doc_id long, quality int, toxic int, text string")


# ---- language ID -----------------------------------------------------------

def test_held_out_accuracy(spark):
    got = langid.op8_nearest_centroid(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got) and not any(r["rejected"] for r in got)


def test_only_the_text_decides_and_strangers_are_rejected(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs, ~langid.held_out())
    again = langid.fit(docs, ~langid.held_out())
    assert (model.centroids == again.centroids).all() and model.languages == ["de"] * 4 + ["en"] * 4 + ["es"] * 4 + ["fr"] * 4
    text = docs.filter("lang = 'de' and length(text) > 500").first()["text"]
    strangers = ["Съешь же ещё этих мягких французских булок, да выпей чаю. " * 5, "天地玄黄宇宙洪荒日月盈昃辰宿列张" * 8]
    got = model.predict([text, None, "", "12 ... 34", *strangers])
    assert got["lang"][0] == "de" and got["lang"][1:4].tolist() == ["und"] * 3 and got["score"][1:4].tolist() == [0.0] * 3
    assert got["rejected"].tolist() == [False, True, True, True, True, True]


def plain_prediction(model, text):
    """Grams counted one by one, and a cosine per centroid."""
    letters = sum(c.isalpha() for c in (text or "").lower())
    shown = " " + re.sub(r"(?:(?![^\W\d_]).)+", " ", "".join(c if c.isalpha() else " " for c in (text or "").lower())).strip() + " "
    shown = re.sub(" +", " ", shown)
    grams = Counter()
    codes = [ord(c) for c in shown]
    u32 = 0xFFFFFFFF
    for k, c in enumerate(codes):
        one = c * 0x9E3779B1 & u32
        chain = [one if c != 32 else None]
        if k + 1 < len(codes):
            two = ((one ^ one >> 15) * 0x85EBCA6B + (codes[k + 1] * 0x9E3779B1 & u32)) & u32
            chain.append(two)
            if k + 2 < len(codes):
                chain.append(((two ^ two >> 13) * 0xC2B2AE35 + (codes[k + 2] * 0x9E3779B1 & u32)) & u32)
        grams.update((g ^ g >> 16) % langid.DIMS for g in chain if g is not None)
    if not letters:
        return "und", 0.0, True
    vec = {g: (1 + math.log(n)) * model.idf[g] for g, n in grams.items()}
    size = math.sqrt(sum(v * v for v in vec.values()))
    near = [sum(v * c[g] for g, v in vec.items()) / size for c in model.centroids]
    best = max(range(len(near)), key=lambda j: near[j])
    score = min(max(near[best], 0.0), 1.0)
    return model.languages[best], score, score < model.floors[best][min(int(math.log2(letters)), langid.LONG)]


def test_query_against_plain_nearest_centroid(spark):
    """The same model, every row of the table, cosines by plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs, ~langid.held_out())
    got = {r["doc_id"]: r for r in langid.op8_nearest_centroid(spark, SF).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        lang, score, rejected = plain_prediction(model, r["text"])
        mine = got[r["doc_id"]]
        assert mine["score"] == pytest.approx(score, abs=1e-9) and mine["lang_pred"] == lang and mine["rejected"] == rejected


STRANGERS = {
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza.",
    "nl": "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
}


def test_latin_strangers_and_mislabelled_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    wrong = spark.createDataFrame([(900_000 + k, "zq xj vv kk wq " * 40 if k % 2 else STRANGERS["tr"] * 3, "en") for k in range(6)], "doc_id long, text string, lang string")
    for learned in (docs, docs.unionByName(wrong)):
        model = langid.fit(learned, ~langid.held_out())
        got = model.predict([*STRANGERS.values(), "zxq wvk " * 60])
        if learned is docs:
            assert got["rejected"].all()
        rows = docs.filter("length(text) > 300").limit(150).collect()
        held = model.predict([r["text"] for r in rows])
        assert not held["rejected"].any() and (held["lang"] == np.array([r["lang"] for r in rows])).mean() > 0.98
        floors = {name: f for name, f in zip(model.languages, model.floors[:, langid.LONG])}
        assert min(floors.values()) > 0.3


def test_a_label_column_full_of_junk_costs_no_more(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    monkeypatch.setattr(langid, "MOST_ROWS", 30)
    rows = [(k, "the cat sat on the mat and so on", "en") for k in range(200)] + [(500 + k, "der Hund und die Katze und so weiter", "de") for k in range(100)]
    rows += [(1000 + k, f"junk row {k}", f"label {k:04d}") for k in range(300)]
    docs = docs_frame(spark, rows)
    model = langid.fit(docs, F.lit(True))
    assert len(set(model.languages)) == 3 and {"en", "de"} <= set(model.languages)
    assert model.predict(["und die Katze und der Hund"])["lang"][0] == "de"


def test_awkward_documents(spark):
    docs = docs_frame(spark, awkward_rows())
    got = langid.identify(docs, "_x")
    assert got.columns == [*docs.columns, "_x"]
    for r in got.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["_x"]["lang"] != "und") == letters and 0 <= r["_x"]["score"] <= 1


def test_nothing_to_learn_from(spark):
    docs = docs_frame(spark, [(1, "some text", None), (None, "more text", "en")])
    assert {(r["_x"]["lang"], r["_x"]["rejected"]) for r in langid.identify(docs, "_x").collect()} == {("und", True)}
    assert langid.identify(docs_frame(spark, []), "_x").count() == 0


def test_gram_counts_do_not_depend_on_neighbours():
    texts = ["Ab cd", None, "...", "xyz ab", "Ab  CD!", ""]
    counts, letters = langid.gram_counts(texts)
    assert letters.tolist() == [4, 0, 0, 5, 4, 0] and (counts[0] == counts[4]).all()
    for n, t in enumerate(texts):
        assert (langid.gram_counts([t])[0][0] == counts[n]).all()
    assert counts[0].sum() == 4 + 6 + 5  # letters, pairs and triples of " ab cd "


# ---- importance resampling -------------------------------------------------

def brute_weights(rows, good, buckets):
    def grams(t):
        h = [zlib.crc32(w) for w in (t or "").encode().lower().split()]
        two = [((a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) % 2**64) >> 32 for a, b in zip(h, h[1:])]
        return [x % buckets for x in h + two]

    raw, target = Counter(), Counter()
    for i, t, *_ in rows:
        raw.update(grams(t))
        if i in good:
            target.update(grams(t))
    n_raw, n_target = sum(raw.values()) + buckets, sum(target.values()) + buckets
    return [(i, len(grams(t)), sum(math.log((target[g] + 1) / n_target) - math.log((raw[g] + 1) / n_raw) for g in grams(t))) for i, t, *_ in rows]


def test_weights_and_top_k(spark):
    rows, labels = awkward_rows(), [(1, 1, 0), (2, 1, 0), (7, 1, 0), (7, 1, 0), (10, 1, 1), (30, 1, None), (31, 0, 0), (None, 1, 0), (99, 1, 0), (5, None, 0)]
    got = resample.resample(docs_frame(spark, rows), labels_frame(spark, labels), share=0.4).collect()
    want = brute_weights(rows, {1, 2, 7, 30}, resample.BUCKETS)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[2], 6))
    assert sorted(map(key, ((r["doc_id"], r["n_grams"], r["log_weight"]) for r in got))) == sorted(map(key, want))
    chosen = [r["gumbel_key"] for r in got if r["selected"]]
    assert len(chosen) == round(0.4 * len(rows)) and min(chosen) >= max(r["gumbel_key"] for r in got if not r["selected"])


def test_draws_follow_the_ratio():
    """The largest of w + Gumbel is drawn in proportion to exp(w)."""
    r = np.random.default_rng(0)
    w = np.log([1.0, 2.0, 7.0])
    keys = w - np.log(-np.log(r.random((20_000, 3))))
    assert np.allclose(np.bincount(keys.argmax(axis=1)) / 20_000, [0.1, 0.2, 0.7], atol=0.02)


def test_labelled_quality_is_told_apart(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = resample.op2_importance_resampling(spark, SF).join(labels, "doc_id").collect()
    share = lambda q, t: np.mean([r["selected"] for r in got if (r["quality"], r["toxic"]) == (q, t)])
    assert share(1, 0) > 0.9 and share(0, 0) < 0.2


# ---- LM scoring ------------------------------------------------------------

def scored_parts(text):
    """The words of a text; of one longer than a block, part by part."""
    part = []
    for chunk in lmscore.words((text or "").encode()):
        part += chunk
        if len(part) >= lmscore.BLOCK:
            yield part
            part = []
    yield part


def brute_losses(rows, good):
    """(tokens, target loss, background loss) per row: each part by the counts
    of all but itself."""
    parts = []
    for n, (i, t, *_) in enumerate(rows):
        before = "<s>"
        for part in scored_parts(t):
            parts.append((n, i in good, before, part))
            before = part[-1] if part else before
    models = [[Counter(), Counter(), 0], [Counter(), Counter(), 0]]
    counted = []
    for n, is_good, before, part in parts:
        word, pair = Counter(part), Counter(zip([before, *part], part))
        word["<s>"] += before == "<s>"
        counted.append((word, pair))
        for model in models[not is_good:]:
            model[0].update(word), model[1].update(pair)
            model[2] += len(part)
    types = len(models[1][0]) - 1
    out = [[0, 0.0, 0.0] for _ in rows]
    for (n, is_good, before, part), (word, pair) in zip(parts, counted):
        out[n][0] += len(part)
        for v, w in zip([before, *part], part):
            alone = 1 / types
            for m, prior in ((1, lmscore.ADDED * types), (0, lmscore.WORD_PRIOR)):
                less = m or is_good
                alone = (models[m][0][w] - word[w] * less + prior * alone) / (models[m][2] - len(part) * less + prior)
                likely = (models[m][1][v, w] - pair[v, w] * less + lmscore.PRIOR * alone) / (models[m][0][v] - word[v] * less + lmscore.PRIOR)
                out[n][1 + m] -= math.log(likely)
    return [(n, t / n, b / n) if n else (0, None, None) for n, t, b in out]


def check_losses(spark, rows, labels):
    good = {i for i, q, t in labels if q == 1 and not t and i is not None}
    got = lmscore.cross_entropy_difference(docs_frame(spark, rows), labels_frame(spark, labels)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], round(r[2] or 0, 6))
    have = sorted(((r["doc_id"], r["n_tokens"], r["target_loss"], r["background_loss"]) for r in got), key=key)
    want = sorted(((i, *w) for (i, *_), w in zip(rows, brute_losses(rows, good))), key=key)
    for a, b in zip(have, want, strict=True):
        assert a[:2] == b[:2] and a[2:] == (b[2:] if b[2] is None else pytest.approx(b[2:], abs=1e-9))
    assert all((r["score"] is None) if not r["n_tokens"] else r["score"] == r["target_loss"] - r["background_loss"] for r in got)


def test_losses(spark):
    check_losses(spark, awkward_rows(), [(7, 1, 0), (10, 1, 0), (11, 1, 0), (30, 0, 1), (5, 1, 1), (None, 1, 0)])
    check_losses(spark, awkward_rows(), [])
    check_losses(spark, [(1, "alone", "en")], [(1, 1, 0)])


def test_losses_in_a_corpus_many_times_larger(spark):
    """More words and more pairs than any fixed table would hold, and documents longer than a block."""
    r = np.random.default_rng(5)
    long = "many" * 20
    some = [(i, f"the cat number{i % 3} sat on the {long} mat. " * 5, "en") for i in range(6)]
    filler = [(100 + k, " ".join(f"w{x}" for x in r.integers(0, 50_000, 400)), "en") for k in range(2_000)]
    filler.append((99, " ".join(f"w{x}" for x in r.integers(0, 9_000, lmscore.BLOCK + 50_000)), "en"))
    labels = [(i, 1, 0) for i in (1, 2, *range(99, 400))]
    check_losses(spark, some, labels)
    check_losses(spark, some + filler, labels)


def test_every_labelled_row_counts(spark):
    """If all of a large corpus is labelled good, the models differ by smoothing alone."""
    docs = spark.range(100_050).select(F.col("id").alias("doc_id"), F.concat(F.lit("own words "), F.col("id") % 1_000).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    got = lmscore.cross_entropy_difference(docs, labels.unionByName(labels.limit(10)))
    assert got.agg(F.count_if(F.abs("score") < 2e-3), F.sum("n_tokens")).first()[:] == (100_050, 300_150)


def below(a, b):
    """Share of pairs in which a value of ``a`` is below one of ``b``."""
    return float((np.array(a)[:, None] < np.array(b)[None]).mean())


def test_withheld_good_text_scores_like_trained_and_noise_worse(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic").collect()
    good = sorted(r["doc_id"] for r in labels if r["quality"] == 1 and not r["toxic"])
    r = np.random.default_rng(1)
    withheld = set(r.choice(good, len(good) // 2, replace=False).tolist())
    noise = " ".join("".join(r.choice(list("abcdefghijklmnopqrstuvwxyz"), r.integers(4, 11))) for _ in range(2_000))
    some = spark.createDataFrame([tuple(x) for x in labels if x["doc_id"] not in withheld], "doc_id long, quality int, toxic int")
    both = docs.unionByName(spark.createDataFrame([(-1, noise)], "doc_id long, text string"))
    score = {x["doc_id"]: x["score"] for x in lmscore.cross_entropy_difference(both, some).collect() if x["score"] is not None}
    trained, held = ([score[i] for i in good if (i in withheld) == w and i in score] for w in (False, True))
    bad = [score[x["doc_id"]] for x in labels if x["quality"] == 0 and x["doc_id"] in score]
    assert 0.4 < below(trained, held) < 0.6 and below(held, bad) > 0.92
    # Only junk scores worse than noise: no text that is labelled of good quality.
    assert score[-1] > max(trained + held + [score[x["doc_id"]] for x in labels if x["quality"] == 1 and x["doc_id"] in score])
    assert np.mean([s > score[-1] for s in score.values()]) < 0.05


def test_empty_tables(spark):
    docs, labels = docs_frame(spark, []), labels_frame(spark, [])
    assert resample.resample(docs, labels).count() == 0 and lmscore.cross_entropy_difference(docs, labels).count() == 0
    some = docs_frame(spark, awkward_rows())
    assert resample.resample(some, labels).filter("selected").count() == len(awkward_rows())
    assert lmscore.cross_entropy_difference(some, labels).count() == len(awkward_rows())

"""The softmax over trigrams against the same in plain Python, on held-out rows, and as the corpus plan's detector."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_corpus import blob

from tablesift.operators import language_model as lm
from tablesift.plans import corpus
from tablesift.plans.config import config

WORDS = {"en": "the of name price count total with from year city".split(), "de": "der die straße größe preis anzahl jahr stadt über für".split(), "fr": "le année où prix ville première être été les nombre".split()}


def texts(n, seed):
    rng = random.Random(seed)
    return [(i, lang, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(3, 15))) + rng.choice(["", " 12", "!", "\n"])) for i, lang in enumerate(rng.choice(["en", "en", "de", "fr"]) for _ in range(n))]


def plain_features(text):
    found = {}
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        word = f" {word} "
        for i in range(len(word) - 2):
            b = sum(ord(c) * f for c, f in zip(word[i : i + 3], lm.FACTORS)) % lm.BUCKETS
            found[b] = found.get(b, 0) + 1
    total = sum(found.values())
    return {b: math.sqrt(c / total) for b, c in found.items()}


def plain_fit(rows, steps, rate):
    langs = sorted({lang for _, lang, t in rows if plain_features(t)})
    known = [(lang, plain_features(t)) for _, lang, t in rows if plain_features(t)]
    w = np.zeros((lm.BUCKETS, len(langs)))
    for _ in range(steps):
        g = np.zeros_like(w)
        for lang, x in known:
            z = sum(v * w[b] for b, v in x.items())
            p = np.exp(z - z.max())
            p /= p.sum()
            e = (np.array([lang == k for k in langs]) - p) / (len(langs) * sum(k == lang for k, _ in known))
            for b, v in x.items():
                g[b] += v * e
        w += rate * g
    return langs, w


def test_fit_is_the_plain_one(spark, tmp_path):
    rows = [*texts(60, 1), (98, "en", ""), (99, "de", "12 !"), (97, None, "the name")]
    model = lm.fit(spark.createDataFrame(rows, "i long, lang string, text string").repartition(4), "text", "lang")
    langs, w = plain_fit([r for r in rows if r[1]], lm.STEPS, lm.RATE)
    assert list(model.langs) == langs and np.allclose(model.weights, w, atol=1e-9)
    model.table(spark).write.parquet(f"{tmp_path}/weights")
    again = lm.LanguageModel.of_table(spark.read.parquet(f"{tmp_path}/weights"))
    assert again.langs == model.langs and np.array_equal(again.weights, model.weights)


def test_held_out_rows_and_edges(spark):
    model = lm.fit(spark.createDataFrame(texts(200, 2), "i long, lang string, text string"), "text", "lang")
    held = spark.createDataFrame([*texts(100, 3), (200, None, None), (201, None, ""), (202, None, "12 !?"), (203, None, "the " * 20_000)], "i long, lang string, text string").repartition(3)
    got = {r.i: r for r in held.withColumn("found", model(F.col("text"))).collect()}
    assert all(r.found.lang == r.lang and r.found.score > 0.5 for i, r in got.items() if i < 100)
    assert got[200].found is None and got[201].found is None and tuple(got[202].found) == ("und", 0.0) and got[203].found.lang == "en"
    none = lm.fit(held.filter("false"), "text", "lang")
    assert none.langs == () and held.filter("i = 1").select(none(F.col("text"))).first()[0].lang == "und"


@pytest.mark.parametrize("threshold", [0.5, 0.0])
def test_tables_of_other_languages_go(spark, threshold):
    """By the names of their columns, in the corpus plan; with threshold 0 the most likely language still decides."""
    model = lm.fit(spark.createDataFrame(texts(200, 2), "i long, lang string, text string"), "text", "lang")
    column = lambda j: [f"v{i * j % 79}" for i in range(80)]
    tables = [(lang, blob(**{w: column(j + 1) for j, w in enumerate(WORDS[lang][:6])})) for lang in WORDS]
    df = spark.createDataFrame([(k, bytearray(b)) for k, b in tables], "content_hash string, arrow_bytes binary")
    assert [r.content_hash for r in corpus.cleaned(df, config("v6", langdetect_threshold=threshold), model).collect()] == ["en"]

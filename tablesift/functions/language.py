"""Which language some text is in.

A detector turns a column of text into a struct of lang and score.  One by
trigrams is fitted on texts whose language is known; any other trained model can be
plugged in.  Without one, a detector by frequent words is used, which is meant for
headers and short texts in a few languages only.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESULT = "struct<lang:string,score:double>"


class LanguageDetector(Protocol):
    def __call__(self, text: Column) -> Column:
        """A struct of lang and score; null for null and empty text."""


class FrequentWords:
    """Shares of a text's words that are frequent in each language; all in Column expressions."""

    WORDS = {
        "en": "the of and to in is that for with on name date id type value year total number count status code time first last address city state country price".split(),
        "de": "der die und das ist von mit den dem ein eine nicht auf für zu im name datum jahr anzahl wert stadt land preis".split(),
        "fr": "le la les de et des du un une est pour dans que sur au nom date année nombre valeur ville pays prix".split(),
        "es": "el la los las de y en un una es por con para que del nombre fecha año número valor ciudad país precio".split(),
    }

    def __call__(self, text: Column) -> Column:
        words = F.filter(F.split(F.lower(text), r"(?U)[^\p{L}]+"), lambda w: w != "")

        def held(own: list[str]) -> Column:
            return F.size(F.filter(words, lambda w: w.isin(own)))

        hits = [F.struct(held(own).alias("hits"), F.lit(lang).alias("lang")) for lang, own in self.WORDS.items()]
        best = F.array_max(F.array(*hits))
        score = F.least(F.lit(1.0), best["hits"].cast("double") / F.greatest(F.size(words), F.lit(1)) * 2)
        return F.when(F.coalesce(F.size(words), F.lit(0)) > 0, F.struct(F.when(best["hits"] > 0, best["lang"]).otherwise("und").alias("lang"), score.alias("score")))


class ModelDetector:
    """A model that each Python worker loads once; ``load()`` returns ``predict(texts) -> [(lang, score)]``."""

    def __init__(self, load: Callable[[], Callable[[list[str]], list[tuple[str, float]]]]):
        self._load = load

    def __call__(self, text: Column) -> Column:
        load = self._load

        @F.pandas_udf(RESULT)
        def detect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            predict = load()
            for texts in batches:
                found = predict(texts.fillna("").str.replace("\n", " ").tolist())
                yield pd.DataFrame({"lang": [lang for lang, _ in found], "score": [min(score, 1.0) for _, score in found]})

        return F.when(F.coalesce(text, F.lit("")) != "", detect(text))


def trigrams(text: Column) -> Column:
    """Runs of three characters of a text's words, lower-cased, with a space at either end of a word."""
    words = F.filter(F.split(F.lower(text), r"(?U)[^\p{L}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))
    return F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3)))))


def trigram_model(rows: DataFrame, text: str, lang: str, key: str, most: int = 2_000, kept: int = 1_500) -> dict[str, dict[str, float]]:
    """Log probabilities of the ``kept`` most frequent trigrams of each language, and of any other under "".

    Fitted on at most ``most`` rows of each language, by a digest of their key; Spark counts, and the
    driver gets ``kept`` numbers for each language.
    """
    order = Window.partitionBy(lang).orderBy(F.md5(F.col(key).cast("string")), key)
    sample = rows.filter(F.col(lang).isNotNull()).withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= most)
    counts = sample.select(F.col(lang).alias("lang"), F.explode_outer(trigrams(F.col(text))).alias("gram")).filter("gram IS NOT NULL").groupBy("lang", "gram").count()
    best = Window.partitionBy("lang").orderBy(F.desc("count"), "gram")
    top = counts.withColumns({"rank": F.row_number().over(best), "total": F.sum("count").over(Window.partitionBy("lang"))}).filter(F.col("rank") <= kept)
    model: dict[str, dict[str, float]] = {}
    for r in top.collect():
        model.setdefault(r.lang, {"": math.log(0.5 / r.total)})[r.gram] = math.log(r["count"] / r.total)
    return model


def trigram_detector(model: dict[str, dict[str, float]]) -> ModelDetector:
    """A detector by a ``trigram_model``; the score is the share of the best language's probability, evened out by length."""

    def predict(texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for text in texts:
            grams = [f" {w} "[i : i + 3] for w in re.findall(r"[^\W\d_]+", text.lower()) for i in range(len(w))]
            if not grams or not model:
                out.append(("und", 0.0))
                continue
            means = {lang: sum(own.get(g, own[""]) for g in grams) / len(grams) for lang, own in model.items()}
            best = max(sorted(means), key=means.__getitem__)
            weight = min(len(grams), 20)
            out.append((best, 1 / sum(math.exp(weight * (m - means[best])) for m in means.values())))
        return out

    return ModelDetector(lambda: predict)


class KnownLanguage:
    """Takes the language from another column, with full score; for corpora that say it."""

    def __init__(self, column: str):
        self._column = column

    def __call__(self, text: Column) -> Column:
        return F.when(F.coalesce(text, F.lit("")) != "", F.struct(F.col(self._column).alias("lang"), F.lit(1.0).alias("score")))

"""A language model of hashed trigrams, fitted on all rows whose language is known.

A text is the shares of its trigrams, within words with a blank at either end, in ``BUCKETS`` buckets,
as square roots, so that every text has length 1.  A softmax over these is fitted from zero by full
gradients: at each step every task works off its rows and sends one sum for each bucket and
language, and the sums are added up, so all rows count and what moves doesn't grow with them.
Each language weighs the same, however many rows it has.

The weights are a table (bucket, lang, weight) of a fixed size, to be kept and read again anywhere.

Defined results: texts without letters are "und" with score 0 and teach nothing, as do rows of unknown
language; of equally likely languages the first by name is found; without any rows nothing is known
and all texts are "und".
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.functions.language import RESULT
from tablesift.streaming.runner import shared_folder

BUCKETS = 4096
STEPS, RATE = 4, 30.0
#: What the three characters' numbers are multiplied by.
FACTORS = (7919, 101, 1)
#: Languages up to which the weights are a table of bounded size.
MOST_LANGUAGES = 256

_WORDS = regex.compile(r"\p{L}+")


def buckets_of(text: str | None) -> np.ndarray:
    """The bucket of each trigram: of each letter with what stands on either side of it, a blank at a word's ends."""
    letters = np.frombuffer(f" {' '.join(_WORDS.findall((text or '').lower()))} ".encode("utf-32-le"), "<u4").astype(np.int64)
    before, own, after = letters[:-2], letters[1:-1], letters[2:]
    number = before * FACTORS[0] + own * FACTORS[1] + after * FACTORS[2]
    return (number[own != 32] % BUCKETS).astype(np.int32)


def _lists(texts: list[str | None]) -> pa.ListArray:
    found = [buckets_of(t) for t in texts]
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(f) for f in found])).astype(np.int32)), pa.array(np.concatenate([*found, np.zeros(0, np.int32)])))


def _features(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value from each row's buckets."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(lists)), sizes)
    key, many = np.unique(row * BUCKETS + lists.flatten().to_numpy(zero_copy_only=False), return_counts=True)
    row, bucket = key // BUCKETS, key % BUCKETS
    return row, bucket, np.sqrt(many / sizes[row])


def _probabilities(weights: np.ndarray, row: np.ndarray, bucket: np.ndarray, x: np.ndarray, rows: int) -> np.ndarray:
    z = np.stack([np.bincount(row, x * weights[bucket, k], rows) for k in range(weights.shape[1])], 1)
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


@dataclass(frozen=True)
class LanguageModel:
    langs: tuple[str, ...]
    weights: np.ndarray  # by bucket and language

    def __call__(self, text: Column) -> Column:
        """A struct of lang and score, the probability; null for null and empty text: a detector for the corpus plans."""
        langs, weights = self.langs, self.weights

        @F.pandas_udf(RESULT)
        def detect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            names = np.array([*langs, "und"], object)
            for texts in batches:
                best, score = np.full(len(texts), len(langs)), np.zeros(len(texts))
                own = _lists(texts.tolist())
                if langs:
                    p = _probabilities(weights, *_features(own), len(texts))
                    some = np.flatnonzero(np.diff(own.offsets.to_numpy()))
                    best[some], score[some] = p[some].argmax(1), p[some].max(1)
                yield pd.DataFrame({"lang": names[best], "score": score})

        return F.when(F.coalesce(text, F.lit("")) != "", detect(text))

    def table(self, spark: SparkSession) -> DataFrame:
        """bucket, lang, weight."""
        rows = pd.DataFrame({"bucket": np.repeat(np.arange(BUCKETS), len(self.langs)), "lang": list(self.langs) * BUCKETS, "weight": self.weights.ravel()})
        return spark.createDataFrame(rows, "bucket int, lang string, weight double")

    @staticmethod
    def of_table(rows: DataFrame) -> LanguageModel:
        """From a table of weights, which has at most ``BUCKETS`` rows for each language."""
        got = rows.select("bucket", "lang", "weight").toPandas()
        langs = tuple(sorted(got["lang"].unique()))
        weights = np.zeros((BUCKETS, len(langs)))
        weights[got["bucket"], got["lang"].map({lang: k for k, lang in enumerate(langs)})] = got["weight"]
        return LanguageModel(langs, weights)


def fit(rows: DataFrame, text: str, lang: str, steps: int = STEPS, rate: float = RATE) -> LanguageModel:
    """Fitted on all ``rows`` with a language and letters."""
    spark = rows.sparkSession
    shared_folder(spark)
    # Features are made once; each step reads them.
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                yield pa.RecordBatch.from_arrays([batch.column("lang"), _lists(batch.column("text").to_pylist())], ["lang", "buckets"])

    known = rows.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(made, "lang string, buckets array<int>").checkpoint()
    known = known.filter(F.size("buckets") > 0)
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    langs = tuple(counts)
    weights = np.zeros((BUCKETS, len(langs)))
    share = np.array([1 / (len(langs) * n) for n in counts.values()])

    for _ in range(steps if langs else 0):

        def gradient(batches: Iterator[pa.RecordBatch], weights: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            total, place = np.zeros_like(weights), {name: k for k, name in enumerate(langs)}
            for batch in batches:
                row, bucket, x = _features(batch.column("buckets"))
                own = np.array([place[v] for v in batch.column("lang").to_pylist()], np.int64)
                error = (np.eye(len(langs))[own] - _probabilities(weights, row, bucket, x, len(own))) * share[own][:, None]
                for k in range(len(langs)):
                    total[:, k] += np.bincount(bucket, x * error[row, k], BUCKETS)
            at = np.flatnonzero(total.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at].tolist(), pa.list_(pa.float64()))], ["bucket", "g"])

        sums = known.mapInArrow(gradient, "bucket int, g array<double>").groupBy("bucket").agg(*[F.sum(F.get("g", F.lit(k))).alias(f"g{k}") for k in range(len(langs))])
        got = sums.toPandas()  # a row for each bucket at most
        step = np.zeros_like(weights)
        step[got["bucket"]] = got[[f"g{k}" for k in range(len(langs))]]
        weights = weights + rate * step
    return LanguageModel(langs, weights)

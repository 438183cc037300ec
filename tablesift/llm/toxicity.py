"""Toxicity by a factorization machine over hashed terms (operator 3).

The terms of a text are its lower-cased words and the first four and five
bytes of each, which stand for stems, hashed to ``2**BITS`` numbers.  The score
is the logistic function of

    bias + sum of w[i] + sum over pairs i < j of <v[i], v[j]>

over the distinct terms that a text holds.  The weights w are what a linear
model has; the vectors v give a weight to each pair, such as an insult with the
mention of a group, from fewer numbers than there are pairs.

The model is fitted on a bounded sample, ``MAX_TRAINING_ROWS`` labelled rows,
chosen by a hash of doc_id; labels of rows whose crc32(doc_id) mod 5 is 0 are
never read for it.  Terms get weights for either of two reasons: alone they tell
about the label, or, of the ``PAIR_TERMS`` most frequent ones, two together tell what
neither does, so that a harmless mention that only matters beside another word
is learned, too.  Spark counts the terms; the driver gets no more of a row than
the terms that may be chosen, so its share and the model's size are fixed.
Scoring covers every text whole.

Defined results: null and empty texts have the score of no terms; without
labels of both classes all scores are 0; a row whose doc_id is null counts as
held out; a document with several labels is toxic if one says so, and null
labels say nothing; an empty table gives no rows.  Other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesift.llm.common import place_of, plainly_named, settle, slices, table, text_of
from tablesift.llm.word_hash import Words

MAX_TRAINING_ROWS = 8_000
BITS = 20
ACTIVE_TERMS = 4096
FACTORS = 8
#: Standard deviations from the mean that a term's share of toxic rows must differ to get weights.
LEAST_Z = 3.0
#: The most frequent terms, of which pairs are tried; and by how many deviations the share of toxic rows
#: with both must differ from the shares of each, of half a million pairs; and the least rows that have both.
PAIR_TERMS = 1024
LEAST_PAIR_Z = 7.0
PAIR_ROWS = 10
EPOCHS = 300
#: Lengths of the stems, in bytes.
STEMS = (4, 5)
_PUNCTUATION = re.compile(r"""[.,;:!?()\[\]{}"'*_|<>/\\~#$%&=+-]+""")


def terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers, and the text that each is of; a text may have a term more than once."""
    words = Words([_PUNCTUATION.sub(" ", (t or "").lower()) for t in texts])
    kinds = [words.hashes(), *[words.hashes(n) + np.uint64(n) for n in STEMS]]
    return np.concatenate([h >> np.uint64(64 - BITS) for h in kinds]).astype(np.int32), np.concatenate([words.text] * len(kinds))


@dataclass(frozen=True)
class Machine:
    """A fitted factorization machine; ``slot`` has the place of each term, -1 for those without weights."""

    active: np.ndarray
    bias: float
    w: np.ndarray
    v: np.ndarray

    def scores(self, row: np.ndarray, place: np.ndarray, rows: int) -> np.ndarray:
        """Scores of ``rows`` texts from distinct (row, place) pairs."""
        logit = self.bias + np.bincount(row, self.w[place], rows)
        for f in range(self.v.shape[1]):
            own = self.v[place, f]
            logit += 0.5 * (np.bincount(row, own, rows) ** 2 - np.bincount(row, own * own, rows))
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    def score_texts(self, texts: list[str | None]) -> np.ndarray:
        slot = np.full(1 << BITS, -1, np.int16)
        slot[self.active] = np.arange(len(self.active))
        return self._score(texts, slot)

    def _score(self, texts: list[str | None], slot: np.ndarray) -> np.ndarray:
        term, row = terms(texts)
        place = slot[term]
        row, place = row[place >= 0], place[place >= 0].astype(np.int64)
        distinct = np.unique(row * len(self.active) + place) if len(row) else np.zeros(0, np.int64)
        return self.scores(distinct // max(len(self.active), 1), distinct % max(len(self.active), 1), len(texts))


def telling_pairs(row: np.ndarray, term: np.ndarray, labels: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Of the ``frequent`` terms, those of pairs that tell about the label what neither term tells alone, the best first."""
    place = np.full(1 << BITS, -1, np.int32)
    place[frequent] = np.arange(len(frequent))
    held = place[term] >= 0
    both, toxic = np.zeros((2, len(frequent), len(frequent)))
    for start in range(0, len(labels), 1024):  # some rows at a time, as a matrix of rows and terms
        own = held & (row >= start) & (row < start + 1024)
        x = np.zeros((min(1024, len(labels) - start), len(frequent)), np.float32)
        x[row[own] - start, place[term[own]]] = 1
        both += x.T @ x
        toxic += x.T @ (x * labels[start : start + 1024, None].astype(np.float32))
    alone = np.diag(toxic) / np.maximum(np.diag(both), 1)
    # How far the share of toxic rows with both terms is from that of rows with the one, in deviations.
    z = np.abs(toxic - both * alone[:, None]) / np.sqrt(both * alone[:, None] * (1 - alone[:, None]) + 0.5)
    z = np.minimum(z, z.T)
    z[both < PAIR_ROWS] = 0
    best = z.max(1, initial=0)
    order = np.argsort(-best, kind="stable")
    return frequent[order[best[order] > LEAST_PAIR_Z]]


def fit(row_terms: list[np.ndarray], labels: np.ndarray, active_terms: int = ACTIVE_TERMS, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 0) -> Machine | None:
    """Fit on distinct terms per row; None without both classes."""
    rows, positive = len(labels), int(labels.sum())
    if positive == 0 or positive == rows:
        return None
    row = np.repeat(np.arange(rows, dtype=np.int32), [len(t) for t in row_terms])
    term = np.concatenate(row_terms)
    with_label = np.bincount(term, labels[row], 1 << BITS)
    seen = np.bincount(term, minlength=1 << BITS).astype(float)
    # How far a term's share of toxic rows is from all rows' share, in standard deviations.
    share = positive / rows
    z = np.abs(with_label - seen * share) / np.sqrt(np.maximum(seen * share * (1 - share), 1e-9) + 0.5)
    z[(seen < 2) | (seen == rows)] = 0
    alone = np.argsort(-z, kind="stable")[:active_terms]
    seen[seen == rows] = 0
    frequent = np.argsort(-seen, kind="stable")[:PAIR_TERMS]
    chosen = np.concatenate([alone[z[alone] > LEAST_Z], telling_pairs(row, term, labels, frequent[seen[frequent] > 0])])
    _, first = np.unique(chosen, return_index=True)
    active = np.sort(chosen[np.sort(first)][:active_terms])
    slot = np.full(1 << BITS, -1, np.int64)
    slot[active] = np.arange(len(active))
    held = slot[term] >= 0
    row, place = row[held], slot[term[held]]
    del term, held, with_label, seen, z
    rng = np.random.default_rng(seed)
    k = len(active)
    x = {"bias": np.zeros(1), "w": np.zeros(k), "v": rng.normal(0, 0.01, (k, factors))}
    moment = {n: [np.zeros_like(a), np.zeros_like(a)] for n, a in x.items()}
    # Both classes weigh the same.
    weight = np.where(labels == 1, rows / positive, rows / (rows - positive))
    weight /= weight.sum()
    decay = {"bias": 0.0, "w": 2e-5, "v": 2e-4}
    for epoch in range(1, epochs + 1):
        machine = Machine(active, float(x["bias"][0]), x["w"], x["v"])
        error = (machine.scores(row, place, rows) - labels) * weight
        own = x["v"][place]
        sums = np.stack([np.bincount(row, own[:, f], rows) for f in range(factors)], 1)
        pull = error[row, None] * (sums[row] - own)
        gradient = {"bias": np.array([error.sum()]), "w": np.bincount(place, error[row], k), "v": np.stack([np.bincount(place, pull[:, f], k) for f in range(factors)], 1)}
        for n, a in x.items():
            g = gradient[n] + decay[n] * a
            first, second = moment[n]
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            a -= 0.05 * (first / (1 - 0.9**epoch)) / (np.sqrt(second / (1 - 0.999**epoch)) + 1e-8)
    return Machine(active, float(x["bias"][0]), x["w"], x["v"])


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> Machine | None:
    """Fit on at most ``max_rows`` labelled documents that aren't held out."""
    known = labels.filter(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # At most max_rows ids and labels, so it may be broadcast.
    sample = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                term, row = terms(batch.column("text").to_pylist())
                keys = np.unique(row.astype(np.int64) << BITS | term)
                ends = np.searchsorted(keys >> BITS, np.arange(batch.num_rows + 1)).astype(np.int32)
                own = pa.ListArray.from_arrays(pa.array(ends), pa.array((keys & ((1 << BITS) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic").cast(pa.int64()), own], ["doc_id", "toxic", "terms"])

    # A document id that occurs on several rows would go beyond the bound: one row of each.
    found = sample.mapInArrow(collect, "doc_id long, toxic long, terms array<int>").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.min("terms").alias("terms"))
    found = settle(found)
    rows, positive = found.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not positive or positive == rows:
        return None
    share = positive / rows
    counted = found.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("seen"), F.sum("toxic").alias("toxic")).filter(F.col("seen") < rows)
    counted = settle(counted.withColumn("z", F.abs(F.col("toxic") - F.col("seen") * share) / F.sqrt(F.col("seen") * share * (1 - share) + 0.5)))
    telling = counted.filter((F.col("z") > LEAST_Z) & (F.col("seen") > 1)).orderBy(F.desc("z"), "term").limit(ACTIVE_TERMS)
    frequent = counted.orderBy(F.desc("seen"), "term").limit(PAIR_TERMS)
    # At most ACTIVE_TERMS and PAIR_TERMS numbers.
    wanted = np.array([r[0] for r in telling.union(frequent).select("term").distinct().collect()], np.int32)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.array(t, np.int32) for t in batch.column("terms").to_pylist()]
            packed = [t[np.isin(t, wanted)].tobytes() for t in own]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(packed, pa.binary())], ["doc_id", "toxic", "terms"])

    got = found.mapInArrow(keep, "doc_id long, toxic long, terms binary").orderBy("doc_id").toPandas()
    return fit([np.frombuffer(t, np.int32) for t in got["terms"]], got["toxic"].to_numpy(float))


def scored(docs: DataFrame, machine: Machine | None, text: str = "text", score: str = "score") -> DataFrame:
    """Add the score to every row, as column ``score``."""
    if machine is None:
        return docs.withColumn(score, F.lit(0.0))
    plain, place = plainly_named(docs), place_of(docs, text)
    kept = [(f"c{i}", name) for i, name in enumerate(docs.columns) if name != score]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(1 << BITS, -1, np.int16)
        slot[machine.active] = np.arange(len(machine.active))
        for whole in batches:
            for batch in slices(whole, place, 1 << 20):
                found = machine._score(batch.column(place).to_pylist(), slot)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c, _ in kept], pa.array(found, pa.float64())], [*[c for c, _ in kept], "score"])

    schema = T.StructType([*[plain.schema[c] for c, _ in kept], T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*[name for _, name in kept], score)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    machine = train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored(docs, machine).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

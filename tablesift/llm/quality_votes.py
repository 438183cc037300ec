"""Quality by votes of the nearest labelled texts in a latent semantic space (operator 13).

A text's terms are its words, the shapes of its words (letters, capitals and digits as one
sign each, other signs as they are, so that ``Rewh.###`` is ``ul.###``), pairs of
shapes, and words that repeat the one before.  Terms are hashed; their counts, damped
and weighed by how rare a term is among labelled texts, are projected on the
strongest directions of the labelled texts, found by iterating a subspace.  Labelled texts
so become vectors of ``DIRECTIONS`` numbers, which are broadcast: ``MAX_TRAINING_ROWS``
of them at most, with a projection of ``2 ** BITS`` rows at most, whatever the corpus holds.

Every document is projected likewise, and its cosines with all the labelled vectors are
computed exactly, a block of documents at a time as a matrix product.  The ``NEIGHBOURS``
nearest vote, with their similarity, to a power, as weight; those that are as near as
the last of them vote, too.

Defined results: null, empty and white texts have no direction and get the share of
label 1 among labelled texts, as do texts of which no term is known; without labels all scores are
0.5, with labels of one class that label; a document that has several labels counts once, with
the largest; rows with equal doc_id are scored one by one; all other columns pass, but one with the
score's name; texts are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesift.llm.common import place_of, plainly_named, settle, slices, table, text_of
from tablesift.llm.toxicity import held_out
from tablesift.llm.word_hash import Words, mix

MAX_TRAINING_ROWS = 8_000
BITS = 16
DIRECTIONS = 48
NEIGHBOURS = 15
#: The power of a similarity that is a vote's weight.
POWER = 4
#: Weights of terms by kind: words, shapes, pairs of shapes, repeated words, and what share of words those are.
KINDS = np.array([0.3, 3.0, 2.0, 6.0, 6.0])
#: Labelled texts that a term must be in to count.
LEAST_TEXTS = 2
ROUNDS = 4
#: Documents that are compared with all labelled ones at a time.
BLOCK = 256
#: Cosines are told apart by this many bits, so that equal labelled texts tie whatever the order of sums.
COSINE_BITS = 20
PREDICTED_FROM = 0.3

_LOWER, _UPPER, _DIGIT = b"lud"
_SIGNS = bytes(_LOWER if 97 <= b <= 122 or b >= 128 else _UPPER if 65 <= b <= 90 else _DIGIT if 48 <= b <= 57 else b for b in range(256))


def shapes(text: str) -> str:
    """The shapes of the words: a run of letters or digits is one sign, one of capitals two at most."""
    signs = np.frombuffer(text.encode().translate(_SIGNS), np.uint8)
    again = np.zeros(len(signs), bool)
    again[1:] = signs[1:] == signs[:-1]
    twice = np.zeros(len(signs), bool)
    twice[1:] = again[1:] & again[:-1]
    gone = (again & ((signs == _LOWER) | (signs == _DIGIT))) | (twice & (signs == _UPPER))
    return signs[~gone].tobytes().decode()


def counted_terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and damped count, weighed by the term's kind, of the distinct terms of each text, by text."""
    words, shaped = Words(texts), Words([shapes(t or "") for t in texts])
    own, form = words.hashes(), mix(shaped.hashes() + np.uint64(1))
    same = words.text[1:] == words.text[:-1]
    pairs = mix(form[:-1] + np.uint64(3) * form[1:])[same]
    again = (own[1:] == own[:-1]) & same
    size = np.bincount(words.text, minlength=len(texts))
    repeated = np.bincount(words.text[1:][again], minlength=len(texts))
    # Eighths of the words that repeat the one before.
    some = np.flatnonzero(repeated)
    share = mix((8 * repeated[some] // size[some]).astype(np.uint64) + np.uint64(5))
    parts = [(words.text, own), (words.text, form), (words.text[1:][same], pairs), (words.text[1:][again], np.full(int(again.sum()), mix(np.array([4], np.uint64))[0])), (some, share)]
    kind = np.concatenate([np.full(len(t), k) for k, (t, _) in enumerate(parts)])
    term = np.concatenate([h for _, h in parts]) >> np.uint64(64 - BITS)
    key = np.concatenate([t for t, _ in parts]).astype(np.int64) << BITS | term.astype(np.int64)
    key, first, many = np.unique(key, return_index=True, return_counts=True)
    return key >> BITS, key & ((1 << BITS) - 1), np.log1p(many) * KINDS[kind[first]]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def _sums(values: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    """Sums of rows by ascending keys."""
    out = np.zeros((size, values.shape[1]), values.dtype)
    if len(keys):
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        out[keys[starts]] = np.add.reduceat(values, starts, axis=0)
    return out


def _product(keys: np.ndarray, others: np.ndarray, weights: np.ndarray, x: np.ndarray, size: int, cells: int = 1 << 22) -> np.ndarray:
    """A sparse matrix, given by ascending row, by column and by value, times ``x``."""
    out = np.zeros((size, x.shape[1]), x.dtype)
    step = max(1, cells // x.shape[1])
    for start in range(0, len(keys), step):
        own = slice(start, start + step)
        low, high = keys[own][0], keys[own][-1] + 1
        out[low:high] += _sums(weights[own, None] * x[others[own]], keys[own] - low, high - low)
    return out


@dataclass(frozen=True)
class Voters:
    """Labelled texts as vectors, and what makes a vector of a text."""

    rarity: np.ndarray  # by term; 0 for one that isn't known
    projection: np.ndarray  # by term
    vectors: np.ndarray
    labels: np.ndarray

    def vectors_of(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
        """Vectors of length 1 of ``rows`` texts, from their terms by text; zero for a text without any."""
        return _unit(_product(row, term, (weight * self.rarity[term]).astype(np.float32), self.projection, rows))

    def score(self, texts: list[str | None]) -> np.ndarray:
        found = self.vectors_of(*counted_terms(texts), len(texts))
        out = np.empty(len(texts))
        for start in range(0, len(texts), BLOCK):
            out[start : start + BLOCK] = self.votes(found[start : start + BLOCK])
        return out

    def votes(self, own: np.ndarray) -> np.ndarray:
        near = np.rint(own @ self.vectors.T * np.float32(1 << COSINE_BITS)).astype(float)
        k = min(NEIGHBOURS, near.shape[1])
        least = np.partition(near, -k, axis=1)[:, -k, None]
        weight = np.where(near >= np.maximum(least, 0), near / (1 << COSINE_BITS), 0.0) ** POWER
        # Where nothing is near, the share of label 1 is left.
        little = 1e-9
        return np.clip((weight @ self.labels + little * self.labels.mean()) / (weight.sum(1) + little), 0.0, 1.0)


def fit(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, directions: int = DIRECTIONS, rounds: int = ROUNDS, seed: int = 0) -> Voters:
    """From each labelled text's terms and their weights."""
    size, rows = 1 << BITS, len(texts)
    row = np.repeat(np.arange(rows), [len(t) for t, _ in texts])
    term = np.concatenate([t for t, _ in texts]).astype(np.int64)
    weight = np.concatenate([w for _, w in texts])
    seen = np.bincount(term, minlength=size)
    rarity = np.where(seen >= min(LEAST_TEXTS, rows), np.log((rows + 1) / (seen + 1)), 0.0)
    weight = weight * rarity[term]
    weight /= np.maximum(np.sqrt(np.bincount(row, weight * weight, rows)), 1e-12)[row]
    weight = weight.astype(np.float32)
    # Only terms that are seen take part; the others' rows of the projection stay zero.
    known = np.flatnonzero(np.bincount(term, weight, size))
    slot = np.zeros(size, np.int64)
    slot[known] = np.arange(len(known))
    own = weight > 0
    row, place, weight = row[own], slot[term[own]], weight[own]
    by_term = np.argsort(place, kind="stable")
    directions = min(directions, len(known), rows)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(known), directions)).astype(np.float32))[0]
    for _ in range(rounds):
        held = _product(row, place, weight, basis, rows)
        basis = np.linalg.qr(_product(place[by_term], row[by_term], weight[by_term], held, len(known)))[0]
    projection = np.zeros((size, directions), np.float32)
    projection[known] = basis
    return Voters(rarity, projection, _unit(_product(row, place, weight, basis, rows)), labels)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAINING_ROWS) -> Voters | float:
    """Voters from at most ``max_rows`` labelled documents that aren't held out; where these are of one class or none, the score of all texts."""
    known = labels.filter(~held_out() & F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("long").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # At most max_rows ids and labels, so it may be broadcast.
    sample = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                row, term, weight = counted_terms(batch.column("text").to_pylist())
                ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
                packed = [[x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])] for x in (term.astype("<i4"), weight.astype("<f4"))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *[pa.array(p, pa.binary()) for p in packed]], ["doc_id", "label", "terms", "weights"])

    # A document id that occurs on several rows would go beyond the bound: one row of each.
    found = sample.mapInArrow(collect, "doc_id long, label long, terms binary, weights binary").groupBy("doc_id").agg(F.min(F.struct("label", "terms", "weights")).alias("own"))
    got = settle(found.select("doc_id", "own.*")).orderBy("doc_id").toPandas()
    own = got["label"].to_numpy(float)
    if not len(own) or own.min() == own.max():
        return float(own[0]) if len(own) else 0.5
    if not got["terms"].map(len).any():
        return float(own.mean())
    return fit([(np.frombuffer(t, "<i4"), np.frombuffer(w, "<f4")) for t, w in zip(got["terms"], got["weights"])], own)


def scored(docs: DataFrame, voters: Voters | float, text: str = "text", score: str = "score") -> DataFrame:
    """Add the score to every row, as column ``score``."""
    if not isinstance(voters, Voters):
        return docs.withColumn(score, F.lit(voters))
    plain, place = plainly_named(docs), place_of(docs, text)
    kept = [(f"c{i}", name) for i, name in enumerate(docs.columns) if name != score]
    sent = docs.sparkSession.sparkContext.broadcast(voters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, place, 1 << 20):
                found = sent.value.score(batch.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c, _ in kept], pa.array(found, pa.float64())], [*[c for c, _ in kept], "score"])

    schema = T.StructType([*[plain.schema[c] for c, _ in kept], T.StructField("score", T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*[name for _, name in kept], score)


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    voters = train(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored(docs, voters).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= PREDICTED_FROM).cast("int").alias("predicted"))

"""Hard negatives of anchors by exact integer products (operator 12).

A row's score for an anchor is the inner product of their components as integers.
Anchors are a set share of the rows, so each block of anchors meets each block of
rows.  A pair of blocks is worked off in tiles:

* a tile's scores are one product of integer matrices by Strassen's recursion: seven
  products of halves instead of eight, with rows and columns of zeros where a
  size is odd.  Sums are exact, and as 64-bit integers are a ring, so is the result
  whatever overflows on the way, as long as the scores themselves fit;
* each anchor keeps its best rows of the same label in a heap.  Heaps of several blocks
  are merged in the task and, as a few rows for an anchor, over tasks: these are the
  positives;
* a second pass over the tiles keeps, for each anchor and positive, a heap of the
  best rows of other labels whose score lies in the positive's window, merged likewise.

A heap holds at most so many rows as are asked for, and a tile's rows that are below
what a heap holds already are passed over, so neither a label with most of the rows
nor a large table makes more than that.

Rows with a component too large for scores of 64 bits are multiplied as Python's
integers, apart from the others; where such a score can't be told as a ``long``, it is
given as the nearest one, in its true place.

Defined results: rows with a null id, label or vector, an empty vector, null or
non-finite components, or another number of components than most rows take no part;
a row with an anchor's id is neither its positive nor its negative; of several
anchors with one id the least by label and vector stands for all; other rows with equal
ids are rows of their own; an anchor without positives, or a positive without
rows in its window, has no rows; an empty table gives none.  Other columns are not read.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesift.llm.common import settle, table

POSITIVES = 5
NEGATIVES = 10
SCALE = 256
#: Bounds of a negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Bytes of vectors in a block of anchors and in one of rows, and rows in a tile.
ANCHOR_BYTES, ROW_BYTES = 1 << 18, 1 << 21
TILE = 1024
#: Sizes below which a product isn't halved again: of rows and columns, and of what is summed over.
LEAF, LEAST_DEPTH = 64, 16
#: Lengths below this make scores below 2**62.
_SAFE = float(1 << 31)

_BLOCK = "ids binary, labels binary, vectors binary, bounds binary"


def _even(a: np.ndarray) -> np.ndarray:
    """With a row and a column of zeros where their count is odd."""
    out = np.zeros((a.shape[0] + a.shape[0] % 2, a.shape[1] + a.shape[1] % 2), a.dtype)
    out[: a.shape[0], : a.shape[1]] = a
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF, depth: int = LEAST_DEPTH) -> np.ndarray:
    """The product of integer matrices."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, n) < 2 * leaf or k < 2 * depth:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        return strassen(_even(a), _even(b), leaf, depth)[:m, :n]
    i, j, l = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22, leaf, depth)
    p2 = strassen(a21 + a22, b11, leaf, depth)
    p3 = strassen(a11, b12 - b22, leaf, depth)
    p4 = strassen(a22, b21 - b11, leaf, depth)
    p5 = strassen(a11 + a12, b22, leaf, depth)
    p6 = strassen(a21 - a11, b11 + b12, leaf, depth)
    p7 = strassen(a12 - a22, b21 + b22, leaf, depth)
    out = np.empty((m, n), a.dtype)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out


def _integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python's where they may be too large; ``scale`` is a power of two."""
    if not x.size or np.abs(x).max() * scale < 2.0**62:
        return np.floor(x * scale).astype(np.int64)
    # A double above 2**53 is an integer.
    return np.array([[int(v) * scale if abs(v) >= 2.0**53 else int(np.floor(v * scale)) for v in row] for row in x.tolist()], object)


class Rows:
    """Rows of a block: ids, labels, vectors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, scale: int):
        self.ids, self.labels = ids, labels
        # Lengths by the largest component, as squares could be too large for a double.
        most = np.abs(x).max(1, initial=0) * np.sqrt(x.shape[1]) * scale
        self.parts = []
        for own in (np.flatnonzero(most < _SAFE), np.flatnonzero(most >= _SAFE)):
            for start in range(0, len(own), TILE):
                some = own[start : start + TILE]
                self.parts.append((some, _integers(x[some], scale)))

    def tiles(self, anchors: Rows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers of anchors and of rows, and their scores."""
        for own, x in self.parts:
            for at, y in anchors.parts:
                if x.dtype == y.dtype == np.int64 and abs(x).max(initial=0) < _SAFE and abs(y).max(initial=0) < _SAFE:
                    yield at, own, strassen(y, x.T)
                else:
                    yield at, own, strassen(y.astype(object), x.T.astype(object))


class Heaps:
    """The best rows for each of some places, at most ``k`` each: highest score first, then smallest id."""

    def __init__(self, places: int, k: int):
        self.k = k
        self.heaps: list[list[tuple[int, int]]] = [[] for _ in range(places)]

    def add(self, places: np.ndarray, ids: np.ndarray, scores: np.ndarray, good: np.ndarray) -> None:
        """Scores of rows ``ids`` for each of ``places``, those marked as good."""
        least = [self.heaps[p][0][0] if len(self.heaps[p]) == self.k else None for p in places.tolist()]
        if scores.dtype != object:
            floor = np.array([np.iinfo(np.int64).min if x is None else max(min(x, np.iinfo(np.int64).max), np.iinfo(np.int64).min) for x in least])
            open_ = np.array([x is None for x in least])
            if open_.any() and scores.shape[1] > self.k:
                held = np.where(good[open_], scores[open_], np.iinfo(np.int64).min)
                floor[open_] = np.partition(held, -self.k, axis=1)[:, -self.k]
            good = good & (scores >= floor[:, None])
        i, j = np.nonzero(good)
        for place, score, own in zip(places[i].tolist(), scores[i, j].tolist(), ids[j].tolist()):
            self.push(place, score, own)

    def push(self, place: int, score: int, own: int) -> None:
        heap, item = self.heaps[place], (score, -own)
        if len(heap) < self.k:
            heapq.heappush(heap, item)
        elif item > heap[0]:
            heapq.heapreplace(heap, item)


def wide(score: int) -> bytes | None:
    """What orders scores that a long can't hold, or holds last: their bytes compare as they do."""
    if -(1 << 63) < score < (1 << 63) - 1:
        return None
    size = (score.bit_length() + 8) // 8
    # The sign and the count of bytes first; of negative numbers the longer one is less.
    return (b"\x01" + size.to_bytes(4) if score > 0 else b"\x00" + (0xFFFFFFFF - size).to_bytes(4)) + (score + (0 if score > 0 else 1 << 8 * size)).to_bytes(size)


def whole(score: int, told: bytes | None) -> int:
    """The score from a long and ``wide``."""
    if told is None:
        return score
    value = int.from_bytes(told[5:])
    return value if told[0] else value - (1 << 8 * (len(told) - 5))


def _long(score: int) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, score))


def _in_order() -> list[Column]:
    # Beyond the largest long those with bytes come first; at the smallest one they come last.
    return [F.desc("score"), F.when(F.col("score") < 0, F.col("wide").isNotNull()).otherwise(F.col("wide").isNull()), F.desc("wide"), F.col("vec_id")]


def usable(vectors: DataFrame, vector: str = "embedding", label: Column | None = None) -> DataFrame:
    """vec_id, label and vector of the rows that take part; of vectors as many components as most have."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kind = vectors.schema[vector].dataType.elementType.simpleString()
    x = F.col(vector) if kind in ("float", "double") else F.col(vector).cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"), x.alias(vector))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)))
    most = rows.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size(vector) == (most["n"] if most else 0))


def blocks(rows: DataFrame, vector: str, size: int) -> DataFrame:
    """Pack rows into blocks of about ``size`` bytes of vectors; ``bounds`` of anchors, if there are any, are packed as they are."""
    kind = "<f4" if rows.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    bounded = "bounds" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, data, bounds, held = [], [], [], [], 0

        def block() -> pa.RecordBatch:
            made = [np.concatenate(ids).tobytes(), np.concatenate(labels).tobytes(), np.concatenate(data).tobytes(), json.dumps(sum(bounds, [])).encode()]
            return pa.RecordBatch.from_arrays([pa.array([m], pa.binary()) for m in made], ["ids", "labels", "vectors", "bounds"])

        for whole_ in batches:
            flat = whole_.column(vector).flatten()
            each = max(1, size // (np.dtype(kind).itemsize * max(1, len(flat) // max(1, whole_.num_rows))))
            start = 0
            while start < whole_.num_rows:
                batch = whole_.slice(start, each - held)
                start += batch.num_rows
                ids.append(batch.column("vec_id").to_numpy(zero_copy_only=False).astype("<i8"))
                labels.append(batch.column("label").to_numpy(zero_copy_only=False).astype("<i8"))
                data.append(batch.column(vector).flatten().to_numpy(zero_copy_only=False).astype(kind))
                if bounded:
                    bounds.append([[whole(p["score"], p["wide"]) for p in own] for own in batch.column("bounds").to_pylist()])
                held += batch.num_rows
                if held >= each:
                    yield block()
                    ids, labels, data, bounds, held = [], [], [], [], 0
        if held:
            yield block()

    return rows.mapInArrow(run, _BLOCK)


def _met(anchors: DataFrame, rows: DataFrame, cells: int) -> DataFrame:
    """Each block of anchors beside each block of rows, those of one block of anchors one after another in a task."""
    everywhere = settle(anchors.withColumn("block", F.monotonically_increasing_id())).withColumnsRenamed({"ids": "anchor_ids", "labels": "anchor_labels", "vectors": "anchors"})
    everywhere = everywhere.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))))
    return everywhere.join(rows.drop("bounds"), "cell").sortWithinPartitions("block")


def _block(batch: pa.RecordBatch, at: int, names: tuple[str, str, str], kind: str, scale: int) -> Rows:
    ids, labels, data = (batch.column(n)[at].as_buffer() for n in names)
    ids = np.frombuffer(ids, "<i8")
    return Rows(ids, np.frombuffer(labels, "<i8"), np.frombuffer(data, kind).reshape(len(ids), -1).astype(float), scale)


_OF_ANCHORS, _OF_ROWS = ("anchor_ids", "anchor_labels", "anchors"), ("ids", "labels", "vectors")


def _merged(met: DataFrame, kind: str, scale: int, heaps, columns: str) -> DataFrame:  # noqa: ANN001
    """Fill the heaps of each block of anchors from all the blocks of rows that meet it in a task.

    ``heaps`` gets the anchors and their bounds and returns heaps, a function that adds a tile to them, and one that makes their rows.
    """
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = {"anchor_id": pa.int64(), "positive": pa.int32(), "vec_id": pa.int64(), "score": pa.int64(), "wide": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, anchors, add, made = None, None, None, None

        def told() -> Iterator[pa.RecordBatch]:
            if made is not None and (out := made()):
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for c, n in zip(zip(*out), names)], names)

        for batch in batches:
            for at in range(batch.num_rows):
                if (own := batch.column("block")[at].as_py()) != block:
                    yield from told()
                    block, anchors = own, _block(batch, at, _OF_ANCHORS, kind, scale)
                    add, made = heaps(anchors, batch.column("bounds")[at].as_py())
                rows = _block(batch, at, _OF_ROWS, kind, scale)
                for some, own_rows, scores in rows.tiles(anchors):
                    add(some, rows, own_rows, scores)
        yield from told()

    return met.select("block", *_OF_ANCHORS, "bounds", *_OF_ROWS).mapInArrow(run, columns)


def positive_heaps(k: int):  # noqa: ANN201
    def heaps(anchors: Rows, _: bytes):  # noqa: ANN202
        held = Heaps(len(anchors.ids), k)

        def add(some: np.ndarray, rows: Rows, own: np.ndarray, scores: np.ndarray) -> None:
            same = (anchors.labels[some, None] == rows.labels[own]) & (anchors.ids[some, None] != rows.ids[own])
            held.add(some, rows.ids[own], scores, same)

        def made() -> list[tuple]:
            return [(anchor, -neg, _long(score), wide(score)) for anchor, heap in zip(anchors.ids.tolist(), held.heaps) for score, neg in heap]

        return add, made

    return heaps


def window_heaps(k: int, low: int, high: int):  # noqa: ANN201
    def heaps(anchors: Rows, bounds: bytes):  # noqa: ANN202
        own_bounds: list[list[int]] = json.loads(bounds)
        most = max(map(len, own_bounds), default=0)
        held = [Heaps(len(anchors.ids), k) for _ in range(most)]
        # Whole scores in the window: 100 * score between low and high hundredths of the positive's; none where there is no positive.
        floors = [[-(-low * b[p] // 100) if p < len(b) else 1 for b in own_bounds] for p in range(most)]
        tops = [[high * b[p] // 100 if p < len(b) else 0 for b in own_bounds] for p in range(most)]

        def add(some: np.ndarray, rows: Rows, own: np.ndarray, scores: np.ndarray) -> None:
            other = (anchors.labels[some, None] != rows.labels[own]) & (anchors.ids[some, None] != rows.ids[own])
            for p in range(most):
                lo, hi = [floors[p][i] for i in some.tolist()], [tops[p][i] for i in some.tolist()]
                if scores.dtype != object:
                    # A bound beyond 64 bits lets all scores of 64 bits pass, or none.
                    none = np.array([a > (1 << 63) - 1 or b < -(1 << 63) for a, b in zip(lo, hi)])
                    lo, hi = np.array([_long(a) for a in lo]), np.array([_long(b) for b in hi])
                    good = other & (scores >= lo[:, None]) & (scores <= hi[:, None]) & ~none[:, None]
                else:
                    good = other & np.array(scores >= np.array(lo, object)[:, None], bool) & np.array(scores <= np.array(hi, object)[:, None], bool)
                held[p].add(some, rows.ids[own], scores, good)

        def made() -> list[tuple]:
            return [(anchor, p, -neg, _long(score), wide(score)) for p, h in enumerate(held) for anchor, heap in zip(anchors.ids.tolist(), h.heaps) for score, neg in heap]

        return add, made

    return heaps


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    vector: str = "embedding",
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    anchor_bytes: int = ANCHOR_BYTES,
    row_bytes: int = ROW_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score and negative_score.

    ``scale`` is a power of two; components are taken as floor(scale * component).  ``label`` says which label counts, if not the column itself.
    """
    good = usable(vectors, vector, label)
    kind = "<f4" if good.schema[vector].dataType.elementType.simpleString() == "float" else "<f8"
    rows = settle(blocks(good, vector, row_bytes).withColumn("cell", F.monotonically_increasing_id()))
    cells = max(rows.count(), 1)
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("cell"), F.lit(cells)))
    # Anchors with their vectors are a set share of the rows.
    anchors = settle(good.filter(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", vector)).alias("own")).select("vec_id", "own.*"))
    met = _met(blocks(anchors, vector, anchor_bytes), rows, cells)
    best = _merged(met, kind, scale, positive_heaps(positives), "anchor_id long, vec_id long, score long, wide binary")
    of_anchor = Window.partitionBy("anchor_id").orderBy(*_in_order())
    best = settle(best.withColumn("positive", F.row_number().over(of_anchor) - 1).filter(F.col("positive") < positives))
    bounds = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_list(F.struct("positive", "score", "wide"))).alias("bounds"))  # at most ``positives`` each
    met = _met(blocks(anchors.join(bounds, "vec_id"), vector, anchor_bytes), rows, cells)
    found = _merged(met, kind, scale, window_heaps(negatives, low, high), "anchor_id long, positive int, vec_id long, score long, wide binary")
    of_positive = Window.partitionBy("anchor_id", "positive").orderBy(*_in_order())
    found = found.withColumn("rank", F.row_number().over(of_positive)).filter(F.col("rank") <= negatives)
    told = best.select("anchor_id", "positive", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(told, ["anchor_id", "positive"]).select(
        "anchor_id", "positive_id", (F.col("positive") + 1).alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; labels of every seventh are the next ones."""
    own = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), F.col("vec_id") % 100 == 0, label=own)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS positive_rank
  FROM s WHERE same),
n AS (
  SELECT p.anchor_id, positive_id, CAST(positive_rank AS INTEGER) AS positive_rank,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_rank ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id AS negative_id, positive_score, score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
   AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
  WHERE positive_rank <= 5)
SELECT * FROM n WHERE rank <= 10
"""

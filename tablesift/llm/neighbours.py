"""Nearest neighbours by a block matrix join (operator 9).

Queries and candidates are packed into blocks, and every query block meets
every candidate block: queries that are a set share of the table against all of
it.  A pair of blocks is worked off in tiles:

* vectors are quantised to int8 with a scale of their own, and one matrix
  product per tile gives all inner products nearly;
* how far an inner product of quantised vectors can be off follows from the
  lengths of what rounding left: pairs whose upper bound is below what the
  query's k-th best is at least are done;
* the others are recomputed from the original vectors in double precision, in
  the order of the components, so that equal vectors have equal scores;
* each query keeps its best in a heap over the tiles.

Only the best of each query and block are shuffled, for the final ranking.
The result is exact.

Defined results: vectors that are null, empty, zero or have null or non-finite
components take no part, nor do those of another length than most; of rows
with the same vec_id that are queries, one stands for all, and none of them is
its own candidate; equal scores are ranked by vec_id; scores too large for a double are
infinite, or no number where such parts cancel, which counts as largest; an empty table gives no
rows.  Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesift.llm.common import settle, table

QUERY_BLOCK = 512
CANDIDATE_BLOCK = 8192
TILE = 2048
NEAREST = 20

_BLOCK = "ids binary, vectors binary"


def usable(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Vectors that take part, as doubles."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.withColumn(vector, x).filter(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists(F.col(vector), lambda c: c != 0), F.lit(False)))


def blocks(vectors: DataFrame, rows: int, vector: str = "embedding") -> DataFrame:
    """Pack vec_ids (64-bit integers) and vectors (doubles) of up to ``rows`` rows into one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, data, held = [], [], 0

        def block() -> pa.RecordBatch:
            made = [np.concatenate(ids).tobytes(), np.concatenate(data).tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([m], pa.binary()) for m in made], ["ids", "vectors"])

        for whole in batches:
            for start in range(0, whole.num_rows, rows):
                batch = whole.slice(start, rows)
                if held and held + batch.num_rows > rows:
                    yield block()
                    ids, data, held = [], [], 0
                ids.append(batch.column("vec_id").to_numpy(zero_copy_only=False).astype("<i8"))
                data.append(batch.column(vector).flatten().to_numpy(zero_copy_only=False).astype("<f8"))
                held += batch.num_rows
        if held:
            yield block()

    return vectors.select("vec_id", vector).mapInArrow(run, _BLOCK)


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 components, scale, and the lengths of the vector, of its quantised form and of what rounding left."""
    scale = np.abs(x).max(1) / 127
    scale[scale == 0] = 1
    q = np.rint(x / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    length = lambda a: np.sqrt((a * a).sum(1))
    return q, scale, length(x), length(back), length(x - back)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in the order of the components."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def scaled(x: np.ndarray) -> tuple[np.ndarray, int]:
    """``x`` by a power of two with components of 1 at most, so that lengths are numbers, however large the components; and its exponent."""
    exponent = int(np.frexp(np.abs(x).max(initial=0))[1])
    return np.ldexp(x, -exponent), exponent


def best_of_blocks(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, tile: int = TILE) -> list[list[tuple[bool, float, int]]]:
    """For each query a heap of its k nearest in a block, as (is no number, score, -vec_id); what is no number counts as largest."""
    with np.errstate(over="ignore", invalid="ignore"):
        return _best_of_blocks(query_ids, queries, ids, vectors, k, tile)


def _best_of_blocks(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, tile: int) -> list[list[tuple[bool, float, int]]]:
    heaps: list[list[tuple[bool, float, int]]] = [[] for _ in query_ids]
    small, power = scaled(queries)
    qq, qs, qlen, _, qrest = quantised(small)
    # Products of int8 vectors are sums below 2**24, exact in single precision, up to this length.
    kind = np.float32 if queries.shape[1] <= 1000 else np.float64
    qq = qq.astype(kind)
    for start in range(0, len(ids), tile):
        own, x = ids[start : start + tile], vectors[start : start + tile]
        small, own_power = scaled(x)
        cq, cs, clen, cback, crest = quantised(small)
        near = (qq @ cq.astype(kind).T).astype(np.float64) * qs[:, None] * cs
        off = qrest[:, None] * cback + qlen[:, None] * crest + 1e-9 * qlen[:, None] * clen
        # Bounds of the scores as they are; those that are too large for a double, or no number, decide nothing.
        upper, lower = np.ldexp(near + off, power + own_power), np.ldexp(near - off, power + own_power)
        other = query_ids[:, None] != own
        lower = np.where(other & np.isfinite(lower) & np.isfinite(upper), lower, -np.inf)
        least = np.array([(np.inf if h[0][0] else h[0][1]) if len(h) == k else -np.inf for h in heaps])
        if lower.shape[1] >= k:
            least = np.maximum(least, np.partition(lower, -k, axis=1)[:, -k])
        i, j = np.nonzero(other & (~np.isfinite(upper) | (upper >= least[:, None])))
        for q, score, vec_id in zip(i.tolist(), exact(queries[i], x[j]).tolist(), own[j].tolist()):
            item = (score != score, 0.0 if score != score else score, -vec_id)
            if len(heaps[q]) < k:
                heapq.heappush(heaps[q], item)
            elif item > heaps[q][0]:
                heapq.heapreplace(heaps[q], item)
    return heaps


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST, vector: str = "embedding", query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` nearest rows."""
    good = usable(vectors.select("vec_id", vector), vector)
    lengths = good.groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    good = good.filter(F.size(vector) == (lengths["n"] if lengths else 0))
    candidates = blocks(good, candidate_block, vector)
    queries = blocks(good.filter(is_query).groupBy("vec_id").agg(F.min(vector).alias(vector)), query_block, vector)
    candidates = settle(candidates.withColumn("cell", F.monotonically_increasing_id()))
    # Candidate blocks are dealt to about as many cells; each query block goes to all cells.
    cells = max(candidates.count(), 1)
    candidates = candidates.withColumn("cell", F.pmod(F.xxhash64("cell"), F.lit(cells)))
    everywhere = settle(queries).withColumnsRenamed({"ids": "query_ids", "vectors": "queries"}).withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))))
    met = everywhere.join(candidates, "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                qi, q, ci, c = (batch.column(n)[row].as_buffer() for n in ("query_ids", "queries", "ids", "vectors"))
                qi, ci = np.frombuffer(qi, "<i8"), np.frombuffer(ci, "<i8")
                heaps = best_of_blocks(qi, np.frombuffer(q, "<f8").reshape(len(qi), -1), ci, np.frombuffer(c, "<f8").reshape(len(ci), -1), k)
                flat = [(int(i), -neg, np.nan if odd else score) for i, heap in zip(qi, heaps) for odd, score, neg in heap]
                if flat:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat), (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    found = met.select("query_ids", "queries", "ids", "vectors").mapInArrow(run, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

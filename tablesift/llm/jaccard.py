"""Near duplicates: an exact Jaccard join on word shingles (operator 6).

A document's set is its distinct runs of five words.  Two sets are linked when
100 * |intersection| >= 80 * |union|; the result is the connected components.

Multiple-global-order filtering: whatever total order the shingles are put in,
two linked sets share one among the first ``n - ceil(0.8 n) + 1`` of each.

* Order 1 is by frequency, rarest first, then by hash.  Frequencies are counted
  over all documents in a table of ``2**COUNTERS`` counters, for any order is
  right and the counters only have to tell common from rare.  Candidates are
  found by a join on the prefixes under this order; the smaller of two sets
  needs fewer of them: ``n - ceil(2 * 0.8 / 1.8 * n) + 1``.
* Orders 2 and 3 are by hash, ascending and descending.  Candidates whose
  prefixes share nothing under either are dropped before they are verified.

Copies come in groups of any size, and within one all pairs would be links.  So
links are looked for in two steps.

1. Documents with the same text are one node.  Nodes that share the least hash
   under one of ``STARS`` random orders are compared with one of them, the one
   whose shingles are the most common: the text that the others were made
   from.  That makes one pair per node and order, and most copies join.
2. The prefix join then is one of components: a prefix token is kept once for
   each component that has it, and only tokens that two components share make
   a pair of them.  Members of such pairs are compared if they share a prefix
   token themselves.

No link between different components can be missed in step 2, as every pair of
nodes is in one component already or meets there.

Shingles are compared by 64-bit hashes.

Defined results: null, empty and white texts have empty sets and are linked
with nothing; texts of fewer than five words have one shingle, the whole; rows
with equal text are linked, those with the same doc_id but different texts are
nodes of their own; null doc_ids are no component's smallest unless it has no
other; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesift.llm.common import place_of, plainly_named, settle, slices, small, table, text_of, tidied
from tablesift.llm.word_hash import mix, shingle_sets

SHINGLE = 5
PERCENT = 80
COUNTERS = 21
STARS = 4
#: Counters of one row of the frequency table.
_CHUNK = 1 << 16
_SLICE = 1 << 20


def least_overlap(n: int, m: int, percent: int = PERCENT) -> int:
    """The smallest intersection of linked sets of n and m shingles."""
    return -(-percent * (n + m) // (100 + percent))


def probe_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def index_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-2 * percent * n // (100 + percent)) + 1


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for whole in batches:
        for batch in slices(whole, "text", _SLICE):
            yield batch, shingle_sets(batch.column("text").to_pylist(), SHINGLE)


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def frequencies(docs: DataFrame) -> np.ndarray:
    """How many texts have a shingle that falls on each counter.

    The counters are a fixed number of megabytes; partial tables are added up in two
    steps, so that no task holds more than some of them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTERS, np.int64)
        for _, sets in _shingled(batches):
            if sets:
                total += np.bincount((np.concatenate(sets) >> np.uint64(64 - COUNTERS)).astype(np.int64), minlength=1 << COUNTERS)
        part = TaskContext.get().partitionId()
        packed = [zlib.compress(total[i : i + _CHUNK].tobytes(), 1) for i in range(0, 1 << COUNTERS, _CHUNK)]
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(len(packed)), pa.int32()), pa.array([part % 64] * len(packed), pa.int32()), pa.array(packed, pa.binary())], ["chunk", "part", "counts"])

    def add(own: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), np.int64) for c in own["counts"])
        return pd.DataFrame({"chunk": [int(own["chunk"].iloc[0])], "part": [0], "counts": [zlib.compress(total.tobytes(), 1)]})

    schema = "chunk int, part int, counts binary"
    partial = docs.select("text").mapInArrow(count, schema).groupBy("chunk", "part").applyInPandas(add, schema)
    whole = partial.groupBy("chunk").applyInPandas(add, schema).toPandas()
    out = np.zeros(1 << COUNTERS, np.uint32)
    for chunk, counts in zip(whole["chunk"], whole["counts"]):
        out[chunk * _CHUNK : (chunk + 1) * _CHUNK] = np.frombuffer(zlib.decompress(counts), np.int64)
    return out


def _rarest_first(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The shingles (sorted by hash) under order 1."""
    return hashes[np.argsort(counts[(hashes >> np.uint64(64 - COUNTERS)).astype(np.int64)], kind="stable")]


def sketches(docs: DataFrame, counts) -> DataFrame:
    """Per row doc_id, key, n, the least hash under each of ``STARS`` orders, and how common its shingles are."""
    seeds = mix(np.arange(1, STARS + 1, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _shingled(batches):
            n = [len(s) for s in sets]
            least = [_signed(np.array([mix(s ^ seed).min() for seed in seeds])) if len(s) else None for s in sets]
            common = [float(np.log1p(counts.value[(s >> np.uint64(64 - COUNTERS)).astype(np.int64)]).mean()) if len(s) else 0.0 for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(n, pa.int64()), pa.array(least, pa.list_(pa.int64())), pa.array(common, pa.float64())], ["doc_id", "key", "n", "least", "common"])

    return docs.mapInArrow(run, "doc_id long, key string, n long, least array<long>, common double")


def _prefix(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Prefix tokens of a set, their rooms, and how many are of the index prefix.

    A token's room is the largest size of a set with which it can be the first in
    common, as what is left of both bounds the intersection.
    """
    n = len(hashes)
    place = np.arange(probe_length(n))
    return _signed(_rarest_first(hashes, counts)[: len(place)]), (n - place) * (100 + PERCENT) // PERCENT - n, index_length(n)


def prefixes(docs: DataFrame, counts) -> DataFrame:
    """Postings of nodes under order 1: token, key, part, n, room, and whether it is of the index prefix.

    Of rows with equal text, a partition gives one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch, sets in _shingled(batches):
            row, parts = [], []
            for i, (k, s) in enumerate(zip(batch.column("key").to_pylist(), sets)):
                if len(s) and seen.first(k):
                    token, room, index = _prefix(s, counts.value)
                    row.append(np.full(len(token), i))
                    parts.append((token, np.full(len(token), len(s)), room, np.arange(len(token)) < index))
            if row:
                own = [batch.column(c).take(pa.array(np.concatenate(row))) for c in ("key", "part")]
                token, n, room, index = (pa.array(np.concatenate(c)) for c in zip(*parts))
                yield pa.RecordBatch.from_arrays([token, *own, n, room, index], ["token", "key", "part", "n", "room", "index"])

    return docs.select("key", "part", "text").mapInArrow(run, "token long, key string, part long, n long, room long, index boolean")


class _Seen:
    """Keys that a task has met, as many as memory allows; a key that is forgotten is only handled again."""

    def __init__(self, most: int = 1_000_000):
        self._keys: set[str] = set()
        self._most = most

    def first(self, key: str) -> bool:
        if key in self._keys:
            return False
        if len(self._keys) < self._most:
            self._keys.add(key)
        return True


def component_prefixes(docs: DataFrame, counts, held: int = 50_000) -> DataFrame:
    """Postings of components: token, part, index, and the least and largest n and the largest room of members.

    A task combines those of a component with several members (``grouped``) before
    they are shuffled, so a token that all copies of a text have is one row per task.
    """
    columns = ["token", "part", "least", "most", "room", "index"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, combined = _Seen(), {}

        def flush() -> pa.RecordBatch:
            keys, values = zip(*combined.items())
            combined.clear()
            token, part, index = zip(*keys)
            least, most, room = zip(*values)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (token, part, least, most, room)] + [pa.array(index, pa.bool_())], columns)

        for batch, sets in _shingled(batches):
            alone = []
            for k, part, grouped, s in zip(*(batch.column(c).to_pylist() for c in ("key", "part", "grouped")), sets):
                if not len(s) or not seen.first(k):
                    continue
                token, room, index = _prefix(s, counts.value)
                n = len(s)
                if not grouped:
                    alone.append((token, np.full(len(token), part), np.full(len(token), n), room, np.arange(len(token)) < index))
                    continue
                for i, (t, r) in enumerate(zip(token.tolist(), room.tolist())):
                    low, high, most = combined.get((t, part, i < index), (n, n, r))
                    combined[t, part, i < index] = min(low, n), max(high, n), max(most, r)
            if len(combined) >= held:
                yield flush()
            if alone:
                token, part, n, room, index = (pa.array(np.concatenate(c)) for c in zip(*alone))
                yield pa.RecordBatch.from_arrays([token, part, n, n, room, index], columns)
        if combined:
            yield flush()

    return docs.select("key", "part", "grouped", "text").mapInArrow(run, "token long, part long, least long, most long, room long, index boolean")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys that are linked.

    Filters of orders 2 and 3 first, then the whole intersection.  ``pairs`` is settled.
    """
    involved = settle(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct())
    texts = settle(docs.join(small(involved), "key", "left_semi").select("key", "text").dropDuplicates(["key"]))
    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}  # of the last texts; one side of many pairs is the same
        for whole in batches:
            for batch in slices(whole, "text_a", _SLICE):
                a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
                new = {k: (c, i) for c, keys in (("text_a", a), ("text_b", b)) for i, k in enumerate(keys) if k not in known}
                sets = {k: s for k, s in known.items() if k in {*a, *b}}
                sets |= zip(new, shingle_sets([batch.column(c)[i].as_py() for c, i in new.values()], SHINGLE))
                good = [linked(sets[x], sets[y]) for x, y in zip(a, b)]
                known = dict(list(sets.items())[-64:])
                mask = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a string, b string")


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets are linked; both filters before the count."""
    n, m = len(x), len(y)
    need = least_overlap(n, m)
    if not n or not m or need > min(n, m):
        return False
    p, q = probe_length(n), probe_length(m)
    if not _share(x[:p], y[:q]) or not _share(x[n - p :], y[m - q :]):
        return False
    return 100 * (common := _common(x, y)) >= PERCENT * (n + m - common)


def _common(x: np.ndarray, y: np.ndarray) -> int:
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def _share(x: np.ndarray, y: np.ndarray) -> bool:
    return _common(x, y) > 0


def components(links: DataFrame) -> DataFrame:
    """key and part (its component's least key) of all keys that are in a link.

    Every round hangs each component on the least neighbouring one and then halves
    the paths, so the rounds grow with the logarithm of the longest chain.
    """
    edges = settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    while True:
        # Large star, then small star: links move to the least key around, until only stars are left.
        around = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Settled, so that the join deals out both sides anew and can split a star's many links.
        least = settle(around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")))
        large = around.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small_ = large.join(least, "a")
        next_ = small_.filter("b != least").select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b"))).filter("a != b").distinct()
        next_ = settle(next_)
        if next_.count() == edges.count() and next_.exceptAll(edges).limit(1).count() == 0:
            break
        edges = next_
        tidied(edges.sparkSession)
    return edges.select(F.col("a").alias("key"), F.col("b").alias("part")).union(edges.select(F.col("b").alias("key"), F.col("b").alias("part"))).distinct()


def near_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id, key and part of every row.

    Rows of equal text share the key, a digest of it; ``part`` names the component,
    null for empty sets.
    """
    spark = df.sparkSession
    plain = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_of(text).alias("text"))
    docs = plain.withColumn("key", F.md5(F.col("text").cast("binary")))
    counts = spark.sparkContext.broadcast(frequencies(docs))  # a fixed size
    rows = settle(sketches(docs, counts))
    nodes = settle(rows.filter("n > 0").groupBy("key").agg(F.first("n").alias("n"), F.first("least").alias("least"), F.first("common").alias("common")))

    # Step 1: stars.
    spread = nodes.select("key", "n", "common", F.posexplode("least").alias("star", "hash"))
    middle = spread.groupBy("star", "hash").agg(F.count(F.lit(1)).alias("members"), F.max(F.struct("common", "n", "key")).alias("middle")).filter("members > 1")
    middle = settle(middle.select("star", "hash", F.col("middle.key").alias("b"), F.col("middle.n").alias("m")))
    near = (F.col("n") * 100 >= F.col("m") * PERCENT) & (F.col("m") * 100 >= F.col("n") * PERCENT)
    pairs = settle(spread.join(middle, ["star", "hash"]).filter((F.col("key") != F.col("b")) & near).select(F.col("key").alias("a"), "b").distinct())
    stars = settle(verified(pairs, docs))
    del pairs, middle, spread
    tidied(spark)
    parts = settle(components(stars))
    tidied(spark)

    # Step 2: the prefix join of components, by a 64-bit label of each.
    label = F.xxhash64(F.coalesce("part", "key"))
    labelled = docs.join(small(parts), "key", "left").select("key", label.alias("part"), F.col("part").isNotNull().alias("grouped"), "text")
    found = settle(_component_pairs(component_prefixes(labelled, counts)))
    if found.limit(1).count():
        members = settle(found.select(F.explode(F.array("a", "b")).alias("part")).distinct())
        inside = nodes.select("key").join(parts, "key", "left").select("key", label.alias("part")).join(members, "part", "left_semi")
        again = docs.join(small(settle(inside)), "key").select("key", "part", "text")
        pairs = settle(_node_pairs(prefixes(again, counts)))
        del again, inside, members
        tidied(spark)
        parts = settle(components(stars.union(settle(verified(pairs, docs)))))
        tidied(spark)
    labelled = rows.select("doc_id", "key", "n").join(parts, "key", "left").withColumn("part", F.coalesce("part", "key"))
    ids = settle(labelled.groupBy("part").agg(F.min("doc_id").alias("component_id"), F.max("n").alias("most")))
    out = labelled.join(ids, "part")
    # Empty sets have the same key, but are linked with nothing.
    part = F.when(F.col("n") > 0, F.col("part")).alias("part")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "key", part)


def without_copies(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component: that of the smallest doc_id, then of the smallest digest of its text.  Empty texts stay."""
    rows = settle(near_duplicates(df, text, doc_id).filter("n_shingles > 0").select("doc_id", "key", "part"))
    chosen = rows.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("kept"))
    other = F.col("key").eqNullSafe(F.col("kept.key")) & F.col("doc_id").eqNullSafe(F.col("kept.doc_id"))
    dropped = settle(rows.join(settle(chosen), "part").filter(~other).select(F.col("doc_id").alias("id"), "key").distinct())
    repeated = settle(rows.groupBy("doc_id", "key").count().filter("count > 1").select(F.col("doc_id").alias("id"), "key"))
    plain, number = plainly_named(df), place_of(df, doc_id)
    key = F.md5(text_of(place_of(df, text)).cast("binary"))
    same = F.col("key").eqNullSafe(key) & F.col("id").eqNullSafe(F.col(number).cast("long"))
    kept = plain.join(small(dropped), same, "left_anti")
    if repeated.limit(1).count():
        # Rows equal in doc_id and text: one of each stays.
        once = kept.join(small(repeated), same, "left_semi").withColumn("key", key).dropDuplicates([number, "key"]).drop("key")
        kept = kept.join(small(repeated), same, "left_anti").unionByName(once)
    return kept.toDF(*df.columns)


def _component_pairs(postings: DataFrame) -> DataFrame:
    """Pairs of components of which two members may be linked."""
    # One shuffle, by token: what is left are tokens that two components share, which are few.
    of_token = Window.partitionBy("token")
    shared = postings.withColumns({"first": F.min("part").over(of_token), "last": F.max("part").over(of_token)}).filter("first != last")
    of_index = lambda c: F.when(F.col("index"), F.col(c))
    held = settle(
        shared.groupBy("token", "part").agg(
            F.min("least").alias("least"), F.max("most").alias("most"), F.max("room").alias("room"),
            F.min(of_index("least")).alias("index_least"), F.max(of_index("most")).alias("index_most"), F.max(of_index("room")).alias("index_room"),
        )
    )
    probe = held.select("token", F.col("part").alias("a"), "least", "most", "room")
    index = held.filter("index_least IS NOT NULL").select("token", F.col("part").alias("b"), "index_least", "index_most", "index_room")
    met = probe.join(index, "token").filter(
        (F.col("a") != F.col("b"))
        & (F.col("index_least") <= F.col("most"))
        & (F.col("index_most") * 100 >= F.col("least") * PERCENT)
        & (F.col("index_least") <= F.col("room"))
        & (F.col("least") <= F.col("index_room"))
    )
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _node_pairs(postings: DataFrame) -> DataFrame:
    """Pairs of nodes in different components that meet at a token and may be linked.

    A pair that is linked passes at the first token that it shares.
    """
    named = lambda x: [F.col("key").alias(x), F.col("part").alias(f"part_{x}"), F.col("n").alias(f"n_{x}"), F.col("room").alias(f"room_{x}")]
    met = postings.select("token", *named("a")).join(postings.filter("index").select("token", *named("b")), "token").filter(
        (F.col("part_a") != F.col("part_b"))
        & (F.col("n_b") <= F.col("n_a"))
        & (F.col("n_b") * 100 >= F.col("n_a") * PERCENT)
        & (F.col("n_b") <= F.col("room_a"))
        & (F.col("n_a") <= F.col("room_b"))
    )
    return met.select("a", "b").distinct()


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies among all documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE
    list_distinct(list_transform(range(1, greatest(len(ws) - 4, 1) + 1), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS h FROM s),
linked AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.h = b.h AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.x, l.y FROM reach r JOIN linked l ON r.y = l.x)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM s JOIN reach r ON r.x = s.doc_id GROUP BY s.doc_id, len(s.sh)
"""

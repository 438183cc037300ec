"""Reproducible sharding (operator 2), in DataFrame operations only.

Every row gets a global row number: rows are put in ``buckets`` by a digest of
their own values, counted there, and numbered by bucket and then by doc_id, so
that the numbers depend on the rows alone and not on files, partitions or
retries.  A Feistel permutation with cycle walking over those numbers shuffles
them; the law is ``rows``: shard and slot are remainder and quotient of the
permuted number, so the counts of any two shards differ by one at most, and
the place of any row number can be computed without the others.

The network works on pairs (left, right) with left below ``a`` and right below
``b``, where a is the root of n rounded up and b = n / a rounded up.  Fewer
than a of its a * b numbers are not row numbers; a walk that meets one goes
on until it is back among them.  How long the longest walk is depends on n and
the seed alone and is found beforehand, from those few numbers.

Rows that are equal in doc_id and text count as one with a multiplicity until they
are numbered; then they are dealt out again in blocks of ``BLOCK`` rows, so that a
row that makes up a third of the table is never one array or one task.

Defined results: null texts have size 1 and the checksum of no bytes, empty
texts as well; null doc_ids are numbered as the others are; of rows with equal
doc_id and text, each gets a place of its own; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesift.llm.common import settle, small, table, text_of

SHARDS = 16
ROUNDS = 6
#: Rows of a part in which rows are numbered, in the mean; each is one window.  There are 64 parts at least.
BUCKET_ROWS = 1 << 18
#: Copies of a row that one task makes from one array.
BLOCK = 10_000


def _mixed(round_: Column, value: Column, seed: int, modulus: int) -> Column:
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), round_.cast("string"), value.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % modulus


def permuted_once(x: Column, n: int, seed: int) -> Column:
    """One pass through the Feistel network on 0 .. a * b - 1."""
    a, b = domain(n)
    start = F.struct((x / b).cast("long").alias("left"), (x % b).alias("right"))

    def step(pair: Column, round_: Column) -> Column:
        # Rounds alternate: the left number is moved by the right one, then the right by the left.
        even = round_ % 2 == 0
        return F.struct(
            F.when(even, (pair.left + _mixed(round_, pair.right, seed, a)) % a).otherwise(pair.left).alias("left"),
            F.when(even, pair.right).otherwise((pair.right + _mixed(round_, pair.left, seed, b)) % b).alias("right"),
        )

    return F.aggregate(F.array(*[F.lit(r) for r in range(ROUNDS)]), start, step, lambda pair: pair.left * b + pair.right)


def domain(n: int) -> tuple[int, int]:
    """The sides of the smallest nearly square domain that holds n numbers."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def longest_walk(spark: SparkSession, n: int, seed: int) -> int:
    """Passes that bring every number below n back below n."""
    if n < 1:
        return 1
    a, b = domain(n)
    outside = spark.range(n, a * b).select(F.col("id").alias("x"))
    # Walks come in where no number outside leads to; what is left of those outside goes round in
    # cycles that no walk meets.
    walking = settle(outside.join(outside.select(permuted_once(F.col("x"), n, seed).alias("x")), "x", "left_anti"))
    passes = 1
    while walking.limit(1).count():
        # Only walks that go on are kept, so the few numbers soon are none.
        walking = settle(walking.select(permuted_once(F.col("x"), n, seed).alias("x")).filter(F.col("x") >= n))
        passes += 1
    return passes


def permuted(x: Column, n: int, seed: int, passes: int) -> Column:
    """The place of row number x among n, after at most ``passes`` passes."""
    walk = F.array_repeat(F.lit(0), passes - 1)
    return F.aggregate(walk, permuted_once(x, n, seed), lambda y, _: F.when(y < n, y).otherwise(permuted_once(y, n, seed)))


def numbered(df: DataFrame, keys: list[str], number: str = "row_number", bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """Distinct rows of ``keys`` with how often each occurs, ``copies``, and the first of its row numbers; and the number of all rows.

    The order is by bucket and then by ``keys``; the number of buckets follows from that of rows.
    """
    n = df.count()
    buckets = max(64, -(-n // bucket_rows))
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys]))
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    counted = counted.withColumn("bucket", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % buckets)
    within = Window.partitionBy("bucket").orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    counted = settle(counted.withColumn("before", F.sum("copies").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")))
    # One thin row for each bucket, so one for 2**18 rows of a large table.
    totals = counted.groupBy("bucket").agg(F.sum("copies").alias("rows"))
    bases = settle(totals.select("bucket", (F.sum("rows").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")).alias("base")))
    return counted.join(small(bases), "bucket").withColumn(number, F.col("base") + F.col("before")).drop("bucket", "base", "before"), n


def blocks_of_copies(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``rows`` with row_number and copies, in rows of at most ``block`` copies each; dealt out anew if any has more."""
    if (rows.agg(F.max("copies")).first()[0] or 0) <= block:
        return rows
    whole = F.col("copies")
    # Two levels, so that no array has more than a few thousand elements even for thousands of millions of copies.
    for size in (block * block, block):
        at = F.explode(F.sequence(F.lit(0).cast("long"), whole - 1, F.lit(size).cast("long")))
        rows = rows.withColumn("__at", at).withColumns({"row_number": F.col("row_number") + F.col("__at"), "copies": F.least(whole - F.col("__at"), F.lit(size))}).drop("__at")
    return rows.repartition("row_number")


def shard_rows(df: DataFrame, keys: list[str], shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """One row for each row of ``df``: ``keys``, ``row_number``, ``shard`` and ``slot``."""
    rows, n = numbered(df, keys)
    rows = blocks_of_copies(rows)
    each = rows.withColumn("row_number", F.explode(F.sequence("row_number", F.col("row_number") + F.col("copies") - 1))).drop("copies")
    passes = longest_walk(df.sparkSession, n, seed)
    placed = each.withColumn("place", permuted(F.col("row_number"), max(n, 1), seed, passes))
    return placed.withColumn("shard", (F.col("place") % shards).cast("int")).withColumn("slot", (F.col("place") / shards).cast("long")).drop("place")


def op2_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards, with counts at most one apart."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text_of()) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.xxhash64(text_of()).alias("text_hash"),
    )
    return shard_rows(docs, ["doc_id", "size", "text_crc32", "text_hash"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )

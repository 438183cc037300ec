"""Exact deduplication of tables by content hash, and what goes with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def content_hash(key: Column) -> Column:
    """The last segment of a key."""
    return F.element_at(F.split(key, "/"), -1)


def sort_keys(hash_: Column) -> tuple[Column, Column]:
    """Two unsigned 64-bit halves of the hash's md5, as decimals, low bytes first."""
    digest = F.md5(hash_)

    def half(start: int) -> Column:
        pairs = [F.substring(digest, start + 2 * i, 2) for i in reversed(range(8))]
        return F.conv(F.concat(*pairs), 16, 10).cast("decimal(20,0)")

    return half(1), half(17)


def dedup_index(keys: DataFrame) -> DataFrame:
    """One (key, path) for each content hash: that of the smallest path, then key.

    An aggregation that combines before its shuffle, so a table with millions of
    copies costs one row per task.
    """
    best = keys.groupBy(content_hash(F.col("key")).alias("content_hash")).agg(F.min(F.struct("path", "key")).alias("best"))
    return best.select("best.key", "best.path", "content_hash")


def deduped(shards: DataFrame, index: DataFrame, strict: bool = True) -> DataFrame:
    """Rows of shards that the index names.

    A key that a shard holds twice gives both rows; ``strict`` keeps one of them.
    """
    kept = shards.join(index.select("path", "key"), ["path", "key"], "left_semi").withColumn("content_hash", content_hash(F.col("key")))
    return kept.dropDuplicates(["path", "key"]) if strict else kept


def duplicate_count(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier one; null equals null."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_count"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"))


def path_token(path: Column) -> Column:
    """A path as a file name."""
    return F.replace(F.replace(path, F.lit("/"), F.lit("__")), F.lit(".parquet"), F.lit(""))


def file_numbers(paths: DataFrame, path: str = "path") -> DataFrame:
    """Distinct paths with their number in order; one row per file."""
    return paths.select(path).distinct().withColumn("pathnum", F.row_number().over(Window.orderBy(path)) - 1)


def covering_set(pairs: DataFrame) -> DataFrame:
    """(file, string) for every string once, from few files: again and again the file that covers most of what is left.

    The same files as one by one, but many in a round: every file that covers more than any other file
    it shares a string with (of equal ones, the first by name), for no other choice changes what is left of it.
    A round is a few aggregations and joins on thin rows.
    """
    left = pairs.select("file", "string").distinct().checkpoint()
    chosen = left.limit(0)
    while left.limit(1).count():
        ranked = left.join(left.groupBy("file").agg((-F.count(F.lit(1))).alias("rank")), "file")
        best = ranked.groupBy("string").agg(F.min(F.struct("rank", "file")).alias("best"))
        ahead = ranked.join(best, "string").groupBy("file").agg(F.min(F.col("file") == F.col("best.file")).alias("ahead")).filter("ahead").select("file")
        taken = left.join(ahead, "file", "left_semi").checkpoint()
        chosen = chosen.unionByName(taken)
        left = left.join(taken.select("string"), "string", "left_anti").select("file", "string").checkpoint()
    return chosen

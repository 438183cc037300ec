"""Exact duplicates by progressive refinement (operator 4).

Texts are equal if they are identical without white space.  Rows are grouped
by normalised length; rows of a length that occurs once are done.  The others
are grouped by length and a hash of the first characters; what still shares
both is grouped by the SHA-256 of the whole normalised text.  Only thin rows
(an id, three numbers, a digest) are ever shuffled, each grouping combines
before its shuffle, and rows are joined back on the digest, where Spark's skew
join can split a group that holds a third of all rows.

Of equal texts the row with the most code points stays, then the smallest
doc_id (null last), then one row of those that are equal in both.

Defined results: null texts count as empty, and all empty or white texts are
one group; rows with equal doc_id are rows of their own, of which one stays if
the texts are equal; an empty table gives no rows.  ``doc_id`` and the text
are the only columns read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm.common import BROADCAST_ROWS, settle, small, table

#: Characters of the normalised text from which the prefix hash is made.
PREFIX_CHARS = 256
WHITE = "\t\n\x0b\x0c\r "


def normalised(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Values of ``keys`` that occur more than once, for a join without a shuffle where they are few."""
    return small(settle(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")))


def exact_groups(df: DataFrame, text: str = "text", doc_id: str = "doc_id", hash_all: bool = False) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows that a cheaper level tells apart have no ``text_sha256``, however many there
    are.  ``hash_all`` is for those who want every row's digest; as each text is hashed
    whole then, that happens in the first scan and the levels only thin out what is
    grouped by digest.
    """
    docs = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("raw")).withColumn("clean", normalised(F.col("raw")))
    facts = ["doc_id", F.length("raw").alias("chars"), F.octet_length("clean").alias("bytes"), F.xxhash64(F.substring("clean", 1, PREFIX_CHARS)).alias("prefix")]
    digest = F.sha2("clean", 256).alias("text_sha256")
    # The row's own number, for ties; it is settled with the rows.
    own = F.monotonically_increasing_id().alias("own")
    rows = settle(docs.select(*facts, *([digest] if hash_all else []), own))
    by_length = rows.join(_repeated(rows, ["bytes"]), "bytes", "left_semi")
    survivors = _repeated(by_length, ["bytes", "prefix"])
    if not hash_all:
        marks = survivors.withColumn("survives", F.lit(True))
        hashed = F.when(F.col("survives"), F.col("text_sha256")).alias("text_sha256")
        if survivors.count() <= BROADCAST_ROWS:
            # Only the texts of surviving groups are hashed.
            marked = docs.select(*facts, "clean").join(marks, ["bytes", "prefix"], "left")
            rows = marked.select("doc_id", "chars", "bytes", "prefix", F.when(F.col("survives"), F.sha2("clean", 256)).alias("text_sha256"), own)
        else:
            # Too many to broadcast: hashing costs less than shuffling texts, so thin rows are shuffled with their digests.
            marked = docs.select(*facts, digest, own).join(marks, ["bytes", "prefix"], "left")
            rows = marked.select("doc_id", "chars", "bytes", "prefix", hashed, "own")
        rows = settle(rows)
    best = F.min(F.struct((-F.col("chars")).alias("fewest"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "own"))
    groups = rows.join(survivors, ["bytes", "prefix"], "left_semi").groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n"), best.alias("best")).filter("n > 1")
    placed = rows.join(settle(groups), "text_sha256", "left")
    alone = F.col("n").isNull()
    return placed.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("own") == F.col("best.own"))).alias("kept"),
        "text_sha256",
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts; every text's digest is asked for, so all are hashed, in one scan."""
    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), hash_all=True)


OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
r AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""

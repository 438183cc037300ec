"""A corpus pipeline of five of the operators, as query ``pipeline``.

Each stage works on all that the one before it kept and returns the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.llm import jaccard, line_dedup, packing, secrets, toxicity
from tablesift.llm.common import bounded_batches, discard, rewritten, table


def _with_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents in their order, n_chars by the text as it is now."""
    named = [f"`{c}`" for c in columns]
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*named) if "n_chars" in columns else df.select(*named)


def _fresh(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go."""
    bounded_batches(spark)
    machine = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    score = _fresh(docs, "score")
    return toxicity.scored(docs, machine, score=score).filter(F.col(f"`{score}`") < 0.5).drop(score)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more go where they are repeated; what is left of a text stays."""
    return _with_text(line_dedup.without_runs(docs, removed=_fresh(docs, "removed")), docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    bounded_batches(spark)
    return jaccard.without_copies(docs)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; documents stay."""
    bounded_batches(spark)
    base, spans = _fresh(docs, "base"), _fresh(docs, "spans")
    found = secrets.scan(docs, base=base, spans=spans)
    return _with_text(found.withColumn("text", secrets.redacted(F.col("text"), F.col(f"`{spans}`"))), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, in sequences of 2048 tokens."""
    bounded_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic),
    ("line_dedup", repeated_passages),
    ("near_duplicates", near_copies),
    ("secrets", secret_spans),
    ("packing", packed),
]

#: SQL can't express a fitted model, so a test holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before: list[str] = []
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            written: list[str] = []
            docs = rewritten(docs, written)
            # Nothing reads what the stage before wrote any more.
            discard(spark, before)
            before = written
    return docs

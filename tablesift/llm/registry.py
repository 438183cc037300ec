"""The queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablesift.llm import bpe, exact_dedup, hard_negatives, jaccard, licenses, line_dedup, neighbours, packing, periodic, quality_votes, secrets, shard, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": bpe.op1_byte_bpe,
    "op2_feistel_shards": shard.op2_feistel_shards,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_pack": packing.op5_pack,
    "op6_ngram_jaccard": jaccard.op6_ngram_jaccard,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_licenses": licenses.op8_licenses,
    "op9_nearest": neighbours.op9_nearest,
    "op10_secrets": secrets.op10_secrets,
    "op11_periodic_runs": periodic.op11_periodic_runs,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_quality": quality_votes.op13_quality,
}

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op6_ngram_jaccard": jaccard.OP6_SQL,
    "op9_nearest": neighbours.OP9_SQL,
    "op11_periodic_runs": periodic.OP11_SQL,
    "op12_hard_negatives": hard_negatives.OP12_SQL,
}

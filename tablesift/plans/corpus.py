"""The two pipelines over a corpus of tables: deduplicate, then filter and clean.

Filtering works on cells as rows, so any number of tables of any schema go
through the same few aggregations.  What names and types alone can decide comes
first, then one aggregation per column, then rows.  Decisions are row and
column numbers; they are applied to each table's own bytes at the end.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesift.functions import predicates as P
from tablesift.functions.language import FrequentWords
from tablesift.operators.dedup import dedup_index, deduped
from tablesift.operators.filters import bad_headers
from tablesift.operators.sampling import chunk_of
from tablesift.plans.config import Config
from tablesift.sources import arrow_tables, shards, sinks, transaction
from tablesift.streaming.runner import shared_folder


def dedup(spark: SparkSession, directory: str, out: str, max_shards: int | None = None) -> DataFrame:
    """Write the index of a corpus; only keys are read."""
    keys = shards.read_shards(spark, directory).select("key", "path")
    if max_shards is not None:
        keys = keys.join(shards.shard_paths(keys, max_shards), "path", "left_semi")
    sinks.write_index(dedup_index(keys), out)
    return sinks.read_index(spark, out)


def accepted_by_names(facts: DataFrame, config: Config, detector: Callable[[Column], Column]) -> DataFrame:
    """What language, counts, headers and types accept."""
    headers = F.array_join(F.transform(F.filter("names", lambda n: n.isNotNull()), lambda n: F.replace(n, F.lit("\n"), F.lit(""))), " ")
    # The detector may be a Python function: its argument is a column, made before it.
    columns = facts.columns
    facts = facts.withColumn("__headers", headers)
    facts = facts.withColumn("__english", P.is_english(detector(F.col("__headers")), config.langdetect_threshold))
    good = F.col("error").isNull() & F.col("__english")
    if config.min_rows is not None:
        good &= F.col("nrows") >= config.min_rows
    if config.max_rows is not None:
        good &= F.col("nrows") <= config.max_rows
    if config.min_cols is not None:
        good &= F.col("ncols") >= config.min_cols
    if config.filter_too_many_columns and config.max_cols is not None:
        good &= F.col("ncols") <= config.max_cols
    if config.min_dtypes is not None:
        good &= F.size(F.array_distinct("dtypes")) >= config.min_dtypes
    return facts.filter(good & ~bad_headers(F.col("names"), config.max_frac_numeric_colnames, config.max_frac_unnamed_colnames)).select(*columns)


def column_facts(cells: DataFrame, config: Config) -> DataFrame:
    """Per column of each table: whether it is valid, and its shares of code and personal data."""
    value, strings = F.col("value"), F.col("kind") == "object"
    unique = F.min("value") != F.max("value") if config.min_unique_column_values == 2 else F.count_distinct("value") >= config.min_unique_column_values
    null = P.share(F.when(strings, P.null_like(value)).otherwise(value.isNull()))
    got = cells.groupBy("table_id", "col_idx").agg(
        F.first("col_name").alias("col_name"), F.coalesce(unique, F.lit(False)).alias("enough_unique"), null.alias("frac_null_like"),
        P.share(strings & P.contains_code(value)).alias("frac_code"), P.share(strings & P.contains_pii(value)).alias("frac_pii"),
    )
    valid = F.col("enough_unique") & (F.length("col_name") < (config.max_header_len_chars or 1 << 30))
    if config.max_null_like_frac is not None:
        valid &= F.col("frac_null_like") < config.max_null_like_frac
    return got.withColumn("valid", F.coalesce(valid, F.lit(False)))


def _accepted_by_columns(columns: DataFrame, config: Config) -> DataFrame:
    tests = F.sum(F.col("valid").cast("int")) >= (config.min_cols or 0)
    if config.code_detect_threshold is not None:
        tests &= F.max("frac_code") <= config.code_detect_threshold
    if config.pii_detect_threshold is not None:
        tests &= F.max("frac_pii") <= (config.pii_detect_threshold if config.strict_pii_threshold else 0.0)
    return columns.groupBy("table_id").agg(tests.alias("good")).filter("good").select("table_id")


def kept_columns(columns: DataFrame, config: Config) -> DataFrame:
    kept = columns.filter("valid") if config.drop_invalid_cols else columns
    if config.drop_extra_cols and config.max_cols is not None:
        order = Window.partitionBy("table_id").orderBy(F.md5(F.concat_ws(":", "col_name", F.lit("0"))), "col_idx")
        kept = kept.withColumn("__place", F.row_number().over(order)).filter(F.col("__place") <= config.max_cols).drop("__place")
    return kept.select("table_id", "col_idx")


def kept_rows(cells: DataFrame, config: Config) -> DataFrame:
    """Rows that no cell speaks against; one of equal ones; a sample of too many."""
    value, strings = F.col("value"), F.col("kind") == "object"
    bad = F.lit(False)
    if config.max_value_len_chars is not None:
        bad |= strings & P.longer_than(value, config.max_value_len_chars)
    if config.filter_substrings:
        bad |= P.contains_any(value, config.filter_substrings)
    if config.filter_code_rows:
        bad |= strings & P.contains_code(value)
    if config.filter_pii_rows:
        bad |= strings & P.contains_pii(value)
    held = [F.bool_or(bad).alias("bad")]
    if config.drop_duplicate_rows or config.max_output_rows is not None:
        held.append(F.md5(F.to_json(F.array_sort(F.collect_list(F.struct("col_idx", "value"))))).alias("digest"))
    rows = cells.groupBy("table_id", "row_idx").agg(*held).filter(~F.col("bad"))
    if config.drop_duplicate_rows:
        rows = rows.groupBy("table_id", "digest").agg(F.min("row_idx").alias("row_idx"))
    if config.max_output_rows is not None:
        order = Window.partitionBy("table_id").orderBy(F.md5(F.concat_ws(":", "digest", F.lit("0"))), "row_idx")
        rows = rows.withColumn("__place", F.row_number().over(order)).filter(F.col("__place") <= config.max_output_rows)
    return rows.select("table_id", "row_idx")


def _settled(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint()


def cleaned(corpus: DataFrame, config: Config, detector: Callable[[Column], Column] | None = None, quality: Callable[[DataFrame], DataFrame] | None = None, facts: DataFrame | None = None) -> DataFrame:
    """Surviving tables of a corpus (content_hash, arrow_bytes), trimmed: content_hash, nrows, ncols, arrow_bytes.

    ``quality`` maps cells to (table_id, score), the probability of good quality; by the configuration it is asked about
    tables as they come ("pre"), or about what is left of them ("post").  ``facts`` are those of ``arrow_tables.with_facts``, if
    they are known.
    """
    if config.table_quality_threshold is not None and config.table_quality_position == "pre" and quality is None:
        raise ValueError("this configuration asks a quality model before filtering: give one")
    # Decisions are thin and settled, so that blobs are decoded once for their facts, once for what their
    # columns hold, once for their rows, and once to be trimmed.
    named = _settled(accepted_by_names(arrow_tables.with_facts(corpus) if facts is None else facts, config, detector or FrequentWords()).select("content_hash"))
    tables = corpus.join(named, "content_hash", "left_semi")
    cells = arrow_tables.cells(tables)
    columns = _settled(column_facts(cells, config))
    good = _accepted_by_columns(columns, config)
    scored = lambda own: quality(own).filter(F.col("score") > config.table_quality_threshold).select("table_id")
    if config.table_quality_threshold is not None and config.table_quality_position == "pre":
        good = good.join(scored(cells), "table_id", "left_semi")
    own_columns = _settled(kept_columns(columns.join(good, "table_id", "left_semi"), config))
    inner = cells.join(own_columns, ["table_id", "col_idx"], "left_semi")
    rows = kept_rows(inner, config)
    asked = config.table_quality_threshold is not None and config.table_quality_position == "post" and quality is not None
    if asked:
        rows = _settled(rows)
    own_rows = rows.groupBy("table_id").agg(F.collect_list("row_idx").alias("kept_rows"))
    if config.min_rows is not None:
        own_rows = own_rows.filter(F.size("kept_rows") >= config.min_rows)
    if asked:
        # What is asked then is the table as it is written.
        own_rows = _settled(own_rows)
        left = rows.join(own_rows.select("table_id"), "table_id", "left_semi")
        own_rows = own_rows.join(scored(inner.join(left, ["table_id", "row_idx"], "left_semi")), "table_id", "left_semi")
    decided = own_rows.join(own_columns.groupBy("table_id").agg(F.collect_list("col_idx").alias("kept_columns")), "table_id").withColumnRenamed("table_id", "content_hash")
    chosen = tables.join(decided, "content_hash").withColumns({"nrows": F.size("kept_rows").cast("long"), "ncols": F.size("kept_columns").cast("long")})
    return arrow_tables.trimmed(chosen.select("content_hash", "nrows", "ncols", "arrow_bytes", "kept_rows", "kept_columns"))


def chunks_of(spark: SparkSession, directory: str, chunk_size: int = 512) -> int:
    """How many chunks a corpus has."""
    return -(-shards.shard_paths(shards.read_shards(spark, directory)).count() // chunk_size)


def process_chunks(
    spark: SparkSession, directory: str, index: str, out: str, config: Config, chunk_size: int = 512, file_format: str = "parquet", detector=None, quality=None, only: list[int] | None = None,
    shared_mount: bool = False,
) -> DataFrame:
    """Clean a corpus chunk by chunk; returns the manifest of all chunks that are done, with ``chunk``.

    A chunk is some of the files, by digest.  Its tables and its manifest are committed together in a
    folder of its own, so the commits are the ledger: a run that is begun again goes on with the chunks that have
    none, and one that broke off in a chunk leaves nothing of it.  ``only`` names chunks, for several
    drivers side by side.  Tables that can't be decoded are rows of the manifest with their errors.  ``out`` and
    ``shared_mount`` are as for ``tablesift.sources.sinks.write_tables``.
    """
    rows = shards.read_shards(spark, directory).select("key", "arrow_bytes", "path")
    paths = _settled(shards.shard_paths(rows))
    count = -(-paths.count() // chunk_size)
    done = []
    for chunk in range(count) if only is None else only:
        own = sinks.chunk_directory(out, chunk)
        if transaction.committed(spark, own) is None:
            mine = chunk_of(paths, "path", chunk_size, chunk).select("path")  # at most chunk_size names
            corpus = deduped(rows.join(F.broadcast(mine), "path", "left_semi"), sinks.read_index_of(spark, index, mine)).select("content_hash", "arrow_bytes")
            facts = _settled(arrow_tables.with_facts(corpus).drop("arrow_bytes"))
            broken = corpus.join(facts.filter("error IS NOT NULL").select("content_hash"), "content_hash", "left_semi").select("content_hash", "arrow_bytes")
            kept = cleaned(corpus, config, detector, quality, facts).select("content_hash", "arrow_bytes")
            transaction.save_tables(kept.unionByName(broken), own, file_format, shared_mount=shared_mount)
        done.append(transaction.read_manifest(spark, own).withColumn("chunk", F.lit(chunk)))
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], f"{sinks.MANIFEST}, chunk int")


def process(spark: SparkSession, directory: str, index: str, out: str, config: Config, chunk: int | None = None, chunk_size: int = 512, file_format: str = "parquet", detector=None, quality=None, shared_mount: bool = False) -> DataFrame:
    """Clean a corpus, or one chunk of its files, and write a file per table; returns the manifest.

    ``out`` and ``shared_mount`` are as for ``tablesift.sources.sinks.write_tables``.
    """
    rows = shards.read_shards(spark, directory).select("key", "arrow_bytes", "path")
    if chunk is not None:
        paths = chunk_of(shards.shard_paths(rows), "path", chunk_size, chunk)
        rows = rows.join(F.broadcast(paths.select("path")), "path", "left_semi")  # at most chunk_size names
        out = sinks.chunk_directory(out, chunk)
    corpus = deduped(rows, sinks.read_index(spark, index)).select("content_hash", "arrow_bytes")
    return sinks.write_tables(cleaned(corpus, config, detector, quality), out, file_format, shared_mount=shared_mount)

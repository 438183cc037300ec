"""Shards: Parquet files in which every row is a table as an Arrow stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The fields of a shard's rows.
ELEMENT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("job", "batch", "part", "key", "ref", "error", "bucket", "ref_id", "exec_id", "run_metadata", "context_metadata", "arrow_bytes_error")] + [T.StructField("arrow_bytes", T.BinaryType())]
)


def read_shards(spark: SparkSession, directory: str, paths: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """All rows of all Parquet files below a folder, with the file they are from as ``path``.

    Columns that aren't asked for aren't read.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    reader = reader.schema(schema) if schema is not None else reader
    return reader.parquet(*(paths or [directory])).select("*", F.col("_metadata.file_path").alias("path"))


def shard_paths(shards: DataFrame, most: int | None = None) -> DataFrame:
    """The files, or the first ``most`` by name; one row per file."""
    paths = shards.select("path").distinct()
    return paths.orderBy("path").limit(most) if most is not None else paths


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """A table by its file's extension."""
    if path.endswith(".parquet"):
        return spark.read.option("ignoreCorruptFiles", "true").parquet(path)
    if path.endswith(".csv"):
        return spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    raise ValueError(f"neither .parquet nor .csv: {path}")


def labelled(low: DataFrame, high: list[DataFrame], label: str = "quality") -> DataFrame:
    """Rows of low and of high quality together, labelled 0 and 1."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [h.withColumn(label, F.lit(1)) for h in high], low.withColumn(label, F.lit(0)))


def feature_lists(spark: SparkSession, directory: str) -> DataFrame:
    """From folders of a table (csv) and a list of its features (jsonl with name and is_target): folder, csv, target.

    Folders with a file ``variables*.csv`` are left out, as are those without one of the two files; of
    several, the first by name counts.  Folders of which not exactly one feature is the target are an error.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory).select("path")
    files = files.select("path", F.regexp_replace("path", r"/[^/]*$", "").alias("folder"), F.regexp_extract("path", r"([^/]*)$", 1).alias("name"))
    first = lambda ending: F.min(F.when(F.endswith("name", F.lit(ending)), F.col("path")))
    folders = files.groupBy("folder").agg(first(".csv").alias("csv"), first(".jsonl").alias("jsonl"), F.bool_or(F.col("name").rlike(r"^variables.*\.csv$")).alias("variables"))
    folders = folders.filter(~F.col("variables") & F.col("csv").isNotNull() & F.col("jsonl").isNotNull()).select("folder", "csv", "jsonl")
    listed = spark.read.schema("name string, is_target boolean").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").json(directory).select("name", "is_target", F.col("_metadata.file_path").alias("jsonl"))
    targets = listed.filter("is_target").groupBy("jsonl").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("target"))
    joined = folders.join(targets, "jsonl", "left")
    message = F.concat(F.lit("not exactly one target in "), F.col("folder"))
    return joined.withColumn("target", F.when(F.col("n") == 1, F.col("target")).otherwise(F.raise_error(message))).select("folder", "csv", "target")


def label_targets(statistics: DataFrame, features: DataFrame, name: str = "col_name") -> DataFrame:
    """Column statistics with ``is_target`` of the feature of that name; a name that isn't listed exactly once is an error."""
    once = features.groupBy(F.col("name").alias(name)).agg(F.count(F.lit(1)).alias("__n"), F.max("is_target").alias("is_target"))
    checked = once.withColumn("is_target", F.when(F.col("__n") == 1, F.col("is_target")).otherwise(F.raise_error(F.concat(F.lit("listed more than once: "), F.col(name)))))
    return statistics.join(checked.drop("__n"), name)

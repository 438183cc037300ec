"""Writers: the dedup index, one file per table, and a manifest of what was written."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.csv
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.operators.dedup import path_token
from tablesift.sources.arrow_tables import decoded

MANIFEST = "table_id string, path string, rows long, error string"
#: Bytes of a folder's name in common file systems, and the characters that Spark writes as three in it.
_NAME_BYTES, _ESCAPED = 255, r"""[\x01-\x1F\x7F"#%'*/:=?\\{\[\]^]"""


def index_folder(path: Column) -> Column:
    """The folder of a source file's part of the index: the path's token, or its md5 where no folder can have so long a name."""
    token = path_token(path)
    size = F.octet_length(token) + 2 * F.regexp_count(token, F.lit(_ESCAPED)) + len("shard=")
    return F.when(size > _NAME_BYTES, F.concat(F.lit("md5-"), F.md5(token))).otherwise(token)


def write_index(index: DataFrame, directory: str) -> None:
    """The index by source file, each file's part in a folder of its own."""
    index.withColumn("shard", index_folder(F.col("path"))).repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(directory)


def read_index(spark: SparkSession, directory: str) -> DataFrame:
    return spark.read.parquet(directory).select("key", "path", "content_hash")


def read_index_of(spark: SparkSession, directory: str, paths: DataFrame) -> DataFrame:
    """The index of some files only: ``paths`` is thin, and the folders of other files aren't read, as Spark prunes them when it knows the paths."""
    tokens = F.broadcast(paths.select(index_folder(F.col("path")).alias("shard")))  # a chunk's names
    return spark.read.parquet(directory).join(tokens, "shard", "left_semi").select("key", "path", "content_hash")


def chunk_directory(directory: str, index: int) -> str:
    return f"{directory}/chunk-{index:04}"


def qualified(spark: SparkSession, path: str) -> str:
    """A path as an encoded URI of the store that it stands in, also where Spark finds it through a mount table that only Spark knows."""
    jvm, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    given = jvm.Path(path)
    store = given.getFileSystem(conf)
    there, below = store.makeQualified(given), []
    while there.getParent() is not None and not store.exists(there):
        below.append(there.getName())
        there = there.getParent()
    found = store.resolvePath(there)
    for name in reversed(below):
        found = jvm.Path(found, name)
    uri = found.toUri().toASCIIString()
    return "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri


def write_tables(corpus: DataFrame, directory: str, file_format: str = "parquet", table_id: str = "content_hash", blob: str = "arrow_bytes", shared_mount: bool = False) -> DataFrame:
    """One file per table; returns the manifest, lazily, so use it once.

    ``directory`` is a path or URI that all executors reach; Spark's default file
    system counts where it has no scheme, and a folder of one machine is refused on
    a cluster unless ``shared_mount`` says that all executors have it.  A file's name is
    the table's id; it is written under a name of the attempt and then renamed, so what
    stands there is whole, whatever tasks run again or twice.  Null blobs are left
    out; what fails is a row of the manifest with its error.
    """
    if file_format not in ("parquet", "csv"):
        raise ValueError("file_format is 'parquet' or 'csv'")
    directory = qualified(corpus.sparkSession, directory)
    if directory.startswith("file:") and not shared_mount and not corpus.sparkSession.sparkContext.master.startswith("local"):
        raise ValueError(f"executors don't share this folder: {directory}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(directory)
        store.create_dir(base, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for i in range(batch.num_rows):
                name, data = batch.column(table_id)[i].as_py(), batch.column(blob)[i].as_py()
                if data is None:
                    continue
                path, rows = f"{base}/{name}.{file_format}", None
                table, error = decoded(data)
                if table is not None:
                    try:
                        with store.open_output_stream(f"{path}.{attempt}") as out:
                            (pyarrow.parquet.write_table if file_format == "parquet" else pyarrow.csv.write_csv)(table, out)
                        store.move(f"{path}.{attempt}", path)
                        rows = table.num_rows
                    except (pa.ArrowException, OSError) as failed:
                        error = f"{type(failed).__name__}: {failed}"[:500]
                made = zip(([name], [path if rows is not None else None], [rows], [error]), (pa.string(), pa.string(), pa.int64(), pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in made], ["table_id", "path", "rows", "error"])

    return corpus.select(table_id, blob).mapInArrow(run, MANIFEST)


def write_run(path: str, **settings) -> None:
    """A run's settings as JSON beside its results."""
    with open(path, "w") as out:
        json.dump(settings, out, indent=4, sort_keys=True, default=str)

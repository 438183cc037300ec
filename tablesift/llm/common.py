"""Helpers that several operators share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a set of keys may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000

#: The size of the map of ``among``: 2**27 bits are 16 MB.
FILTER_BITS = 27

#: Bytes of text that an Arrow worker handles at a time.
SLICE_BYTES = 2 << 20

#: Bytes of an Arrow batch on its way to a worker.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which all executors share; a temporary folder only where none is set and all is on one machine."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return sc._jsc.sc().getCheckpointDir().get()


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of thin rows by a checkpoint; a lost executor costs nothing that is kept there."""
    _shared_folder(df.sparkSession)
    return df.checkpoint()


def rewritten(df: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """Write whole rows as Parquet in the shared folder and read them again; for many rows, as it is smaller than a checkpoint.

    The path is added to ``paths``, for ``discard``.
    """
    path = f"{_shared_folder(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``rewritten`` made, once what was made of them is settled."""
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def small(df: DataFrame, parts: str | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit`` rows, else as it is.

    ``df`` should be settled, for it is counted first.  Meant for thin rows
    (a key and a number or two), so the limit bounds the bytes as well.  Where rows
    hold an array, ``parts`` names it, and its elements count as rows do.
    """
    count = df.agg(F.count(F.lit(1)) + (F.coalesce(F.sum(F.size(parts)), F.lit(0)) if parts else F.lit(0))).first()[0]
    return F.broadcast(df) if count <= limit else df


def among(rows: DataFrame, keys: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` without most of those whose 64-bit hash ``column`` isn't among ``keys``, which the join that follows then needn't shuffle.

    ``keys`` is settled.  Few keys are left to a broadcast join.  More of them set a bit
    each, by their first ``bits`` bits, and a map of ``2**bits`` bits, whatever the size of
    the table, is broadcast; none is made for so many keys that it would be full.
    """
    count = keys.count()
    if count <= BROADCAST_ROWS or count > 1 << bits:
        return rows
    return _mapped(rows, keys, column, bits).filter("__met").select(*rows.columns)


def outside(rows: DataFrame, keys: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` whose long ``column``, never null, isn't among ``keys``.

    ``keys`` is settled.  If they are too many to broadcast, rows outside of the map that
    ``among`` describes aren't shuffled.
    """
    count = keys.count()
    if count <= BROADCAST_ROWS or count > 1 << bits:
        return rows.join(small(keys), column, "left_anti")
    hashed = F.xxhash64(column).alias("__hash")
    marked = _mapped(rows.select("*", hashed), keys.select(hashed), "__hash", bits)
    apart = marked.filter("__met").select(*rows.columns).join(keys, column, "left_anti").select(*rows.columns)
    return marked.filter("NOT __met").select(*rows.columns).union(apart)


def _mapped(rows: DataFrame, keys: DataFrame, column: str, bits: int) -> DataFrame:
    """``rows`` with ``__met``: whether a bit is set for their ``column`` in a map of ``keys``."""
    value = F.shiftrightunsigned(column, 64 - bits) + 1
    maps = keys.groupBy(F.bitmap_bucket_number(value).alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("__bits"))
    place = F.bitmap_bit_position(value)
    byte = F.conv(F.hex(F.substring("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.withColumn("__bucket", F.bitmap_bucket_number(value)).join(F.broadcast(maps), "__bucket", "left")
    return met.withColumn("__met", F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False)))


def tidied(spark: SparkSession) -> None:
    """Let Spark delete shuffle files and checkpoints that nothing refers to any more.

    It does so when the driver's memory happens to be collected, which for a query of many
    small jobs may be at its end; until then they fill the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_of(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def bounded_batches(spark: SparkSession) -> None:
    """Let Spark cut the Arrow batches of this session at ``BATCH_BYTES``, too; a limit of the user's own stays.

    By default 10,000 rows are a batch, so that of texts a whole partition is.  Outside of its
    heap the JVM holds a batch twice, in buffers that grow by doubling, and the worker once more.
    Rows and results are the same; a longer row is a batch of its own.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, BATCH_BYTES)


def plainly_named(df: DataFrame) -> DataFrame:
    """``df`` with columns c0, c1 and so on, so that no name clashes with an operator's own or has a dot in it."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place_of(df: DataFrame, name: str) -> str:
    """The name that ``plainly_named`` gives to a column."""
    return f"c{df.columns.index(name)}"


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has about ``limit`` bytes of text, or one row."""
    col = batch.column(batch.schema.get_field_index(column))
    if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
        col = col.cast(pa.large_binary())
    ends = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    start = 0
    while start < len(col):
        stop = int(np.searchsorted(ends, ends[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), len(col))
        yield batch.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()

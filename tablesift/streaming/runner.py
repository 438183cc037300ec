"""Runs a stream over what its source has now, and reads the result as a table."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which all executors share; a temporary folder only where none is set and all is on one machine."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return sc._jsc.sc().getCheckpointDir().get()


def run_once(stream: DataFrame, path: str | None = None, mode: str = "append") -> DataFrame:
    """Write all that is there to Parquet, exactly once, and read it; a run that is repeated with the same path goes on."""
    path = path or f"{shared_folder(stream.sparkSession)}/stream-{uuid.uuid4().hex}"
    query = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start(path)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)

"""A sink for tables that is all or nothing: files and their manifest appear together, or not at all.

It is a Spark data source.  A task writes its tables, and its part of the manifest, into a folder of its
attempt; what it tells the driver is that folder's name and two counts.  When all tasks are through, the
driver moves each of these folders to its place, one rename for a task, and then writes the
commit, a small file by one rename, which names them.  Readers go by the commit, so they see
none or all of a run; attempts that failed or ran twice are never named and are deleted at the end, at
the latest with the next commit.  One run at a time writes to a folder.

The manifest is a table like any other: it can be read again, and as often as is liked.

Defined results: a blob that can't be decoded, or written in the format, is a row of the manifest with its error and no path; a null
blob is left out; tables of equal id in one task get a file each; a run without tables commits an empty
manifest; a folder that holds a commit is refused, unless it is to be overwritten.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from tablesift.sources.arrow_tables import decoded
from tablesift.sources.sinks import MANIFEST, qualified

COMMIT = "_commit.json"
_ROWS = pa.schema([("table_id", pa.string()), ("path", pa.string()), ("rows", pa.int64()), ("error", pa.string())])
#: Rows of the manifest that a task holds at a time.
_HELD = 4096


def _store(directory: str):  # noqa: ANN202
    from pyarrow import fs

    return fs.FileSystem.from_uri(directory)


def _exists(store, path: str) -> bool:  # noqa: ANN001
    from pyarrow import fs

    return store.get_file_info(path).type != fs.FileType.NotFound


@dataclass
class Written(WriterCommitMessage):
    """A task's folder, and how many tables and errors its part of the manifest has; no folder if there was nothing."""

    folder: str | None
    tables: int
    errors: int


class TableWriter(DataSourceArrowWriter):
    """Writes rows of an id and a blob."""

    def __init__(self, directory: str, file_format: str, overwrite: bool):
        self.directory, self.file_format, self.overwrite = directory, file_format, overwrite
        self.run = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, base = _store(self.directory)
        task = TaskContext.get()
        own = f"{task.partitionId():06}"
        attempt = f"{base}/_attempts/{self.run}/{own}-{task.taskAttemptId()}"
        names: dict[str, int] = {}
        rows: list[tuple] = []
        tables = errors = 0
        sink = None
        for batch in iterator:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not data.is_valid:
                    continue
                if sink is None:
                    store.create_dir(f"{attempt}/manifest", recursive=True)
                    out = store.open_output_stream(f"{attempt}/manifest/part.parquet")
                    sink = pyarrow.parquet.ParquetWriter(out, _ROWS)
                table, error = decoded(data.as_buffer())
                file, count = None, None
                if table is not None:
                    names[name] = again = names.get(name, 0) + 1
                    file = f"{name}{'' if again == 1 else f'-{again}'}.{self.file_format}"
                    try:
                        with store.open_output_stream(f"{attempt}/{file}") as to:
                            (pyarrow.parquet.write_table if self.file_format == "parquet" else pyarrow.csv.write_csv)(table, to)
                        count = table.num_rows
                    except pa.ArrowException as failed:  # what the store can't do ends the task, what the format can't is told
                        store.delete_file(f"{attempt}/{file}")
                        file, error = None, f"{type(failed).__name__}: {failed}"[:500]
                tables, errors = tables + (error is None), errors + (error is not None)
                rows.append((name, None if file is None else f"{base}/{self.run}-{own}/{file}", count, error))
                if len(rows) >= _HELD:
                    sink.write_table(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ROWS.types)], schema=_ROWS))
                    rows = []
        if sink is None:
            return Written(None, 0, 0)
        if rows:
            sink.write_table(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ROWS.types)], schema=_ROWS))
        sink.close()
        out.close()
        return Written(attempt.rpartition("/")[2], tables, errors)

    def commit(self, messages: list[Written | None]) -> None:
        store, base = _store(self.directory)
        before = _committed(store, base)
        if before is not None and not self.overwrite:
            self.abort(messages)
            raise ValueError(f"{self.directory} holds a commit already")
        parts = []
        for message in messages:
            if message is not None and message.folder:
                part = f"{self.run}-{message.folder.partition('-')[0]}"
                store.move(f"{base}/_attempts/{self.run}/{message.folder}", f"{base}/{part}")
                parts.append(part)
        told = {"run": self.run, "parts": parts, "tables": sum(m.tables for m in messages if m), "errors": sum(m.errors for m in messages if m)}
        store.create_dir(base, recursive=True)
        with store.open_output_stream(f"{base}/_{self.run}.json") as out:
            out.write(json.dumps(told).encode())
        store.move(f"{base}/_{self.run}.json", f"{base}/{COMMIT}")
        # Those of earlier runs, too: a task that goes on when another has failed may end after ``abort``.
        if _exists(store, f"{base}/_attempts"):
            store.delete_dir(f"{base}/_attempts")
        for part in (before or {}).get("parts", []):
            store.delete_dir(f"{base}/{part}")

    def abort(self, messages: list[Written | None]) -> None:
        """Attempts are deleted; what was committed before stays."""
        store, base = _store(self.directory)
        if _exists(store, f"{base}/_attempts/{self.run}"):
            store.delete_dir(f"{base}/_attempts/{self.run}")


class TableSink(DataSource):
    """``df.write.format("tables")``: two columns, a table's id and its blob; options ``path`` and ``tables``, the files' format."""

    @classmethod
    def name(cls) -> str:
        return "tables"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("table_id", T.StringType()), T.StructField("blob", T.BinaryType())])

    def writer(self, schema: T.StructType, overwrite: bool) -> TableWriter:
        file_format = self.options.get("tables", "parquet")
        if file_format not in ("parquet", "csv"):
            raise ValueError("tables are written as 'parquet' or 'csv'")
        if [f.dataType for f in schema] != [T.StringType(), T.BinaryType()]:
            raise ValueError("an id and a blob are written")
        return TableWriter(self.options["path"], file_format, overwrite)


def _committed(store, base: str) -> dict | None:  # noqa: ANN001
    if not _exists(store, f"{base}/{COMMIT}"):
        return None
    with store.open_input_stream(f"{base}/{COMMIT}") as file:
        return json.loads(file.read())


def committed(spark: SparkSession, directory: str) -> dict | None:
    """The commit of a folder, None if there is none: its run, its parts, and how many tables and errors there are."""
    return _committed(*_store(qualified(spark, directory)))


def save_tables(corpus: DataFrame, directory: str, file_format: str = "parquet", table_id: str = "content_hash", blob: str = "arrow_bytes", overwrite: bool = False, shared_mount: bool = False) -> DataFrame:
    """Write a file for each table, all or none; returns the manifest, to be read as often as is liked.

    ``directory`` is as for ``tablesift.sources.sinks.write_tables``.
    """
    spark = corpus.sparkSession
    place = qualified(spark, directory)
    if place.startswith("file:") and not shared_mount and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"executors don't share this folder: {place}")
    spark.dataSource.register(TableSink)
    rows = corpus.select(F.col(table_id).cast("string").alias("table_id"), F.col(blob).alias("blob"))
    rows.write.format("tables").mode("overwrite" if overwrite else "append").option("path", place).option("tables", file_format).save()
    return read_manifest(spark, directory)


def read_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """The rows of a committed folder; of one without a commit there are none."""
    parts = (committed(spark, directory) or {}).get("parts", [])
    if not parts:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(*[f"{directory}/{p}/manifest" for p in parts])

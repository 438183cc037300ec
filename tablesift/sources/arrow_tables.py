"""Tables as Arrow streams in a binary column, and as rows of their cells.

A blob is decoded once to its facts (names, types, number of rows) and once to
cells; whatever is decided about cells is applied to the blob by row and column
numbers, so types survive.  Only a task's current table is in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELLS = "table_id string, row_idx long, col_idx int, col_name string, kind string, value string"
FACTS = "nrows long, ncols long, names array<string>, dtypes array<string>, error string"
#: Rows of a table that are turned into cells at a time.
_ROWS = 4096


def decoded(blob: bytes | None) -> tuple[pa.Table | None, str | None]:
    """The table, or why there is none."""
    if blob is None:
        return None, "no bytes"
    try:
        with pa.ipc.open_stream(blob) as stream:
            return stream.read_all(), None
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ValueError, TypeError) as error:
        return None, f"{type(error).__name__}: {error}"[:500]


def encoded(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as stream:
        stream.write_table(table)
    return out.getvalue().to_pybytes()


def arrow_kind(t: pa.DataType) -> str:
    if pa.types.is_boolean(t):
        return "bool"
    if pa.types.is_integer(t) or pa.types.is_floating(t):
        return "numeric"
    return "datetime" if pa.types.is_timestamp(t) else "object"


def _text(column: pa.ChunkedArray) -> pa.Array:
    """Cells as text, NaN as null."""
    t = column.type
    if pa.types.is_dictionary(t):
        column = column.cast(t.value_type)
        t = column.type
    values = column.to_pylist()
    if pa.types.is_binary(t) or pa.types.is_large_binary(t):
        return pa.array([None if v is None else _bytes_text(v) for v in values], pa.string())
    return pa.array([None if v is None or v != v else v if isinstance(v, str) else str(v) for v in values], pa.string())


def _bytes_text(value: bytes) -> str:
    try:
        return value.decode()
    except UnicodeDecodeError:
        return value.decode("iso-8859-1")


def with_facts(corpus: DataFrame, blob: str = "arrow_bytes") -> DataFrame:
    """Add nrows, ncols, names, dtypes and error to each blob."""
    added = [f.split()[0] for f in FACTS.split(", ")]
    rest = [f for f in corpus.schema if f.name not in added]
    schema = T.StructType(rest + list(T._parse_datatype_string(FACTS)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                table, error = decoded(one.column(blob)[0].as_py())
                facts = [table.num_rows, table.num_columns, table.column_names, [str(t) for t in table.schema.types]] if table is not None else [None] * 4
                made = [pa.array([v], t) for v, t in zip([*facts, error], (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()))]
                yield pa.RecordBatch.from_arrays([one.column(f.name) for f in rest] + made, [f.name for f in rest] + added)

    return corpus.mapInArrow(run, schema)


def cells(corpus: DataFrame, table_id: str = "content_hash", blob: str = "arrow_bytes") -> DataFrame:
    """Every cell of every table that can be decoded, as a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                table, _ = decoded(batch.column(blob)[i].as_py())
                if table is None:
                    continue
                name = batch.column(table_id)[i].as_py()
                for c, (title, column) in enumerate(zip(table.column_names, table.columns)):
                    for start in range(0, table.num_rows, _ROWS):
                        values = _text(column.slice(start, _ROWS))
                        n = len(values)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([name] * n, pa.string()), pa.array(range(start, start + n), pa.int64()), pa.array([c] * n, pa.int32()), pa.array([title] * n, pa.string()), pa.array([arrow_kind(column.type)] * n, pa.string()), values],
                            ["table_id", "row_idx", "col_idx", "col_name", "kind", "value"],
                        )

    return corpus.select(F.col(table_id).alias(table_id), blob).mapInArrow(run, CELLS)


def trimmed(corpus: DataFrame, blob: str = "arrow_bytes", rows: str = "kept_rows", columns: str = "kept_columns") -> DataFrame:
    """Blobs with only the rows and columns whose numbers the arrays name (null: all)."""
    rest = [f for f in corpus.schema if f.name not in (blob, rows, columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                table, _ = decoded(one.column(blob)[0].as_py())
                own_rows, own_columns = one.column(rows)[0].as_py(), one.column(columns)[0].as_py()
                if table is not None and own_columns is not None:
                    table = table.select(sorted(own_columns))
                if table is not None and own_rows is not None:
                    table = table.take(pa.array(sorted(own_rows), pa.int64()))
                made = pa.array([None if table is None else encoded(table)], pa.binary())
                yield pa.RecordBatch.from_arrays([*[one.column(f.name) for f in rest], made], [*[f.name for f in rest], blob])

    return corpus.mapInArrow(run, T.StructType([*rest, T.StructField(blob, T.BinaryType())]))


def blobs(df: DataFrame, table_id: str, columns: list[str], order: list[str]) -> DataFrame:
    """One Arrow stream per value of ``table_id``; each is a whole table, so it must fit in a task."""
    schema = T.StructType([T.StructField("content_hash", T.StringType()), T.StructField("arrow_bytes", T.BinaryType())])

    def run(key: tuple, own: pa.Table) -> pa.Table:
        table = own.sort_by([(c, "ascending") for c in order]).select(columns)
        return pa.table({"content_hash": pa.array([str(key[0].as_py())], pa.string()), "arrow_bytes": pa.array([encoded(table)], pa.binary())})

    return df.groupBy(table_id).applyInArrow(run, schema)

"""Kinds of columns, as the summaries and filters tell them apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC, BOOL, DATETIME, OBJECT = "numeric", "bool", "datetime", "object"


def kind(data_type: T.DataType) -> str:
    """Intervals and everything nested count as object."""
    if isinstance(data_type, T.BooleanType):
        return BOOL
    if isinstance(data_type, (T.DecimalType, T.DateType)):
        return OBJECT
    if isinstance(data_type, T.NumericType):
        return NUMERIC
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return DATETIME
    return OBJECT


def string_like(data_type: T.DataType) -> bool:
    return kind(data_type) == OBJECT


def named(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_text(column: Column, data_type: T.DataType) -> Column:
    """A cell as text: bytes decoded, nested values as JSON."""
    from tablesift.functions.predicates import decoded

    if isinstance(data_type, T.BinaryType):
        return decoded(column)
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(column)
    if isinstance(data_type, T.BooleanType):
        return F.when(column, "True").when(~column, "False")
    return column.cast("string")


def normalised(df: DataFrame) -> DataFrame:
    """NaN as null in float columns, and columns without a type as strings."""
    out = {}
    for field in df.schema:
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            out[field.name] = F.nanvl(named(field.name), F.lit(None).cast(field.dataType))
        elif isinstance(field.dataType, T.NullType):
            out[field.name] = named(field.name).cast("string")
    return df.withColumns(out) if out else df

"""What the filters need to know of a table's columns, in one pass over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesift.functions import predicates as P
from tablesift.functions.kinds import as_text, kind, named, normalised, string_like


def column_profile(df: DataFrame, min_unique: int = 2) -> DataFrame:
    """One row per column: col_idx, col_name, kind, string_like, n, enough_unique, frac_null_like, frac_code, frac_pii.

    All columns share one aggregation.  Two distinct values are told by the
    smallest and the largest; more need a distinct count.
    """
    df = normalised(df)
    out = []
    for i, field in enumerate(df.schema):
        text = as_text(named(field.name), field.dataType)
        strings = string_like(field.dataType)
        if min_unique <= 1:
            unique = F.count(text) >= min_unique
        elif min_unique == 2:
            unique = F.coalesce(F.min(text) != F.max(text), F.lit(False))
        else:
            unique = F.count_distinct(text) >= min_unique
        null = F.coalesce(P.share(P.null_like(text)), F.lit(0.0)) if strings else F.coalesce(P.share(text.isNull()), F.lit(0.0))
        out.append(
            F.struct(
                F.lit(i).alias("col_idx"), F.lit(field.name).alias("col_name"), F.lit(kind(field.dataType)).alias("kind"), F.lit(strings).alias("string_like"), F.count(F.lit(1)).alias("n"),
                unique.alias("enough_unique"), null.alias("frac_null_like"),
                (P.share(P.contains_code(text)) if strings else F.lit(0.0)).alias("frac_code"), (P.share(P.contains_pii(text)) if strings else F.lit(0.0)).alias("frac_pii"),
            ).alias(f"c{i}")
        )
    wide = df.agg(*out)
    return wide.select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(out))])).alias("c")).select("c.*")


def table_profile(df: DataFrame) -> DataFrame:
    """nrows, ncols, headers and the counts of types, as one row."""
    types = [t for _, t in df.dtypes]
    headers = " ".join(c.replace("\n", "") for c in df.columns)
    counts = F.array(*[F.struct(F.lit(t).alias("dtype"), F.lit(types.count(t)).alias("n")) for t in sorted(set(types))])
    return df.agg(F.count(F.lit(1)).alias("nrows")).select("nrows", F.lit(len(types)).cast("long").alias("ncols"), F.lit(headers).alias("headers"), counts.alias("dtype_counts"))

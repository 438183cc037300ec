"""Samples that depend on the rows alone: ordered by a digest, not by chance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesift.functions.kinds import as_text, named


def digest(df: DataFrame, seed: int = 0) -> Column:
    """md5 of a row's values and a seed."""
    values = [F.coalesce(as_text(named(f.name), f.dataType), F.lit("\0")) for f in df.schema]
    return F.md5(F.concat_ws("\1", *values, F.lit(str(seed))))


def sampled_rows(df: DataFrame, rows: int, key: Column | None = None, seed: int = 0) -> DataFrame:
    """At most ``rows`` rows, those of the smallest digests; Spark keeps that many per task."""
    key = F.md5(F.concat_ws("", key.cast("string"), F.lit(f":{seed}"))) if key is not None else digest(df, seed)
    return df.withColumn("__digest", key).orderBy("__digest").limit(rows).drop("__digest")


def sampled_names(names: list[str], count: int, seed: int = 0) -> list[str]:
    """At most ``count`` names, in their own order."""
    import hashlib

    if len(names) <= count:
        return list(names)
    chosen = set(sorted(range(len(names)), key=lambda i: (hashlib.md5(f"{names[i]}:{seed}".encode()).hexdigest(), i))[:count])
    return [name for i, name in enumerate(names) if i in chosen]


def chunk_of(paths: DataFrame, path: str, size: int, index: int, seed: int = 2974) -> DataFrame:
    """The ``index``-th slice of ``size`` paths in the order of their digests.

    ``paths`` is a list of files, thin and without repeats.
    """
    order = Window.orderBy(F.md5(F.concat_ws("", F.col(path), F.lit(f":{seed}"))), path)
    place = F.row_number().over(order) - 1
    return paths.withColumn("chunk", F.floor(place / size)).filter(F.col("chunk") == index)


def stratified_split(df: DataFrame, label: str, key: str, train: float = 0.8, seed: int = 42) -> DataFrame:
    """Add ``in_train``: of each label exactly that share, rounded, by digest.

    Counts per label and digest prefix come first, so that no label's rows meet in one task.
    """
    keyed = df.withColumn("__digest", F.md5(F.concat_ws("", F.col(key).cast("string"), F.lit(f":{seed}")))).withColumn("__part", F.substring("__digest", 1, 3))
    parts = keyed.groupBy(label, "__part").agg(F.count(F.lit(1)).alias("__in_part"))
    before = Window.partitionBy(label).orderBy("__part")
    parts = parts.select(label, "__part", (F.sum("__in_part").over(before) - F.col("__in_part")).alias("__before"), F.sum("__in_part").over(Window.partitionBy(label)).alias("__total"))
    ranked = keyed.withColumn("__rank", F.row_number().over(Window.partitionBy(label, "__part").orderBy("__digest", key)))
    joined = ranked.join(F.broadcast(parts), [label, "__part"])  # at most 4096 rows for each label
    return joined.withColumn("in_train", F.col("__before") + F.col("__rank") <= F.round(F.col("__total") * train)).select(*df.columns, "in_train")

"""Summaries of columns, headers and tables, as features of a quality model.

Per column there are generic statistics (missing values, most and least
frequent value, entropy) and those of its kind; per table, each statistic is
aggregated over the columns.  Names are ``{prefix}{statistic}_{aggregate}``,
with ``quantile0_1`` and the like inside Spark; ``public_name`` gives the dotted
form.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesift.functions import predicates as P
from tablesift.functions.kinds import BOOL, DATETIME, NUMERIC, OBJECT, as_text, kind, named, normalised
from tablesift.operators.dedup import duplicate_count

GENERIC = ("missing", "missing_frac", "most_frequent_count", "most_frequent_frac", "least_frequent_count", "least_frequent_frac", "entropy")
OWN = {
    "num_": ("kurtosis", "skewness", "mad", "std"),
    "bool_": ("bool_mean",),
    "obj_": ("n_unique", "min_length", "max_length", "mean_length", "median_length"),
    "dt_": ("time_span_secs", "time_span_days", "time_span_years", "timedelta_mean", "is_monotonic"),
}
HEADER = ("header_num_chars", "header_num_underscore", "header_num_words")
TABLE = ("duplicate_count", "duplicate_frac", "dtype_unique_count", "n", "ncols") + tuple(f"dtype_{k}_{s}" for k in ("numeric", "bool", "object", "datetime") for s in ("count", "frac"))
QUANTILES = (0.1, 0.25, 0.75, 0.9)
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "min": F.min, "max": F.max, "mean": F.avg, "median": lambda c: F.percentile(c, F.lit(0.5)),
    **{f"quantile{str(q).replace('.', '_')}": (lambda c, q=q: F.percentile(c, F.lit(q))) for q in QUANTILES},
}
_PREFIX = {NUMERIC: "num_", BOOL: "bool_", OBJECT: "obj_", DATETIME: "dt_"}


def column_keys() -> list[str]:
    """The names of all statistics of one column, of every kind."""
    return [f"{p}{s}" for p, own in OWN.items() for s in GENERIC + own] + list(HEADER)


def feature_names() -> list[str]:
    """All features of a table, sorted."""
    return sorted([f"{k}_{a}" for k in column_keys() for a in AGGREGATES] + [f"table_{k}" for k in TABLE])


def public_name(feature: str) -> str:
    return feature.replace("quantile0_", "quantile0.")


def _over(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def generic(counted: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Generic statistics from (keys, value, c): how often each value occurs, null values included; ``more`` are further aggregates."""
    c, there = F.col("c"), F.col("value").isNotNull()
    held = F.when(there, c)
    n, m = F.sum("c"), F.coalesce(F.sum(held), F.lit(0))
    # sum of -p ln p = ln m - sum(c ln c) / m
    entropy = F.when(m > 0, F.ln(m) - F.sum(held * F.ln(held)) / m).otherwise(0.0)
    most, least = F.coalesce(F.max(held), F.lit(0)), F.coalesce(F.min(held), F.lit(0))
    return counted.groupBy(*keys).agg(
        (n - m).cast("double").alias("missing"), _over(n - m, n).alias("missing_frac"), most.cast("double").alias("most_frequent_count"), _over(most, m).alias("most_frequent_frac"),
        least.cast("double").alias("least_frequent_count"), _over(least, m).alias("least_frequent_frac"), entropy.alias("entropy"), *more,
    )


def skewness(x: Column) -> Column:
    """Bias-corrected; 0 for a constant column of three values and more, else null."""
    n, g = F.count(x).cast("double"), F.skewness(x)
    return F.when(n < 3, F.lit(None)).when(F.var_pop(x) == 0, 0.0).otherwise(g * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def kurtosis(x: Column) -> Column:
    """Bias-corrected excess; 0 for a constant column of four values and more, else null."""
    n, g = F.count(x).cast("double"), F.kurtosis(x)
    return F.when(n < 4, F.lit(None)).when(F.var_pop(x) == 0, 0.0).otherwise((n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * g + 6))


def _own(df: DataFrame, name: str, kind_: str, order: Column | None) -> DataFrame:
    """The statistics of a column's kind, as one row."""
    x = named(name)
    if kind_ == BOOL:
        return df.agg(F.avg(x.cast("int")).alias("bool_mean"))
    if kind_ == OBJECT:
        text = x.cast("string") if dict(df.dtypes)[name] not in ("binary",) else P.decoded(x)
        length = F.length(F.coalesce(text, F.lit("None"))).cast("double")
        return df.agg(F.min(length).alias("min_length"), F.max(length).alias("max_length"), F.avg(length).alias("mean_length"), F.percentile(length, F.lit(0.5)).alias("median_length"))
    if kind_ == DATETIME:
        micros = F.unix_micros(x.cast("timestamp"))
        span = (F.max(micros) - F.min(micros)) / 1e6
        m = F.count(x)
        more = m > 1
        got = df.agg(*[F.when(more, v).otherwise(0.0).alias(k) for k, v in {"time_span_secs": span, "time_span_days": span / 86400, "time_span_years": span / 86400 / 365.25, "timedelta_mean": span / F.nullif(m - 1, F.lit(0))}.items()])
        return got.crossJoin(F.broadcast(_monotonic(df, micros, order)))  # one row each
    value = x.cast("double")
    mean = df.agg(F.avg(value).alias("__mean"))
    got = df.crossJoin(F.broadcast(mean))  # one row
    return got.agg(kurtosis(value).alias("kurtosis"), skewness(value).alias("skewness"), F.avg(F.abs(value - F.col("__mean"))).alias("mad"), F.stddev_samp(value).alias("std"))


def _monotonic(df: DataFrame, micros: Column, order: Column | None) -> DataFrame:
    """Whether values rise or fall in row order.

    Values in order are compared within blocks of consecutive rows, and the blocks' ends with each
    other, so that no task sees more than a block's rows.
    """
    from pyspark.sql import Window

    rows = df.select(micros.alias("t"), (order if order is not None else F.monotonically_increasing_id()).alias("o"), F.spark_partition_id().alias("p")).filter("t IS NOT NULL")
    if order is not None:
        rows = rows.withColumn("p", F.floor(F.col("o") / 100_000))
    before = F.lag("t").over(Window.partitionBy("p").orderBy("o"))
    steps = rows.withColumn("d", F.col("t") - before)
    blocks = steps.groupBy("p").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.min_by("t", "o").alias("first"), F.max_by("t", "o").alias("last"))
    joint = blocks.withColumn("d", F.col("first") - F.lag("last").over(Window.orderBy("p")))  # a row per block
    lo, hi = F.min(F.least("lo", "d")), F.max(F.greatest("hi", "d"))
    return joint.agg(F.when(lo.isNull(), 0.0).when((lo >= 0) | (hi <= 0), 1.0).otherwise(0.0).alias("is_monotonic"))


def column_summary(df: DataFrame, name: str, order: Column | None = None, kind_: str | None = None) -> DataFrame:
    """All statistics of one column as one row, named without prefix.  ``order`` is the row order, for dates."""
    df = normalised(df)
    field = df.schema[name]
    kind_ = kind_ or kind(field.dataType)
    # Texts are told apart by a digest, so that no long value is shuffled.
    value = named(name) if kind_ != OBJECT else F.md5(named(name).cast("binary" if dict(df.dtypes)[name] in ("string", "binary") else "string"))
    counted = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("c"))
    unique = [F.count("value").cast("double").alias("n_unique")] if kind_ == OBJECT else []
    both = generic(counted.withColumn("__one", F.lit(1)), ["__one"], *unique).join(_own(df, name, kind_, order).withColumn("__one", F.lit(1)), "__one")
    return both.drop("__one")


def header_summary(df: DataFrame, names: Column) -> DataFrame:
    """Lengths, underscores and words of headers that stand in a column."""
    return df.select(names.alias("col_name"), P.header_chars(names).alias("header_num_chars"), P.header_underscores(names).alias("header_num_underscore"), P.header_words(names).alias("header_num_words"))


def single_column_features(df: DataFrame, name: str, order: Column | None = None) -> DataFrame:
    """All column keys for one column as one row; those of other kinds are null."""
    kind_ = kind(normalised(df).schema[name].dataType)
    got = column_summary(df, name, order, kind_)
    prefix = _PREFIX[kind_]
    header = {"header_num_chars": P.header_chars, "header_num_underscore": P.header_underscores, "header_num_words": P.header_words}
    own = {f"{prefix}{s}": F.col(s).cast("double") for s in GENERIC + OWN[prefix]} | {k: f(F.lit(name)) for k, f in header.items()}
    return got.select(*[own.get(k, F.lit(None).cast("double")).alias(k) for k in column_keys()])


def table_summary(df: DataFrame) -> DataFrame:
    """The statistics of the table itself, as one row."""
    kinds = [kind(f.dataType) for f in df.schema]
    count = {k: sum(x == k for x in kinds) for k in (NUMERIC, BOOL, OBJECT, DATETIME)}
    count[NUMERIC] += count[BOOL]  # bools are numeric as well
    got = duplicate_count(df)
    fixed = {"dtype_unique_count": len({t for _, t in df.dtypes}), "ncols": len(kinds)} | {f"dtype_{k}_count": v for k, v in count.items()} | {f"dtype_{k}_frac": v / max(len(kinds), 1) for k, v in count.items()}
    values = {"duplicate_count": F.col("duplicate_count"), "duplicate_frac": _over(F.col("duplicate_count"), F.col("n")), "n": F.col("n")} | {k: F.lit(v) for k, v in fixed.items()}
    return got.select(*[values[k].cast("double").alias(k) for k in TABLE])


def over_columns(stats: DataFrame, keys: list[str], by: list[str] | None = None, aggregates: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Aggregate each statistic over the columns, by ``AGGREGATES`` or others: rows of ``stats`` are columns of tables, ``by`` names the table."""
    wide = [f(F.when(~F.isnan(named(k)), named(k))).alias(f"{k}_{a}") for k in keys for a, f in (aggregates or AGGREGATES).items()]
    return stats.groupBy(*(by or [])).agg(*wide)


def cells_of(df: DataFrame, order: Column | None = None, table_id: str = "") -> DataFrame:
    """The cells of one table as rows, in one scan; ``order`` is the row order, for dates."""
    df = normalised(df)
    made = [F.struct(F.lit(i).alias("col_idx"), F.lit(f.name).alias("col_name"), F.lit(kind(f.dataType)).alias("kind"), as_text(named(f.name), f.dataType).alias("value")) for i, f in enumerate(df.schema)]
    row = (order if order is not None else F.monotonically_increasing_id()).cast("long")
    # A row's number is made before its cells are.
    rows = df.select(row.alias("row_idx"), F.array(*made).alias("cells"))
    return rows.select(F.lit(table_id).alias("table_id"), "row_idx", F.explode("cells").alias("cell")).select("table_id", "row_idx", "cell.*")


def _short(value: Column) -> Column:
    """Long values are told apart by a digest."""
    return F.when(F.length(value) > 32, F.md5(value.cast("binary"))).otherwise(value)


def _thin(cells: DataFrame) -> DataFrame:
    """Cells with their values' lengths and digests in the place of long values, settled."""
    from tablesift.streaming.runner import shared_folder

    shared_folder(cells.sparkSession)
    return cells.withColumns({"length": F.length("value"), "value": _short(F.col("value"))}).checkpoint()


def column_statistics(cells: DataFrame) -> DataFrame:
    """All column keys for every column of every table, from its cells: table_id, col_idx, col_name, kind and a double per key, null where it is of another kind."""
    by, value, more = ["table_id", "col_idx"], F.col("value"), F.col("m") > 1
    of = lambda k, c: F.when(F.col("kind") == k, c)
    if "length" not in cells.columns:
        cells = cells.withColumns({"length": F.length("value"), "value": _short(value)})
    counted = cells.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("c"))
    every = generic(counted, by, F.count("value").cast("double").alias("n_unique"))
    x, length, micros = of(NUMERIC, value.try_cast("double")), of(OBJECT, F.coalesce("length", F.lit(4)).cast("double")), of(DATETIME, F.unix_micros(value.try_cast("timestamp")))
    heads = cells.groupBy(*by).agg(F.first("col_name").alias("col_name"), F.first("kind").alias("kind"), F.avg(x).alias("__mean"))
    span = (F.max(micros) - F.min(micros)) / 1e6
    own = cells.join(heads.select(*by, "__mean"), by).groupBy(*by).agg(
        kurtosis(x).alias("kurtosis"), skewness(x).alias("skewness"), F.avg(F.abs(x - F.col("__mean"))).alias("mad"), F.stddev_samp(x).alias("std"), F.avg(of(BOOL, (value == "True").cast("int"))).alias("bool_mean"),
        F.min(length).alias("min_length"), F.max(length).alias("max_length"), F.avg(length).alias("mean_length"), F.percentile(length, F.lit(0.5)).alias("median_length"), span.alias("span"), F.count(micros).alias("m"),
    )
    held = {"time_span_secs": F.col("span"), "time_span_days": F.col("span") / 86400, "time_span_years": F.col("span") / 86400 / 365.25, "timedelta_mean": F.col("span") / F.nullif(F.col("m") - 1, F.lit(0))}
    own = own.withColumns({k: F.when(more, v).otherwise(0.0) for k, v in held.items()})
    joined = heads.join(every, by).join(own, by).join(_rising(cells.filter(F.col("kind") == DATETIME), micros), by, "left")
    header = {"header_num_chars": P.header_chars, "header_num_underscore": P.header_underscores, "header_num_words": P.header_words}
    keys = {f"{p}{s}": F.when(F.col("kind") == k, F.col(s).cast("double")) for k, p in _PREFIX.items() for s in GENERIC + OWN[p]} | {k: f(F.col("col_name")) for k, f in header.items()}
    return joined.select(*by, "col_name", "kind", *[keys[k].alias(k) for k in column_keys()])


def _rising(cells: DataFrame, micros: Column) -> DataFrame:
    """Whether the dates of each column rise or fall in row order, by blocks of rows."""
    from pyspark.sql import Window

    by = ["table_id", "col_idx"]
    rows = cells.select(*by, "row_idx", F.floor(F.col("row_idx") / 100_000).alias("block"), micros.alias("t")).filter("t IS NOT NULL")
    steps = rows.withColumn("d", F.col("t") - F.lag("t").over(Window.partitionBy(*by, "block").orderBy("row_idx")))
    blocks = steps.groupBy(*by, "block").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.min_by("t", "row_idx").alias("first"), F.max_by("t", "row_idx").alias("last"))
    joint = blocks.withColumn("d", F.col("first") - F.lag("last").over(Window.partitionBy(*by).orderBy("block")))
    lo, hi = F.min(F.least("lo", "d")), F.max(F.greatest("hi", "d"))
    return joint.groupBy(*by).agg(F.when(lo.isNull(), 0.0).when((lo >= 0) | (hi <= 0), 1.0).otherwise(0.0).alias("is_monotonic"))


def table_features(df: DataFrame, order: Column | None = None) -> DataFrame:
    """All features of a table as one row; its cells are read in a few scans, however many columns there are."""
    own = table_summary(df)
    both = over_columns(column_statistics(cells_of(df, order)), column_keys()).crossJoin(own.select(*[F.col(c).alias(f"table_{c}") for c in own.columns]))  # one row each
    return both.select(*feature_names())


def features_of_tables(cells: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """All features of every table, table_id and one row each, from the tables' cells.

    ``facts`` has the types of each table's columns (table_id, dtypes); without it the kinds of columns are counted as types.
    """
    # The cells are read several times; thin ones are kept, so that each table is decoded once.
    cells = _thin(cells)
    columns = column_statistics(cells)
    whole = F.md5(F.to_json(F.array_sort(F.collect_list(F.struct("col_idx", "value")))))
    rows = cells.groupBy("table_id", "row_idx").agg(whole.alias("digest")).groupBy("table_id", "digest").agg(F.count(F.lit(1)).alias("c"))
    rows = rows.groupBy("table_id").agg(F.sum(F.col("c") - 1).alias("duplicate_count"), F.sum("c").alias("n"))
    count = lambda *kinds: F.sum(F.col("kind").isin(*kinds).cast("int"))
    kinds = columns.groupBy("table_id").agg(
        F.count(F.lit(1)).alias("ncols"), count(NUMERIC, BOOL).alias("dtype_numeric_count"), count(BOOL).alias("dtype_bool_count"), count(OBJECT).alias("dtype_object_count"), count(DATETIME).alias("dtype_datetime_count"),
        F.size(F.collect_set("kind")).alias("dtype_unique_count"),
    )
    if facts is not None:
        kinds = kinds.drop("dtype_unique_count").join(facts.select("table_id", F.size(F.array_distinct("dtypes")).alias("dtype_unique_count")), "table_id")
    own = rows.join(kinds, "table_id").withColumns({"duplicate_frac": _over(F.col("duplicate_count"), F.col("n"))} | {f"dtype_{k}_frac": F.col(f"dtype_{k}_count") / F.col("ncols") for k in ("numeric", "bool", "object", "datetime")})
    own = own.select("table_id", *[F.col(k).cast("double").alias(f"table_{k}") for k in TABLE])
    return over_columns(columns, column_keys(), ["table_id"]).join(own, "table_id").select("table_id", *feature_names())


def pairwise_pearson(df: DataFrame, names: list[str]) -> DataFrame:
    """Pearson's r of every pair of numeric columns; rows with a null in either don't count.

    Each task multiplies batches of rows, moved by the columns' means, as matrices; what is
    shuffled is a few sums for each pair and task, however many rows there are.
    """
    plain = normalised(df).select(*[named(a).cast("double").alias(f"c{i}") for i, a in enumerate(names)])
    means = plain.agg(*[F.avg(c).alias(c) for c in plain.columns]).first() or []
    centre = np.array([m or 0.0 for m in means])
    one, two = np.triu_indices(len(names), 1)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(names), len(names)))
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], 1) - centre
            there = ~np.isnan(x)
            x, there = np.where(there, x, 0.0), there.astype(float)
            total += [there.T @ there, x.T @ there, there.T @ x, (x * x).T @ there, there.T @ (x * x), x.T @ x]
        yield pa.RecordBatch.from_arrays([pa.array(one, pa.int32()), pa.array(two, pa.int32()), *[pa.array(t[one, two]) for t in total]], ["a", "b", "n", "x", "y", "xx", "yy", "xy"])

    parts = plain.mapInArrow(sums, "a int, b int, n double, x double, y double, xx double, yy double, xy double").groupBy("a", "b")
    got = parts.agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    n = F.col("n")
    spread = F.sqrt((n * F.col("xx") - F.col("x") ** 2) * (n * F.col("yy") - F.col("y") ** 2))
    name = F.array(*[F.lit(a) for a in names])
    return got.select(F.get(name, F.col("a")).alias("a"), F.get(name, F.col("b")).alias("b"), F.when(spread > 0, (n * F.col("xy") - F.col("x") * F.col("y")) / spread).alias("r"))


def mutual_information(df: DataFrame, a: str, b: str, bins: int = 32) -> DataFrame:
    """Mutual information in nats over a grid of equal-width bins, an estimate that needs counts alone."""
    x, y = named(a).cast("double"), named(b).cast("double")
    rows = normalised(df).filter(x.isNotNull() & y.isNotNull()).select(x.alias("x"), y.alias("y"))
    ends = F.broadcast(rows.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count(F.lit(1)).alias("n")))
    bin_ = lambda v, lo, hi: F.when(F.col(hi) > F.col(lo), F.least(F.floor((F.col(v) - F.col(lo)) / (F.col(hi) - F.col(lo)) * bins), F.lit(bins - 1))).otherwise(0)
    cells = rows.crossJoin(ends).groupBy(bin_("x", "x0", "x1").alias("i"), bin_("y", "y0", "y1").alias("j")).agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
    sums = cells.join(F.broadcast(cells.groupBy("i").agg(F.sum("c").alias("ci"))), "i").join(F.broadcast(cells.groupBy("j").agg(F.sum("c").alias("cj"))), "j")  # bins rows each
    return sums.agg(F.sum(F.col("c") / F.col("n") * F.ln(F.col("c") * F.col("n") / (F.col("ci") * F.col("cj")))).alias("mutual_information"))


def score_quantiles(scores: DataFrame, score: str, at: tuple[float, ...] = (0.5, 0.75, 0.8, 0.85, 0.9, 0.95, 0.975, 0.99, 0.999), bins: int = 65_536) -> DataFrame:
    """Linear quantiles of a score, one row each, exact.

    Scores are counted in bins of equal width; only those in the bins where quantiles lie are put in
    order, so no task holds all of them.
    """
    from pyspark.sql import Window

    rows = scores.select(F.col(score).cast("double").alias("v")).filter("v IS NOT NULL AND NOT isnan(v)")
    ends = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / bins
    binned = rows.crossJoin(F.broadcast(ends)).select("v", "n", F.when(width > 0, F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0).alias("bin"))  # one row
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))  # at most ``bins`` rows
    counts = counts.withColumn("before", F.sum("c").over(Window.orderBy("bin")) - F.col("c"))
    place = lambda q: F.lit(q) * (F.col("n") - 1)
    meets = lambda q: (F.floor(place(q) + 1) >= F.col("before")) & (F.floor(place(q)) < F.col("before") + F.col("c"))
    near = counts.filter(reduce(lambda a, b: a | b, [meets(q) for q in at])).select("bin", "before")
    ranked = binned.join(F.broadcast(near), "bin").groupBy("bin", "before", "n", "v").agg(F.count(F.lit(1)).alias("c"))
    ranked = ranked.withColumn("last", F.col("before") + F.sum("c").over(Window.partitionBy("bin").orderBy("v")) - 1).withColumn("first", F.col("last") - F.col("c") + 1)

    def held(position: Column) -> Column:
        return F.max(F.when((F.col("first") <= position) & (position <= F.col("last")), F.col("v")))

    def value(q: float) -> Column:
        low, high, part = held(F.floor(place(q))), held(F.least(F.floor(place(q)) + 1, F.col("n") - 1)), F.max(place(q) - F.floor(place(q)))
        return low + (high - low) * part

    got = ranked.agg(*[value(q).alias(f"q{i}") for i, q in enumerate(at)])
    return got.select(F.explode(F.array(*[F.struct(F.lit(q).alias("quantile"), F.col(f"q{i}").alias("value")) for i, q in enumerate(at)])).alias("z")).select("z.*")


def majority_accuracy(df: DataFrame, label: str) -> DataFrame:
    share = F.avg(F.col(label).cast("double"))
    return df.agg(F.count(F.lit(1)).alias("n"), share.alias("positive"), F.greatest(share, 1 - share).alias("majority_accuracy"))


def dtype_counts(df: DataFrame) -> DataFrame:
    """How many columns have each type, as rows."""
    types = [t for _, t in df.dtypes]
    return df.sparkSession.createDataFrame([(t, types.count(t)) for t in sorted(set(types))], "dtype string, n long")

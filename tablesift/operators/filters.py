"""Filters on rows, columns and whole tables, and chains of them.

Row filters select, column filters project, table filters accept or reject and
change nothing.  Each takes and returns Spark DataFrames, one per table; chains
over a corpus of many tables are in ``tablesift.plans.corpus``.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tablesift.functions import predicates as P
from tablesift.functions.kinds import as_text, named, string_like
from tablesift.operators.profile import column_profile
from tablesift.operators.sampling import sampled_names, sampled_rows


class _Chain:
    """An ordered list of filters of one type."""

    kind: type

    def __init__(self, filters: Iterable = ()):
        self.filters: list = []
        self.extend(filters)

    def append(self, one) -> None:
        if not isinstance(one, self.kind):
            raise TypeError(f"{one!r} is not a {self.kind.__name__}")
        self.filters.append(one)

    def extend(self, some: Iterable) -> None:
        for one in some:
            self.append(one)


# Rows


class RowFilter(ABC):
    @abstractmethod
    def apply(self, df: DataFrame) -> DataFrame: ...


class CellFilter(RowFilter):
    """Drops rows in which some cell, as text, satisfies a predicate."""

    def __init__(self, predicate: Callable[[Column], Column], string_columns_only: bool = False):
        self.predicate, self.string_columns_only = predicate, string_columns_only

    def dropped(self, df: DataFrame) -> Column:
        cells = [as_text(named(f.name), f.dataType) for f in df.schema if not self.string_columns_only or string_like(f.dataType)]
        return reduce(lambda a, b: a | b, [F.coalesce(self.predicate(c), F.lit(False)) for c in cells], F.lit(False))

    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(~self.dropped(df))


class MaxValueLengthFilter(CellFilter):
    def __init__(self, max_characters: int, string_columns_only: bool = True):
        super().__init__(lambda c: P.longer_than(c, max_characters), string_columns_only)


class SubstringFilter(CellFilter):
    def __init__(self, substrings: list[str] | tuple[str, ...], string_columns_only: bool = False):
        if isinstance(substrings, str):
            raise ValueError("substrings must be a list of strings, not one string")
        super().__init__(lambda c: P.contains_any(c, tuple(substrings)), string_columns_only)


class CodeRegexFilter(CellFilter):
    def __init__(self) -> None:
        super().__init__(P.contains_code, True)


class PIIRegexFilter(CellFilter):
    def __init__(self) -> None:
        super().__init__(P.contains_pii, True)


class DuplicateRowsFilter(RowFilter):
    """One of each set of equal rows stays."""

    def apply(self, df: DataFrame) -> DataFrame:
        return df.dropDuplicates()


class MaxRowCountFilter(RowFilter):
    """At most that many rows, by digest."""

    def __init__(self, max_rows: int, key: str | None = None, seed: int = 0):
        self.max_rows, self.key, self.seed = max_rows, key, seed

    def apply(self, df: DataFrame) -> DataFrame:
        return sampled_rows(df, self.max_rows, named(self.key) if self.key else None, self.seed)


class RowFilterChain(_Chain):
    kind = RowFilter

    def apply(self, df: DataFrame) -> DataFrame:
        return reduce(lambda d, f: f.apply(d), self.filters, df)


# Columns


class ColumnFilter(ABC):
    @abstractmethod
    def apply(self, df: DataFrame) -> DataFrame: ...


def valid_columns(profile: list[Row], max_header_len: int, max_null_like: float | None = None) -> list[str]:
    """Names short enough, with values that vary and are there; ``profile`` has the rows of ``column_profile``."""
    return [c.col_name for c in profile if len(c.col_name) < max_header_len and c.enough_unique and (max_null_like is None or c.frac_null_like < max_null_like)]


class InvalidColumnsFilter(ColumnFilter):
    def __init__(self, max_header_len: int, min_unique: int, max_null_like: float | None = None):
        self.max_header_len, self.min_unique, self.max_null_like = max_header_len, min_unique, max_null_like

    def apply(self, df: DataFrame) -> DataFrame:
        # One row per column comes to the driver, to make the projection.
        keep = valid_columns(column_profile(df, self.min_unique).collect(), self.max_header_len, self.max_null_like)
        return df.select(*[named(c) for c in keep])


class MaxColumnsFilter(ColumnFilter):
    def __init__(self, max_columns: int = 512, seed: int = 0):
        self.max_columns, self.seed = max_columns, seed

    def apply(self, df: DataFrame) -> DataFrame:
        return df.select(*[named(c) for c in sampled_names(df.columns, self.max_columns, self.seed)])


class ColumnFilterChain(_Chain):
    kind = ColumnFilter

    def apply(self, df: DataFrame) -> DataFrame:
        return reduce(lambda d, f: f.apply(d), self.filters, df)


# Tables


class TableFacts:
    """What table filters ask of a table; the pass over its rows is made once, and only if one asks for it."""

    def __init__(self, df: DataFrame, min_unique: int = 2):
        self.df, self.min_unique = df, min_unique
        self._columns: dict[int, list[Row]] = {}

    def columns(self, min_unique: int | None = None) -> list[Row]:
        wanted = self.min_unique if min_unique is None else min_unique
        if wanted not in self._columns:
            self._columns[wanted] = column_profile(self.df, wanted).collect() if self.df.columns else []
        return self._columns[wanted]

    @property
    def rows(self) -> int:
        columns = self.columns()
        return columns[0].n if columns else self.df.count()


class TableFilter(ABC):
    #: Filters that only ask for names and types come first, then those of one pass over the rows, then models.
    stage = 1
    min_unique: int | None = None

    @abstractmethod
    def accepts(self, facts: TableFacts) -> bool: ...

    def decision(self, columns: Column, df: DataFrame) -> Column:
        """The same as an expression over the rows of ``column_profile`` in an array."""
        raise NotImplementedError(f"{type(self).__name__} isn't an expression")


class RowCountFilter(TableFilter):
    def __init__(self, min_rows: int, max_rows: int | None = None):
        self.min_rows, self.max_rows = min_rows, max_rows

    def accepts(self, facts: TableFacts) -> bool:
        return self.min_rows <= facts.rows and (self.max_rows is None or facts.rows <= self.max_rows)

    def decision(self, columns: Column, df: DataFrame) -> Column:
        rows = F.coalesce(F.get(columns, F.lit(0))["n"], F.lit(0))
        return (rows >= self.min_rows) & (F.lit(True) if self.max_rows is None else rows <= self.max_rows)


class ColumnCountFilter(TableFilter):
    stage = 0

    def __init__(self, min_columns: int, max_columns: int | None = None):
        self.min_columns, self.max_columns = min_columns, max_columns

    def accepts(self, facts: TableFacts) -> bool:
        count = len(facts.df.columns)
        return self.min_columns <= count and (self.max_columns is None or count <= self.max_columns)

    def decision(self, columns: Column, df: DataFrame) -> Column:
        return F.lit(self.accepts(TableFacts(df)))


def header_flags(names: Column) -> dict[str, Column]:
    """Of an array of headers: the share of numeric and of unnamed ones, whether one is key and value, and whether all are one object."""
    count = F.greatest(F.size(names), F.lit(1))
    part = lambda p: F.size(F.filter(names, p)) / count
    first, last = F.get(names, F.lit(0)), F.get(names, F.size(names) - 1)
    return {
        "frac_numeric": part(P.is_number),
        "frac_unnamed": part(P.is_unnamed),
        "key_value": F.exists(names, P.is_key_value),
        "braced": F.coalesce(F.startswith(first, F.lit("{")) & F.endswith(last, F.lit("}")), F.lit(False)),
    }


def bad_headers(names: Column, max_frac_numeric: float | None = None, max_frac_unnamed: float | None = None) -> Column:
    flags = header_flags(names)
    bad = flags["key_value"] | flags["braced"]
    if max_frac_numeric is not None:
        bad |= flags["frac_numeric"] > max_frac_numeric
    if max_frac_unnamed is not None:
        bad |= flags["frac_unnamed"] > max_frac_unnamed
    return bad


class BadHeadersFilter(TableFilter):
    stage = 0

    def __init__(self, max_frac_numeric: float | None = None, max_frac_unnamed: float | None = None):
        self.max_frac_numeric, self.max_frac_unnamed = max_frac_numeric, max_frac_unnamed

    def accepts(self, facts: TableFacts) -> bool:
        names = F.array(*[F.lit(c) for c in facts.df.columns]) if facts.df.columns else F.array().cast("array<string>")
        return not facts.df.sparkSession.range(1).select(bad_headers(names, self.max_frac_numeric, self.max_frac_unnamed)).first()[0]

    def decision(self, columns: Column, df: DataFrame) -> Column:
        names = F.transform(columns, lambda c: c["col_name"])
        return ~bad_headers(names, self.max_frac_numeric, self.max_frac_unnamed)


class SchemaFilter(TableFilter):
    stage = 0

    def __init__(self, min_dtypes: int | None = None):
        self.min_dtypes = min_dtypes

    def accepts(self, facts: TableFacts) -> bool:
        return self.min_dtypes is None or len({t for _, t in facts.df.dtypes}) >= self.min_dtypes

    def decision(self, columns: Column, df: DataFrame) -> Column:
        return F.lit(self.accepts(TableFacts(df)))


class ValidColumnCountFilter(TableFilter):
    def __init__(self, max_header_len: int, min_unique: int, max_null_like: float | None, min_columns: int):
        self.max_header_len, self.min_unique, self.max_null_like, self.min_columns = max_header_len, min_unique, max_null_like, min_columns

    def accepts(self, facts: TableFacts) -> bool:
        return len(valid_columns(facts.columns(self.min_unique), self.max_header_len, self.max_null_like)) >= self.min_columns

    def decision(self, columns: Column, df: DataFrame) -> Column:
        def valid(c: Column) -> Column:
            good = (F.length(c["col_name"]) < self.max_header_len) & c["enough_unique"]
            return good if self.max_null_like is None else good & (c["frac_null_like"] < self.max_null_like)

        return F.size(F.filter(columns, valid)) >= self.min_columns


class CodeDetectionFilter(TableFilter):
    def __init__(self, threshold: float | None = None):
        self.threshold = threshold

    def accepts(self, facts: TableFacts) -> bool:
        return self.threshold is None or all(c.frac_code <= self.threshold for c in facts.columns())

    def decision(self, columns: Column, df: DataFrame) -> Column:
        return F.lit(True) if self.threshold is None else F.forall(columns, lambda c: c["frac_code"] <= self.threshold)


class PIIDetectionFilter(TableFilter):
    """With a threshold set, any personal data rejects; ``strict`` compares the share with the threshold instead."""

    def __init__(self, threshold: float | None = None, strict: bool = False):
        self.threshold, self.strict = threshold, strict

    def accepts(self, facts: TableFacts) -> bool:
        most = self.threshold if self.strict else 0.0
        return self.threshold is None or all(c.frac_pii <= most for c in facts.columns())

    def decision(self, columns: Column, df: DataFrame) -> Column:
        most = self.threshold if self.strict else 0.0
        return F.lit(True) if self.threshold is None else F.forall(columns, lambda c: c["frac_pii"] <= most)


class ClassifierBasedFilter(TableFilter):
    stage = 2


class TableQualityFilter(ClassifierBasedFilter):
    """Accepts tables whose probability of good quality is above the threshold."""

    def __init__(self, features: Callable[[DataFrame], DataFrame], score: Callable[[DataFrame], DataFrame], threshold: float):
        self.features, self.score, self.threshold = features, score, threshold

    def accepts(self, facts: TableFacts) -> bool:
        row = self.score(self.features(facts.df)).select("score").first()
        return row is not None and row.score is not None and row.score > self.threshold


class EnglishFilter(TableFilter):
    """By the language of the headers."""

    stage = 0

    def __init__(self, detector: Callable[[Column], Column], threshold: float = 0.5):
        self.detector, self.threshold = detector, threshold

    def accepts(self, facts: TableFacts) -> bool:
        headers = F.lit(" ".join(c.replace("\n", "") for c in facts.df.columns))
        return facts.df.sparkSession.range(1).select(P.is_english(self.detector(headers), self.threshold)).first()[0]

    def decision(self, columns: Column, df: DataFrame) -> Column:
        return P.is_english(self.detector(F.array_join(F.transform(columns, lambda c: F.replace(c["col_name"], F.lit("\n"), F.lit(""))), " ")), self.threshold)


class TableFilterChain(_Chain):
    kind = TableFilter

    def accepts(self, df: DataFrame | None) -> bool:
        """Whether all accept; the cheapest are asked first, as their order doesn't matter."""
        if df is None:
            return False
        facts = TableFacts(df, next((f.min_unique for f in self.filters if isinstance(f, ValidColumnCountFilter)), 2))
        return all(f.accepts(facts) for f in sorted(self.filters, key=lambda f: f.stage))

    def decided(self, df: DataFrame) -> DataFrame:
        """``accepted`` as one row, lazily, by filters that need no model: the decisions on many tables are one job."""
        least = next((f.min_unique for f in self.filters if isinstance(f, ValidColumnCountFilter)), 2)
        profile = column_profile(df, least)
        row = profile.agg(F.sort_array(F.collect_list(F.struct(*profile.columns))).alias("columns"))
        return row.select(reduce(lambda a, b: a & b, [f.decision(F.col("columns"), df) for f in self.filters], F.lit(True)).alias("accepted"))

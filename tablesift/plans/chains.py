"""Filter chains of a configuration, for one table as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablesift.operators import filters as O
from tablesift.plans.config import Config

_LONGEST = 1 << 30


def _quality(config: Config, position: str, quality: O.TableQualityFilter | None) -> list[O.TableFilter]:
    if config.table_quality_threshold is None or config.table_quality_position != position:
        return []
    if quality is None:
        if position == "pre":
            raise ValueError("this configuration asks a quality model before filtering: give one")
        return []
    return [quality]


def table_chain(config: Config, quality: O.TableQualityFilter | None = None) -> O.TableFilterChain:
    chain = O.TableFilterChain()
    if config.min_rows is not None:
        chain.append(O.RowCountFilter(config.min_rows, config.max_rows))
    if config.min_cols is not None:
        chain.append(O.ColumnCountFilter(config.min_cols, config.max_cols if config.filter_too_many_columns else None))
    chain.append(O.BadHeadersFilter(config.max_frac_numeric_colnames, config.max_frac_unnamed_colnames))
    if config.min_dtypes is not None:
        chain.append(O.SchemaFilter(config.min_dtypes))
    chain.append(O.ValidColumnCountFilter(config.max_header_len_chars or _LONGEST, config.min_unique_column_values, config.max_null_like_frac, config.min_cols or 0))
    chain.append(O.CodeDetectionFilter(config.code_detect_threshold))
    chain.append(O.PIIDetectionFilter(config.pii_detect_threshold, config.strict_pii_threshold))
    chain.extend(_quality(config, "pre", quality))
    return chain


def column_chain(config: Config) -> O.ColumnFilterChain:
    chain = O.ColumnFilterChain()
    if config.drop_invalid_cols:
        chain.append(O.InvalidColumnsFilter(config.max_header_len_chars or _LONGEST, config.min_unique_column_values, config.max_null_like_frac))
    if config.drop_extra_cols and config.max_cols is not None:
        chain.append(O.MaxColumnsFilter(config.max_cols))
    return chain


def row_chain(config: Config) -> O.RowFilterChain:
    chain = O.RowFilterChain()
    if config.max_value_len_chars is not None:
        chain.append(O.MaxValueLengthFilter(config.max_value_len_chars))
    if config.filter_substrings:
        chain.append(O.SubstringFilter(config.filter_substrings))
    if config.filter_code_rows:
        chain.append(O.CodeRegexFilter())
    if config.filter_pii_rows:
        chain.append(O.PIIRegexFilter())
    if config.drop_duplicate_rows:
        chain.append(O.DuplicateRowsFilter())
    if config.max_output_rows is not None:
        chain.append(O.MaxRowCountFilter(config.max_output_rows))
    return chain


def post_chain(config: Config, quality: O.TableQualityFilter | None = None) -> O.TableFilterChain:
    chain = O.TableFilterChain()
    if config.min_rows is not None:
        chain.append(O.RowCountFilter(config.min_rows, config.max_rows))
    chain.extend(_quality(config, "post", quality))
    return chain


def process_table(df: DataFrame, config: Config, detector=None, quality: O.TableQualityFilter | None = None) -> DataFrame | None:
    """The cleaned table, or None if it is rejected."""
    if detector is not None and not O.EnglishFilter(detector, config.langdetect_threshold).accepts(O.TableFacts(df)):
        return None
    if not table_chain(config, quality).accepts(df):
        return None
    out = row_chain(config).apply(column_chain(config).apply(df))
    return out if post_chain(config, quality).accepts(out) else None

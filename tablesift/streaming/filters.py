"""Row filters and deduplication on streams.

The filters' conditions are Column expressions, so they hold on a stream as
they are; what needs a whole table (counts, shares, samples) stays batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesift.operators.dedup import content_hash
from tablesift.operators.filters import CellFilter, RowFilterChain


def filtered(stream: DataFrame, chain: RowFilterChain) -> DataFrame:
    """Rows that the chain's cell filters keep; other filters need a bounded table."""
    other = [f for f in chain.filters if not isinstance(f, CellFilter)]
    if stream.isStreaming and other:
        raise ValueError(f"not for streams: {', '.join(type(f).__name__ for f in other)}")
    return chain.apply(stream)


def deduped(stream: DataFrame, time: str, within: str, key: str = "key") -> DataFrame:
    """The first element of each content hash within a span of event time; the state is bounded by it."""
    return stream.withColumn("content_hash", content_hash(F.col(key))).withWatermark(time, within).dropDuplicatesWithinWatermark(["content_hash"])


def shares(stream: DataFrame, text: str, time: str, window: str, late: str) -> DataFrame:
    """Per window of event time: rows, and the shares of code and personal data."""
    from tablesift.functions import predicates as P

    flagged = stream.withWatermark(time, late).groupBy(F.window(time, window).alias("window"))
    return flagged.agg(F.count(F.lit(1)).alias("n"), P.share(P.contains_code(F.col(text))).alias("frac_code"), P.share(P.contains_pii(F.col(text))).alias("frac_pii"))

"""Secrets and credentials of several parts (operator 10).

Base detectors report what is a secret on its own: an assignment to a name such
as ``password``, an access identifier, a long run of hex digits.  Weak
candidates say nothing alone: a mixed run of 40 characters may be anything, an
endpoint is public.  They are reported where complementary parts meet: a
candidate secret within ``SCOPE`` characters of an access identifier, and an
endpoint within ``SCOPE`` characters of such a pair.

Detectors run over Arrow batches, row by row.  Parts are thin rows; Spark joins
their intervals by row and by blocks of ``SCOPE`` characters, each identifier
standing in its own block and both beside it, so that a join only meets parts
that are near.  A block holds at most ``SCOPE`` characters, so it has a bounded
number of parts, as those of a kind don't overlap.

Defined results: null and empty texts have no spans; texts of any length are
read whole; equal rows are rows of their own with equal results; an empty table
gives no rows.  Other columns pass through.  Spans are of code points, the end
exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesift.llm.common import place_of, plainly_named, settle, slices, small, table, text_of

#: Characters between parts that belong together.
SCOPE = 512
#: Kinds in the order in which they are listed.
KINDS = ("assign", "access", "hex", "secret", "endpoint")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_MIXED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(r"(?:https?|s3|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s\"'<>]+|\b[a-z0-9.-]+\.(?:amazonaws\.com|windows\.net|googleapis\.com)\b")

_SPAN = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of what is a secret on its own."""
    found = [(0, *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found += [(1, *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return sorted(found + [(2, *m.span()) for m in _HEX.finditer(text)], key=lambda s: (s[1], s[0]))


def weak_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates that count only beside an access identifier; so texts without one have none."""
    if "AKIA" not in text:
        return []
    mixed = [(3, *m.span()) for m in _MIXED.finditer(text) if any(c.isdigit() for c in m[0]) and any(c.islower() for c in m[0]) and any(c.isupper() for c in m[0])]
    return mixed + [(4, *m.span()) for m in _ENDPOINT.finditer(text)]


def detected(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base`` and ``weak``, arrays of spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                rest = [i for i, n in enumerate(batch.schema.names) if n not in ("base", "weak")]
                texts = [t or "" for t in batch.column(text).to_pylist()]
                made = [pa.array([[dict(zip(("kind", "start", "stop"), s)) for s in spans(t)] for t in texts], _ARROW_SPANS) for spans in (base_spans, weak_spans)]
                yield pa.RecordBatch.from_arrays([batch.column(i) for i in rest] + made, [batch.schema.names[i] for i in rest] + ["base", "weak"])

    fields = [f for f in df.schema if f.name not in ("base", "weak")]
    return df.mapInArrow(run, T.StructType([*fields, T.StructField("base", T.ArrayType(_SPAN)), T.StructField("weak", T.ArrayType(_SPAN))]))


def _near(a: Column, b: Column, scope: int) -> Column:
    """The gap between two spans is below the scope."""
    return (F.greatest(a.start, b.start) - F.least(a.stop, b.stop)) <= scope


def linked(found: DataFrame, key: str, scope: int = SCOPE) -> DataFrame:
    """Weak spans that complementary parts confirm: ``key`` and ``linked``, sorted arrays of spans.

    ``found`` (settled) has one row for each ``key``, with base and weak; an interval join in two steps.
    """
    weak = found.filter(F.size("weak") > 0)
    access = weak.select(key, F.explode("base").alias("access")).filter("access.kind = 1")
    block = lambda c: (c / scope).cast("int")
    around = lambda span: F.sequence(block(span.start) - 1, block(span.stop) + 1)
    access = access.withColumn("block", F.explode(around(F.col("access"))))
    parts = weak.select(key, F.explode("weak").alias("part")).withColumn("block", F.explode(F.sequence(block(F.col("part.start")), block(F.col("part.stop")))))
    secrets = parts.filter("part.kind = 3").withColumnRenamed("part", "secret")
    pairs = access.join(secrets, [key, "block"]).filter(_near(F.col("access"), F.col("secret"), scope)).select(key, "access", "secret").distinct()
    whole = F.struct(F.least("access.start", "secret.start").alias("start"), F.greatest("access.stop", "secret.stop").alias("stop"))
    scopes = pairs.select(key, whole.alias("pair")).withColumn("block", F.explode(around(F.col("pair"))))
    ends = scopes.join(parts.filter("part.kind = 4"), [key, "block"]).filter(_near(F.col("pair"), F.col("part"), scope)).select(key, F.col("part").alias("span"))
    spans = pairs.select(key, F.col("secret").alias("span")).union(ends)
    return spans.groupBy(key).agg(F.sort_array(F.collect_set("span")).alias("linked"))


def scan(df: DataFrame, text: str = "text", scope: int = SCOPE, base: str = "base", spans: str = "spans") -> DataFrame:
    """All columns, and ``base`` and ``spans``: arrays of (kind, start, stop), by start and then kind; they replace columns of these names."""
    plain, place = plainly_named(df), place_of(df, text)
    keyed = plain.withColumn("key", F.md5(text_of(place).cast("binary")))
    # Equal texts have equal spans, so parts are linked once for each text; without an
    # access identifier there is nothing to link.
    weak = detected(keyed.filter(F.contains(text_of(place), F.lit("AKIA"))).select("key", place), place).filter(F.size("weak") > 0).select("key", "base", "weak")
    more = settle(linked(settle(weak.dropDuplicates(["key"])), "key", scope))
    joined = detected(keyed, place).drop("weak").join(small(more, "linked"), "key", "left")
    by_start = lambda a, b: F.when((a.start < b.start) | ((a.start == b.start) & (a.kind < b.kind)), -1).when((a.start == b.start) & (a.kind == b.kind), 0).otherwise(1)
    every = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(T.ArrayType(_SPAN)))), by_start)
    kept = [(f"c{i}", name) for i, name in enumerate(df.columns) if name not in (base, spans)]
    found = joined.select(*[c for c, _ in kept], "base", F.when(F.col("linked").isNull(), F.col("base")).otherwise(every).alias("spans"))
    return found.toDF(*[name for _, name in kept], base, spans)


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s.kind), s.start.cast("string"), s.stop.cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with ``[kind]`` for each span; of spans that overlap, the first covers the others."""
    kinds = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    cut = F.aggregate(
        spans,
        F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.when(s.start >= a["at"], F.concat(a.kept, F.substring(text, a["at"] + 1, s.start - a["at"]), F.get(kinds, s.kind))).otherwise(a.kept).alias("kept"),
            F.greatest(a["at"], s.stop).alias("at"),
        ),
        lambda a: F.concat(a.kept, F.substring(text, a["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every whole text."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text")))
    count = lambda kind: F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )

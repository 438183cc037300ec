"""One query per operator, over the given tables, with the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.functions import predicates as P
from tablesift.functions import words
from tablesift.functions.language import KnownLanguage, trigram_detector, trigram_model
from tablesift.operators import dedup, information, language_model, quality, sampling, summarize, trees
from tablesift.operators import filters as O
from tablesift.operators.profile import column_profile, table_profile
from tablesift.plans import chains, corpus
from tablesift.plans.config import config
from tablesift.sources import arrow_tables, shards
from tablesift.streaming import filters as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

V6 = config("v6")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
#: String columns of the tables that cell filters read, and all their columns.
STRINGS = {
    "region": "r_name", "nation": "n_name", "customer": "c_name c_mktsegment", "supplier": "s_name", "part": "p_name p_brand p_type", "orders": "o_orderstatus o_orderpriority",
    "lineitem": "l_returnflag l_linestatus", "events": "event_type props", "documents": "text lang source", "pages": "url html", "benchmark": "text", "labels": "", "conversations": "role text",
}
COLUMNS = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey", "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment", "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice", "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate", "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars", "pages": "page_id url html", "benchmark": "item_id text", "labels": "doc_id quality toxic", "conversations": "conv_id turn role text",
}
_CODE, _PII = P.SQL_CODE.replace("'", "''"), P.SQL_PII.replace("'", "''")
_NUMERICS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def is_code(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '{_CODE}'), false)"


def is_pii(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '{_PII}'), false)"


def is_null_like(x: str) -> str:
    return f"({x} IS NULL OR regexp_full_match({x}, '\\s*'))"


def has_substring(x: str) -> str:
    return "(" + " OR ".join(f"coalesce(contains({x}, '{s}'), false)" for s in V6.filter_substrings) + ")"


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Row filters


@query(f"SELECT doc_id, lang, n_chars FROM documents WHERE NOT ({is_code('text')} OR {is_code('lang')} OR {is_code('source')})")
def code_rows(spark, sf_dir):
    return O.CodeRegexFilter().apply(read(spark, sf_dir, "documents")).select("doc_id", "lang", "n_chars")


@query(f"SELECT doc_id, lang, n_chars FROM documents WHERE NOT ({is_pii('text')} OR {is_pii('lang')} OR {is_pii('source')})")
def pii_rows(spark, sf_dir):
    return O.PIIRegexFilter().apply(read(spark, sf_dir, "documents")).select("doc_id", "lang", "n_chars")


@query(f"SELECT 'documents' AS tbl, doc_id AS id FROM documents WHERE NOT {has_substring('text')} UNION ALL SELECT 'pages', page_id FROM pages WHERE NOT {has_substring('html')}")
def substring_rows(spark, sf_dir):
    chain = O.SubstringFilter(V6.filter_substrings)
    docs, pages = (chain.apply(read(spark, sf_dir, t)) for t in ("documents", "pages"))
    return docs.select(F.lit("documents").alias("tbl"), F.col("doc_id").alias("id")).unionAll(pages.select(F.lit("pages").alias("tbl"), F.col("page_id").alias("id")))


@query("SELECT doc_id, n_chars FROM documents WHERE length(text) <= 14336 AND length(lang) <= 14336 AND length(source) <= 14336")
def max_value_length(spark, sf_dir):
    return O.MaxValueLengthFilter(14336).apply(read(spark, sf_dir, "documents")).select("doc_id", "n_chars")


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def dedup_rows(spark, sf_dir):
    return O.DuplicateRowsFilter().apply(read(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY md5(concat(o_orderkey, ':0')) LIMIT 1000")
def sample_rows(spark, sf_dir):
    return O.MaxRowCountFilter(1000, key="o_orderkey").apply(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))


_ROW_CHAIN = " AND ".join([*[f"length({c}) <= 14336 AND NOT {is_code(c)} AND NOT {is_pii(c)}" for c in ("text", "lang", "source")], f"NOT {has_substring('text')}"])


@query(f"SELECT DISTINCT text, lang, source, n_chars FROM documents WHERE {_ROW_CHAIN}")
def row_chain_v6(spark, sf_dir):
    return chains.row_chain(replace(V6, max_output_rows=None)).apply(read(spark, sf_dir, "documents").select("text", "lang", "source", "n_chars"))


@query("SELECT event_id, user_id, value FROM events WHERE NOT coalesce(contains(props, '7'), false) AND NOT contains(event_type, '7')")
def custom_predicate_rows(spark, sf_dir):
    chain = O.RowFilterChain([O.CellFilter(lambda c: F.contains(c, F.lit("7")), string_columns_only=True)])
    return chain.apply(read(spark, sf_dir, "events")).select("event_id", "user_id", "value")


# Tables and headers

_TYPES = "SELECT table_name, count(*) AS ncols, count(DISTINCT data_type) AS n_dtypes, string_agg(column_name, ' ' ORDER BY column_index) AS headers FROM duckdb_columns() GROUP BY table_name"
_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS tbl, count(*) AS nrows FROM {t}" for t in TABLES)


@query(f"SELECT c.tbl, c.nrows, t.ncols, t.n_dtypes, t.headers FROM ({_COUNTS}) c JOIN ({_TYPES}) t ON t.table_name = c.tbl")
def table_profiles(spark, sf_dir):
    rows = [table_profile(read(spark, sf_dir, t)).select(F.lit(t).alias("tbl"), "nrows", "ncols", F.size("dtype_counts").cast("long").alias("n_dtypes"), "headers") for t in TABLES]
    return reduce(DataFrame.unionAll, rows)


_KV = P.KEY_VALUE.replace("'", "''")


@query(
    f"""WITH h AS (SELECT conv_id, list(text ORDER BY turn, text) AS names FROM conversations GROUP BY conv_id),
    f AS (SELECT conv_id, len(list_filter(names, lambda n: regexp_matches(n, '{P.NUMBER}'))) / len(names) AS frac_numeric,
      len(list_filter(names, lambda n: contains(n, '{P.UNNAMED}'))) / len(names) AS frac_unnamed,
      len(list_filter(names, lambda n: regexp_matches(n, '{_KV}'))) > 0 AS key_value,
      starts_with(names[1], '{{') AND ends_with(names[len(names)], '}}') AS braced FROM h)
    SELECT conv_id, round(frac_numeric, 9) AS frac_numeric, round(frac_unnamed, 9) AS frac_unnamed, key_value, braced,
      key_value OR braced OR frac_numeric > 0.1 OR frac_unnamed > 0.5 AS bad FROM f"""
)
def bad_headers(spark, sf_dir):
    """The turns of each conversation as the headers of a table."""
    turns = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    names = F.transform("t", lambda t: t.text)
    flags = O.header_flags(names)
    return turns.select("conv_id", *[F.round(flags[k], 9).alias(k) for k in ("frac_numeric", "frac_unnamed")], flags["key_value"].alias("key_value"), flags["braced"].alias("braced"), O.bad_headers(names, 0.1, 0.5).alias("bad"))


@query(f"SELECT source, round(avg({is_code('text')}::INT), 9) AS frac_code, round(avg({is_pii('text')}::INT), 9) AS frac_pii FROM documents GROUP BY source")
def frac_code_pii(spark, sf_dir):
    return read(spark, sf_dir, "documents").groupBy("source").agg(F.round(P.share(P.contains_code(F.col("text"))), 9).alias("frac_code"), F.round(P.share(P.contains_pii(F.col("text"))), 9).alias("frac_pii"))


_HOLES = "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN '' WHEN event_id % 7 = 2 THEN '  ' ELSE event_type END"


@query(f"SELECT event_type, round(avg({is_null_like('x')}::INT), 9) AS frac_null_like FROM (SELECT event_type, {_HOLES} AS x FROM events) GROUP BY event_type")
def frac_null_like(spark, sf_dir):
    return read(spark, sf_dir, "events").withColumn("x", F.expr(_HOLES)).groupBy("event_type").agg(F.round(P.share(P.null_like(F.col("x"))), 9).alias("frac_null_like"))


_WITH_BAD = "SELECT o_orderkey, o_custkey, o_orderstatus, 'same' AS constant, CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority END AS sparse, o_orderpriority FROM orders"
_COLUMN_SQL = "SELECT '{c}' AS col_name, count(DISTINCT {c}) >= 2 AS enough_unique, round(avg({null}::INT), 9) AS frac_null_like FROM t"


@query(
    f"WITH t AS ({_WITH_BAD}), m AS ("
    + " UNION ALL ".join(_COLUMN_SQL.format(c=c, null=is_null_like(f"{c}::VARCHAR")) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "constant", "sparse", "o_orderpriority"))
    + ") SELECT col_name, enough_unique, frac_null_like, enough_unique AND frac_null_like < 0.1 AS valid FROM m"
)
def valid_columns(spark, sf_dir):
    read(spark, sf_dir, "orders").createOrReplaceTempView("__valid_columns")
    df = spark.sql(_WITH_BAD.replace("FROM orders", "FROM __valid_columns"))
    return column_profile(df).select("col_name", "enough_unique", F.round("frac_null_like", 9).alias("frac_null_like"), (F.col("enough_unique") & (F.col("frac_null_like") < 0.1)).alias("valid"))


@query(f"SELECT {', '.join(sampling.sampled_names(COLUMNS['lineitem'].split(), 5))} FROM lineitem")
def max_columns(spark, sf_dir):
    return O.MaxColumnsFilter(5).apply(read(spark, sf_dir, "lineitem"))


def _accept_sql(t: str) -> str:
    strings, columns = STRINGS[t].split(), COLUMNS[t].split()
    tests = ["count(*) >= 64", str(len(columns) >= 6).lower()]
    tests += [f"avg({is_code(c)}::INT) <= 0.05 AND NOT bool_or({is_pii(c)})" for c in strings]
    valid = [f"(count(DISTINCT {c}) >= 2 AND avg({is_null_like(c) if c in strings else f'({c} IS NULL)'}::INT) < 0.1)::INT" for c in columns]
    return f"SELECT '{t}' AS tbl, coalesce({' AND '.join(tests)} AND ({' + '.join(valid)}) >= 6, false) AS accepted FROM {t}"


@query(" UNION ALL ".join(_accept_sql(t) for t in STRINGS))
def table_accept_v6(spark, sf_dir):
    chain = chains.table_chain(V6)
    return reduce(DataFrame.unionAll, [chain.decided(read(spark, sf_dir, t)).select(F.lit(t).alias("tbl"), "accepted") for t in STRINGS])


# Deduplication

_KEYS = "SELECT doc_id, source AS path, concat('job/', md5(text)) AS key FROM documents"


def _keys(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("path"), F.concat(F.lit("job/"), F.md5(F.col("text").cast("binary"))).alias("key"))


_INDEX = f"SELECT first(key ORDER BY path, key) AS key, min(path) AS path, split_part(key, '/', 2) AS content_hash FROM ({_KEYS}) GROUP BY split_part(key, '/', 2)"


@query(_INDEX)
def dedup_index(spark, sf_dir):
    return dedup.dedup_index(_keys(spark, sf_dir))


@query(f"SELECT DISTINCT k.path, k.key, i.content_hash FROM ({_KEYS}) k JOIN ({_INDEX}) i ON k.path = i.path AND k.key = i.key")
def semi_join_strict(spark, sf_dir):
    keys = _keys(spark, sf_dir)
    return dedup.deduped(keys, dedup.dedup_index(keys)).select("path", "key", "content_hash")


@query(f"SELECT k.doc_id, k.path, k.key, i.content_hash FROM ({_KEYS}) k JOIN ({_INDEX}) i ON k.path = i.path AND k.key = i.key")
def semi_join_parity(spark, sf_dir):
    keys = _keys(spark, sf_dir)
    return dedup.deduped(keys, dedup.dedup_index(keys), strict=False).select("doc_id", "path", "key", "content_hash")


_HALF = "('0x' || " + " || ".join(f"substr(md5(split_part(url, '/', -1)), {{at}} + {2 * i}, 2)" for i in reversed(range(8))) + ")::UBIGINT::VARCHAR"


@query(f"SELECT page_id, split_part(url, '/', -1) AS content_hash, replace(replace(url, '/', '__'), '.parquet', '') AS token, {_HALF.format(at=1)} AS sortkey1, {_HALF.format(at=17)} AS sortkey2 FROM pages")
def content_hashes(spark, sf_dir):
    hash_ = dedup.content_hash(F.col("url"))
    one, two = dedup.sort_keys(hash_)
    return read(spark, sf_dir, "pages").select("page_id", hash_.alias("content_hash"), dedup.path_token(F.col("url")).alias("token"), one.cast("string").alias("sortkey1"), two.cast("string").alias("sortkey2"))


@query("SELECT count(*) - count(DISTINCT (l_orderkey, l_returnflag)) AS duplicate_count, count(*) AS n FROM lineitem")
def duplicate_rows(spark, sf_dir):
    return dedup.duplicate_count(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag"))


@query("SELECT path, row_number() OVER (ORDER BY path) - 1 AS pathnum FROM (SELECT DISTINCT source AS path FROM documents)")
def file_numbers(spark, sf_dir):
    return dedup.file_numbers(_keys(spark, sf_dir)).select("path", F.col("pathnum").cast("long").alias("pathnum"))


@query("SELECT path, floor(place / 7)::BIGINT AS chunk FROM (SELECT path, row_number() OVER (ORDER BY md5(concat(path, ':2974')), path) - 1 AS place FROM (SELECT DISTINCT source AS path FROM documents)) WHERE floor(place / 7) = 1")
def chunk_slice(spark, sf_dir):
    return sampling.chunk_of(shards.shard_paths(_keys(spark, sf_dir)), "path", 7, 1)


@query()
def set_cover(spark, sf_dir):
    """Few users that between them have all event types and days."""
    from tablesift.streaming.runner import shared_folder

    shared_folder(spark)
    events = read(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("file"), F.concat_ws("/", "event_type", F.to_date("ts")).alias("string"))
    return dedup.covering_set(events)


# Summaries


def _generic_sql(x: str, t: str) -> str:
    return f"""SELECT sum(c) - sum(c) FILTER (v IS NOT NULL) AS missing, max(c) FILTER (v IS NOT NULL) AS most, min(c) FILTER (v IS NOT NULL) AS least,
      sum(c) AS n, sum(c) FILTER (v IS NOT NULL) AS m FROM (SELECT {x} AS v, count(*) AS c FROM {t} GROUP BY ALL)"""


def _summary_sql(x: str, t: str, own: str) -> str:
    r = lambda e, name: f"round(({e})::DOUBLE, 6) AS {name}"
    parts = [r("g.missing", "missing"), r("g.missing / g.n", "missing_frac"), r("g.most", "most_frequent_count"), r("g.most / g.m", "most_frequent_frac"), r("g.least", "least_frequent_count"), r("g.least / g.m", "least_frequent_frac"), r("e.entropy", "entropy")]
    return f"SELECT {', '.join(parts)}, o.* FROM ({_generic_sql(x, t)}) g, (SELECT entropy({x}) * ln(2) AS entropy FROM {t}) e, ({own}) o"


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(c).cast("double"), 6).alias(c) for c in df.columns])


@query(
    _summary_sql(
        "l_extendedprice", "lineitem",
        """SELECT round(kurtosis(l_extendedprice), 6) AS kurtosis, round(skewness(l_extendedprice), 6) AS skewness,
      round(avg(abs(l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem))), 6) AS mad, round(stddev_samp(l_extendedprice), 6) AS std FROM lineitem""",
    )
)
def numeric_summary(spark, sf_dir):
    return _rounded(summarize.column_summary(read(spark, sf_dir, "lineitem"), "l_extendedprice"))


@query(
    _summary_sql(
        "text", "documents",
        """SELECT count(DISTINCT text)::DOUBLE AS n_unique, min(length(text))::DOUBLE AS min_length, max(length(text))::DOUBLE AS max_length,
      round(avg(length(text)), 6) AS mean_length, quantile_cont(length(text), 0.5)::DOUBLE AS median_length FROM documents""",
    )
)
def object_summary(spark, sf_dir):
    return _rounded(summarize.column_summary(read(spark, sf_dir, "documents"), "text"))


@query(_summary_sql("quality = 1", "labels", "SELECT round(avg((quality = 1)::INT), 6) AS bool_mean FROM labels"))
def bool_summary(spark, sf_dir):
    return _rounded(summarize.column_summary(read(spark, sf_dir, "labels").select((F.col("quality") == 1).alias("good")), "good"))


_SPAN = "(epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6"


@query(
    _summary_sql(
        "ts", "events",
        f"""SELECT round({_SPAN}, 6) AS time_span_secs, round({_SPAN} / 86400, 6) AS time_span_days, round({_SPAN} / 86400 / 365.25, 6) AS time_span_years,
      round({_SPAN} / (count(ts) - 1), 6) AS timedelta_mean,
      (SELECT (min(d) >= 0 OR max(d) <= 0)::INT::DOUBLE FROM (SELECT epoch_us(ts) - lag(epoch_us(ts)) OVER (ORDER BY event_id) AS d FROM events)) AS is_monotonic FROM events""",
    )
)
def datetime_summary(spark, sf_dir):
    return _rounded(summarize.column_summary(read(spark, sf_dir, "events"), "ts", F.col("event_id")))


@query(f"SELECT source AS col_name, length(source)::DOUBLE AS header_num_chars, (length(source) - length(replace(source, '_', '')))::DOUBLE AS header_num_underscore, len({words.words_sql('source')})::DOUBLE AS header_num_words FROM (SELECT DISTINCT concat(source, '_', lang, '-', doc_id) AS source FROM documents)")
def header_summary(spark, sf_dir):
    names = read(spark, sf_dir, "documents").select(F.concat("source", F.lit("_"), "lang", F.lit("-"), "doc_id").alias("name")).distinct()
    return summarize.header_summary(names, F.col("name"))


@query(
    """SELECT d.dup::DOUBLE AS duplicate_count, d.dup / d.n AS duplicate_frac, 5.0::DOUBLE AS dtype_unique_count, d.n::DOUBLE AS n, 6.0::DOUBLE AS ncols,
    3.0::DOUBLE AS dtype_numeric_count, 0.5::DOUBLE AS dtype_numeric_frac, 0.0::DOUBLE AS dtype_bool_count, 0.0::DOUBLE AS dtype_bool_frac, 2.0::DOUBLE AS dtype_object_count, round(2 / 6, 9) AS dtype_object_frac,
    1.0::DOUBLE AS dtype_datetime_count, round(1 / 6, 9) AS dtype_datetime_frac FROM (SELECT count(*) AS n, count(*) - count(DISTINCT orders) AS dup FROM orders) d""".replace("5.0::DOUBLE AS dtype_unique", "4.0::DOUBLE AS dtype_unique")
)
def table_summary(spark, sf_dir):
    df = summarize.table_summary(read(spark, sf_dir, "orders"))
    return df.select(*[F.round(F.col(c), 9).alias(c) for c in df.columns])


_AGGS = {"min": "min({0})", "max": "max({0})", "mean": "avg({0})", "median": "quantile_cont({0}, 0.5)", **{f"quantile{str(q).replace('.', '_')}": f"quantile_cont({{0}}, {q})" for q in summarize.QUANTILES}}
_PER_COLUMN = " UNION ALL ".join(f"SELECT stddev_samp({c}) AS num_std, skewness({c}) AS num_skewness, entropy({c}) * ln(2) AS num_entropy FROM lineitem" for c in _NUMERICS)


@query(f"SELECT {', '.join(f'round({f.format(k)}, 6) AS {k}_{a}' for k in ('num_std', 'num_skewness', 'num_entropy') for a, f in _AGGS.items())} FROM ({_PER_COLUMN})")
def agg_over_columns(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem")
    columns = summarize.column_statistics(summarize.cells_of(df.select(*_NUMERICS)))
    return _rounded(summarize.over_columns(columns, ["num_std", "num_skewness", "num_entropy"]))


_PAIRS = [(a, b) for i, a in enumerate(_NUMERICS) for b in _NUMERICS[i + 1 :]]


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a, b in _PAIRS))
def pairwise_pearson(spark, sf_dir):
    return summarize.pairwise_pearson(read(spark, sf_dir, "lineitem"), list(_NUMERICS)).withColumn("r", F.round("r", 6))


_BIN = "CASE WHEN {1} > {0} THEN least(floor(({2} - {0}) / ({1} - {0}) * 32), 31) ELSE 0 END"


@query(
    f"""WITH e AS (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1, min(l_extendedprice) AS y0, max(l_extendedprice) AS y1, count(*) AS n FROM lineitem),
    c AS (SELECT {_BIN.format('x0', 'x1', 'l_quantity')} AS i, {_BIN.format('y0', 'y1', 'l_extendedprice')} AS j, count(*) AS c, any_value(n) AS n FROM lineitem, e GROUP BY ALL),
    s AS (SELECT *, sum(c) OVER (PARTITION BY i) AS ci, sum(c) OVER (PARTITION BY j) AS cj FROM c)
    SELECT round(sum(c / n * ln(c * n / (ci * cj))), 6) AS mutual_information FROM s"""
)
def mutual_information(spark, sf_dir):
    return _rounded(summarize.mutual_information(read(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice"))


_BOTH = " UNION ALL ".join(f"SELECT t, '{a}' AS a, '{b}' AS b, d, {a}::DOUBLE AS x, {b}::DOUBLE AS y FROM s" for a, b in _PAIRS)


@query(
    f"""WITH s AS (SELECT * FROM (SELECT l_returnflag AS t, md5(concat(l_returnflag, ':', l_orderkey, '/', l_linenumber, '/', l_partkey, '/', l_suppkey, ':0')) AS d, * FROM lineitem) QUALIFY row_number() OVER (PARTITION BY t ORDER BY d) <= 512),
    p AS (SELECT *, row_number() OVER (PARTITION BY t, a, b ORDER BY d) AS i, count(*) OVER (PARTITION BY t, a, b) AS n, stddev_pop(x) OVER (PARTITION BY t, a, b) AS sx, stddev_pop(y) OVER (PARTITION BY t, a, b) AS sy
      FROM ({_BOTH}) WHERE x IS NOT NULL AND y IS NOT NULL),
    r AS (SELECT u.t, u.a, u.b, u.n, u.i, v.i AS j, floor(abs(u.x - v.x) / CASE WHEN u.sx = 0 THEN 1 ELSE u.sx END * 1e9 + 0.5) AS dx, floor(abs(u.y - v.y) / CASE WHEN u.sy = 0 THEN 1 ELSE u.sy END * 1e9 + 0.5) AS dy
      FROM p u JOIN p v ON u.t = v.t AND u.a = v.a AND u.b = v.b AND u.i <> v.i),
    k AS (SELECT t, a, b, i, min(greatest(dx, dy), 3)[-1] AS radius FROM r GROUP BY t, a, b, i),
    c AS (SELECT t, a, b, i, any_value(n) AS n, count(*) FILTER (dx < radius) AS nx, count(*) FILTER (dy < radius) AS ny FROM r JOIN k USING (t, a, b, i) GROUP BY t, a, b, i),
    h AS (SELECT m, coalesce(sum(1.0::DOUBLE / nullif(m, 0)) OVER (ORDER BY m), 0) AS h FROM (SELECT unnest(range(513)) AS m))
    SELECT t AS table_id, a, b, any_value(n) AS n, round(greatest(0, any_value((SELECT h FROM h WHERE m = n - 1)) + (SELECT h FROM h WHERE m = 2) - avg(hx.h + hy.h)), 6) AS mutual_information
    FROM c JOIN h hx ON hx.m = nx JOIN h hy ON hy.m = ny GROUP BY t, a, b"""
)
def neighbour_information(spark, sf_dir):
    """Line items by their flag as tables: mutual information of all pairs of their numbers."""
    got = information.neighbour_information(read(spark, sf_dir, "lineitem"), list(_NUMERICS), F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), F.col("l_returnflag"))
    return got.withColumn("mutual_information", F.round("mutual_information", 6))


_AT = (0.5, 0.75, 0.8, 0.85, 0.9, 0.95, 0.975, 0.99, 0.999)


@query(" UNION ALL ".join(f"SELECT {q}::DOUBLE AS quantile, round(quantile_cont((n_chars % 1000) / 1000, {q}), 6) AS value FROM documents" for q in _AT))
def score_quantiles(spark, sf_dir):
    scores = read(spark, sf_dir, "documents").select((F.col("n_chars") % 1000 / 1000).alias("score"))
    return summarize.score_quantiles(scores, "score", _AT).withColumn("value", F.round("value", 6))


@query("SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(concat(doc_id, ':42')), doc_id) <= round(count(*) OVER (PARTITION BY quality) * 0.8) AS in_train FROM labels")
def stratified_split(spark, sf_dir):
    return sampling.stratified_split(read(spark, sf_dir, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query("SELECT count(*) AS n, round(avg(quality), 9) AS positive, round(greatest(avg(quality), 1 - avg(quality)), 9) AS majority_accuracy FROM labels")
def majority_accuracy(spark, sf_dir):
    got = summarize.majority_accuracy(read(spark, sf_dir, "labels"), "quality")
    return got.select("n", F.round("positive", 9).alias("positive"), F.round("majority_accuracy", 9).alias("majority_accuracy"))


@query("SELECT source, quality, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM (SELECT source, n_chars, 0 AS quality FROM documents WHERE n_chars < 200 UNION ALL SELECT source, n_chars, 1 FROM documents WHERE n_chars >= 200 AND n_chars < 1000 UNION ALL SELECT source, n_chars, 1 FROM documents WHERE n_chars >= 1000) GROUP BY ALL")
def label_union(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("source", "n_chars")
    n = F.col("n_chars")
    both = shards.labelled(docs.filter(n < 200), [docs.filter((n >= 200) & (n < 1000)), docs.filter(n >= 1000)])
    return both.groupBy("source", "quality").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT doc_id, lang FROM documents WHERE lang = 'en' AND coalesce(text, '') <> ''")
def english_filter(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn("found", KnownLanguage("lang")(F.col("text")))
    return docs.filter(P.is_english(F.col("found"), 0.5)).select("doc_id", "lang")


@query()
def detected_languages(spark, sf_dir):
    """Languages of all documents by a trigram model that is fitted on three quarters of them, counted against what is known, of those and of the rest."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text", (F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) >= "c").alias("held_out"))
    detector = trigram_detector(trigram_model(docs.filter("NOT held_out"), "text", "lang", "doc_id"))
    found = docs.select("doc_id", "held_out", F.col("lang").alias("known"), detector(F.col("text")).alias("found"))
    return found.groupBy("held_out", "known", F.coalesce("found.lang", F.lit("und")).alias("lang")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("found.score"), 6).alias("score"), F.sum(P.is_english(F.col("found")).cast("long")).alias("english"))


# Three quarters of the documents, by a digest of their id, are what the language model is fitted on.
_FITTED = "substr(md5(doc_id::VARCHAR), 1, 1) < 'c'"


def _grams_sql(name: str, rows: str) -> str:
    """Features of texts: doc_id, b and x."""
    one, two, three = language_model.FACTORS
    return f"""{name}_w AS (SELECT doc_id, word, count(*) AS c FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}]+')) AS word FROM ({rows})) WHERE word <> '' GROUP BY ALL),
    {name}_g AS (SELECT doc_id, c, concat(' ', word, ' ') AS p, unnest(range(1, length(word) + 1)) AS i FROM {name}_w),
    {name}_b AS (SELECT doc_id, (unicode(substr(p, i, 1)) * {one} + unicode(substr(p, i + 1, 1)) * {two} + unicode(substr(p, i + 2, 1)) * {three}) % {language_model.BUCKETS} AS b, sum(c) AS c FROM {name}_g GROUP BY ALL),
    {name} AS MATERIALIZED (SELECT doc_id, b, sqrt(c / sum(c) OVER (PARTITION BY doc_id)) AS x FROM {name}_b)"""


def _softmax_sql(name: str, features: str, weights: str) -> str:
    return f"""{name}_z AS (SELECT doc_id, w.lang, sum(x * weight) AS z FROM {features} JOIN {weights} w USING (b) GROUP BY ALL),
    {name}_e AS (SELECT doc_id, lang, exp(z - max(z) OVER (PARTITION BY doc_id)) AS e FROM {name}_z),
    {name} AS MATERIALIZED (SELECT doc_id, lang, e / sum(e) OVER (PARTITION BY doc_id) AS p FROM {name}_e)"""


def _fitted_sql() -> str:
    """The steps of the fit, from documents; the last weights are ``weights``."""
    parts = [_grams_sql("f", f"SELECT doc_id, text FROM documents WHERE lang IS NOT NULL AND {_FITTED}")]
    parts.append("own AS (SELECT DISTINCT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM f))")
    parts.append("langs AS (SELECT lang, 1.0::DOUBLE / (count(*) * (SELECT count(DISTINCT lang) FROM own)) AS share FROM own GROUP BY lang)")
    parts.append("w0 AS (SELECT b, lang, 0.0::DOUBLE AS weight FROM (SELECT DISTINCT b FROM f), langs)")
    for i in range(language_model.STEPS):
        parts.append(_softmax_sql(f"p{i}", "f", f"w{i}"))
        parts.append(
            f"""w{i + 1} AS MATERIALIZED (SELECT f.b, w.lang, any_value(w.weight) + {language_model.RATE} * sum(x * ((o.lang = w.lang)::INT - p) * share) AS weight
            FROM f JOIN own o USING (doc_id) JOIN langs s ON s.lang = o.lang JOIN p{i} USING (doc_id) JOIN w{i} w ON w.b = f.b AND w.lang = p{i}.lang GROUP BY f.b, w.lang)"""
        )
    return ",\n    ".join([*parts, f"weights AS (SELECT * FROM w{language_model.STEPS})"])


_HELD = f"SELECT doc_id, text FROM documents WHERE NOT {_FITTED}"
_HEADERS = f"SELECT doc_id, array_to_string(names, ' ') AS text FROM (SELECT doc_id, list_slice(string_split(text, ' '), 1, 12) AS names FROM documents WHERE NOT {_FITTED})"


def _language_model(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text").withColumn("fitted", F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "c")
    return language_model.fit(docs.filter("fitted"), "text", "lang"), docs.filter("NOT fitted")


@query(f"WITH {_fitted_sql()}, {_grams_sql('t', _HELD)}, {_softmax_sql('found', 't', 'weights')} SELECT doc_id, arg_max(lang, p) AS lang, round(max(p), 6) AS score FROM found GROUP BY doc_id")
def held_out_languages(spark, sf_dir):
    """Languages of the documents that the model isn't fitted on."""
    model, held = _language_model(spark, sf_dir)
    return held.withColumn("found", model(F.col("text"))).select("doc_id", "found.lang", F.round("found.score", 6).alias("score")).filter("lang <> 'und'")


@query(
    f"""WITH {_fitted_sql()}, {_grams_sql('t', _HEADERS)}, {_softmax_sql('found', 't', 'weights')}, names AS (SELECT doc_id, string_split(text, ' ') AS names FROM ({_HEADERS}))
    SELECT doc_id FROM found JOIN names USING (doc_id) WHERE lang = 'en' AND p >= 0.5 AND p = (SELECT max(p) FROM found o WHERE o.doc_id = found.doc_id)
      AND NOT (len(list_filter(names, lambda n: regexp_matches(n, '{P.NUMBER}'))) / len(names) > 0.1 OR len(list_filter(names, lambda n: regexp_matches(n, '{_KV}'))) > 0 OR starts_with(names[1], '{{') AND ends_with(names[len(names)], '}}'))"""
)
def english_tables(spark, sf_dir):
    """Tables with twelve words as headers, by the corpus plan's first decision with its threshold of 0.5: those of other languages go."""
    model, held = _language_model(spark, sf_dir)
    names = F.slice(F.split("text", " "), 1, 12)
    facts = held.select("doc_id", names.alias("names"), F.transform(names, lambda _: F.lit("string")).alias("dtypes"), F.lit(100).alias("nrows"), F.size(names).alias("ncols"), F.lit(None).cast("string").alias("error"))
    own = config("v6", min_cols=None, max_frac_unnamed_colnames=None)
    return corpus.accepted_by_names(facts, own, model).select("doc_id")


@query("SELECT o_orderkey, CASE WHEN o_totalprice IS NOT NULL THEN greatest(least(o_totalprice * 1e10, 1e15), -1e15) END AS clipped FROM orders")
def clipped_values(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", P.clipped(F.col("o_totalprice") * 1e10).alias("clipped"))


@query("SELECT doc_id, md5(text) AS md5, length(text) AS n FROM documents")
def decoded_bytes(spark, sf_dir):
    text = P.decoded(F.encode("text", "UTF-8"))
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(text.cast("binary")).alias("md5"), F.length(text).cast("long").alias("n"))


# Tables as Arrow streams: each conversation is one


def _conversations(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").withColumn("talk", F.concat(F.lit("t"), "turn"))
    return arrow_tables.blobs(turns, "conv_id", ["turn", "talk", "role", "text"], ["turn", "text"])


@query("SELECT conv_id::VARCHAR AS table_id, 4 * count(*) AS n_cells, count(*) AS n_rows, sum(length(text))::BIGINT AS chars FROM conversations GROUP BY conv_id")
def arrow_roundtrip(spark, sf_dir):
    cells = arrow_tables.cells(_conversations(spark, sf_dir))
    return cells.groupBy("table_id").agg(F.count(F.lit(1)).alias("n_cells"), F.count_distinct("row_idx").alias("n_rows"), F.sum(F.when(F.col("col_name") == "text", F.length("value"))).cast("long").alias("chars"))


_SMALL = replace(V6, min_rows=2, min_cols=2, langdetect_threshold=0.0, max_output_rows=3)


class _AnyEnglish:
    def __call__(self, text):
        return F.struct(F.lit("en").alias("lang"), F.lit(1.0).alias("score"))


_TURN_BAD = f"length(text) > 14336 OR length(role) > 14336 OR {has_substring('text')} OR {has_substring('role')} OR {is_code('text')} OR {is_code('role')} OR {is_pii('text')} OR {is_pii('role')}"


_ACCEPTED = f"""t AS (SELECT conv_id, count(*) AS n, count(DISTINCT turn) >= 2 AS v1, count(DISTINCT concat('t', turn)) >= 2 AS v2,
      count(DISTINCT role) >= 2 AND avg({is_null_like('role')}::INT) < 0.1 AS v3, count(DISTINCT text) >= 2 AND avg({is_null_like('text')}::INT) < 0.1 AS v4,
      greatest(avg({is_code('role')}::INT), avg({is_code('text')}::INT)) <= 0.05 AND NOT bool_or({is_pii('role')} OR {is_pii('text')}) AS clean FROM conversations GROUP BY conv_id),
    a AS (SELECT *, v1::INT + v2::INT + v3::INT + v4::INT AS ncols FROM t WHERE n >= 2 AND clean AND v1::INT + v2::INT + v3::INT + v4::INT >= 2)"""
_LEFT_ROWS = f"""SELECT DISTINCT conv_id, CASE WHEN v1 THEN turn END AS turn, CASE WHEN v2 THEN concat('t', turn) END AS talk, CASE WHEN v3 THEN role END AS role, CASE WHEN v4 THEN text END AS text, v1, v2, v3, v4 FROM conversations JOIN a USING (conv_id)
      WHERE NOT (CASE WHEN v3 AND v4 THEN {_TURN_BAD} WHEN v4 THEN {_TURN_BAD.replace('role', "''")} WHEN v3 THEN {_TURN_BAD.replace('text', "''")} ELSE false END)"""


@query(
    f"""WITH {_ACCEPTED}, r AS (SELECT conv_id, count(*) AS n FROM ({_LEFT_ROWS}) GROUP BY conv_id)
    SELECT conv_id::VARCHAR AS content_hash, least(r.n, 3)::BIGINT AS nrows, a.ncols::BIGINT AS ncols FROM r JOIN a USING (conv_id) WHERE r.n >= 2"""
)
def corpus_clean(spark, sf_dir):
    return corpus.cleaned(_conversations(spark, sf_dir), _SMALL, _AnyEnglish()).select("content_hash", "nrows", "ncols")


_WHOLE = "SELECT conv_id, turn, concat('t', turn) AS talk, role, text, true AS v1, true AS v2, true AS v3, true AS v4 FROM conversations"


@query(f"SELECT conv_id, turn, len(w) AS n_words, md5(array_to_string(w, ' ')) AS words FROM (SELECT conv_id, turn, {words.words_sql('text')} AS w FROM conversations) UNION ALL SELECT -1 - item_id, 0, len(w), md5(array_to_string(w, ' ')) FROM (SELECT item_id, {words.words_sql('text')} AS w FROM benchmark)")
def treebank_words(spark, sf_dir):
    """Words of all turns and of all benchmark passages by the Treebank's rules: quotes, marks, contractions, the period at the end."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    both = turns.unionAll(read(spark, sf_dir, "benchmark").select(F.lit(-1) - F.col("item_id"), F.lit(0), "text"))
    found = words.words(F.col("text"))
    return both.select("conv_id", "turn", F.size(found).cast("long").alias("n_words"), F.md5(F.array_join(found, " ").cast("binary")).alias("words"))


def _features_sql(source: str = _WHOLE) -> str:
    """All features of each conversation as a table of turn, talk, role and text, of which v1 to v4 say whether the table has them."""
    cells = {"turn": "turn::VARCHAR", "talk": "talk", "role": "role", "text": "text"}
    unpivoted = " UNION ALL ".join(f"SELECT conv_id, '{c}' AS c, {e} AS v FROM src WHERE v{i + 1}" for i, (c, e) in enumerate(cells.items()))
    stats = {
        "missing": "g.missing", "missing_frac": "g.missing / g.n", "most_frequent_count": "g.most", "most_frequent_frac": "g.most / g.m", "least_frequent_count": "g.least", "least_frequent_frac": "g.least / g.m", "entropy": "g.entropy",
        "kurtosis": "CASE WHEN t.n >= 4 THEN t.kurtosis END", "skewness": "CASE WHEN t.n >= 3 THEN t.skewness END", "mad": "t.mad", "std": "t.std",
        "n_unique": "g.n_unique", "min_length": "o.min_length", "max_length": "o.max_length", "mean_length": "o.mean_length", "median_length": "o.median_length",
        "header_num_chars": "length(g.c)", "header_num_underscore": "0", "header_num_words": "1",
    }
    keys = []
    for key in summarize.column_keys():
        prefix = next((p for p in summarize.OWN if key.startswith(p)), "")
        kind = {"num_": "CASE WHEN g.c = 'turn' THEN {} END", "obj_": "CASE WHEN g.c <> 'turn' THEN {} END", "": "{}"}.get(prefix, "NULL")
        keys.append(f"({kind.format(stats.get(key.removeprefix(prefix), 'NULL'))})::DOUBLE AS {key}")
    features = [f"round({f.format(k)}, 6) AS {k}_{a}" for k in summarize.column_keys() for a, f in _AGGS.items()]
    fixed = {"dtype_unique_count": "(d.numbers > 0)::INT + (d.texts > 0)::INT", "ncols": "d.numbers + d.texts", "dtype_numeric_count": "d.numbers", "dtype_numeric_frac": "round(d.numbers / (d.numbers + d.texts), 6)", "dtype_bool_count": 0, "dtype_bool_frac": 0, "dtype_object_count": "d.texts", "dtype_object_frac": "round(d.texts / (d.numbers + d.texts), 6)", "dtype_datetime_count": 0, "dtype_datetime_frac": 0}
    table = ["d.dup::DOUBLE AS table_duplicate_count", "round(d.dup / d.n, 6) AS table_duplicate_frac", "d.n::DOUBLE AS table_n"] + [f"({v})::DOUBLE AS table_{k}" for k, v in fixed.items()]
    return f"""WITH src AS ({source}),
    u AS ({unpivoted}),
    k AS (SELECT conv_id, c, v, count(*) AS n FROM u GROUP BY ALL),
    g AS (SELECT conv_id, c, coalesce(sum(n) FILTER (v IS NULL), 0) AS missing, coalesce(max(n) FILTER (v IS NOT NULL), 0) AS most, coalesce(min(n) FILTER (v IS NOT NULL), 0) AS least, sum(n) AS n,
      sum(n) FILTER (v IS NOT NULL) AS m, count(v) AS n_unique, ln(sum(n) FILTER (v IS NOT NULL)) - sum(n * ln(n)) FILTER (v IS NOT NULL) / sum(n) FILTER (v IS NOT NULL) AS entropy FROM k GROUP BY conv_id, c),
    o AS (SELECT conv_id, c, min(length(v)) AS min_length, max(length(v)) AS max_length, avg(length(v)) AS mean_length, quantile_cont(length(v), 0.5) AS median_length FROM u GROUP BY conv_id, c),
    t AS (SELECT conv_id, count(turn) AS n, kurtosis(turn) AS kurtosis, skewness(turn) AS skewness, avg(abs(turn - mean)) AS mad, stddev_samp(turn) AS std
      FROM src JOIN (SELECT conv_id, avg(turn) AS mean FROM src WHERE v1 GROUP BY conv_id) USING (conv_id) WHERE v1 GROUP BY conv_id),
    s AS (SELECT g.conv_id, {', '.join(keys)} FROM g JOIN o USING (conv_id, c) LEFT JOIN t USING (conv_id)),
    d AS (SELECT conv_id, count(*) AS n, count(*) - count(DISTINCT (turn, talk, role, text)) AS dup, any_value(v1)::INT AS numbers, any_value(v2)::INT + any_value(v3)::INT + any_value(v4)::INT AS texts FROM src GROUP BY conv_id),
    f AS (SELECT conv_id, {', '.join(features)} FROM s GROUP BY conv_id)
    SELECT f.conv_id::VARCHAR AS table_id, f.* EXCLUDE (conv_id), {', '.join(table)} FROM f JOIN d USING (conv_id)"""


@query(_features_sql())
def cell_features(spark, sf_dir):
    """All 381 features of every table of a corpus, in one plan."""
    tables = _conversations(spark, sf_dir)
    facts = arrow_tables.with_facts(tables).select(F.col("content_hash").alias("table_id"), "dtypes")
    return _round_features(summarize.features_of_tables(arrow_tables.cells(tables), facts))


def _round_features(got):
    return got.select("table_id", *[F.round(c, 6).alias(c) for c in got.columns if c != "table_id"])


#: A small model of the quality of tables, as ``trees.compiled`` makes it of a fitted one.
QUALITY = trees.Boosted(
    (
        (1.0, ("obj_entropy_mean", 1.284033, -1.0, ("obj_entropy_mean", 1.475232, ("obj_mean_length_mean", 172.7916665, -1.0, 1.0), 1.0))),
        (0.1, ("obj_entropy_mean", 1.284033, -0.476812, ("num_std_mean", 1.4, ("obj_mean_length_mean", 150.0, -0.476812, 0.476812), 0.476812))),
        (0.1, ("table_n", 4.5, -0.438194, ("num_kurtosis_mean", -1.2, -0.2, ("obj_max_length_max", 900.5, 0.31, 0.438194)))),
    ),
    {"obj_entropy_mean": 1.32065, "obj_mean_length_mean": 179.58307, "num_std_mean": 1.684563, "num_kurtosis_mean": -1.2, "obj_max_length_max": 1281.5, "table_n": 5.36},
)


def _scored_by(cells):
    return trees.quality_of(QUALITY, lambda own: _round_features(summarize.features_of_tables(own)))(cells)


@query(f"SELECT table_id, round({QUALITY.sql()}, 9) AS score FROM ({_features_sql()})")
def table_scores(spark, sf_dir):
    """The quality of every table of a corpus: features and trees in one plan of expressions."""
    return _scored_by(arrow_tables.cells(_conversations(spark, sf_dir))).withColumn("score", F.round("score", 9))


@query(" UNION ALL ".join(f"SELECT {q}::DOUBLE AS quantile, round(quantile_cont({QUALITY.sql()}, {q}), 6) AS value FROM ({_features_sql()})" for q in (0.5, 0.9, 0.99)))
def table_score_quantiles(spark, sf_dir):
    """Of the scores of all tables: where to put the threshold."""
    scores = _scored_by(arrow_tables.cells(_conversations(spark, sf_dir)))
    return summarize.score_quantiles(scores, "score", (0.5, 0.9, 0.99)).withColumn("value", F.round("value", 6))


@query(
    f"""WITH {_ACCEPTED}, good AS (SELECT table_id FROM ({_features_sql()}) WHERE {QUALITY.sql()} > 0.5), r AS (SELECT conv_id, count(*) AS n FROM ({_LEFT_ROWS}) GROUP BY conv_id)
    SELECT conv_id::VARCHAR AS content_hash, r.n::BIGINT AS nrows, a.ncols::BIGINT AS ncols FROM r JOIN a USING (conv_id) WHERE r.n >= 2 AND conv_id::VARCHAR IN (SELECT table_id FROM good)"""
)
def corpus_quality_before(spark, sf_dir):
    """As version 7: tables of good quality, as they come, are cleaned."""
    own = replace(_SMALL, max_output_rows=None, table_quality_threshold=0.5, table_quality_position="pre")
    return corpus.cleaned(_conversations(spark, sf_dir), own, _AnyEnglish(), _scored_by).select("content_hash", "nrows", "ncols")


@query(
    f"""WITH {_ACCEPTED}, r AS (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n FROM ({_LEFT_ROWS})), kept AS (SELECT * FROM r WHERE n >= 2),
    good AS (SELECT table_id FROM ({_features_sql("SELECT conv_id, turn, talk, role, text, v1, v2, v3, v4 FROM kept")}) WHERE {QUALITY.sql()} > 0.5)
    SELECT DISTINCT conv_id::VARCHAR AS content_hash, kept.n::BIGINT AS nrows, a.ncols::BIGINT AS ncols FROM kept JOIN a USING (conv_id) WHERE conv_id::VARCHAR IN (SELECT table_id FROM good)"""
)
def corpus_quality_after(spark, sf_dir):
    """As version 8: of the cleaned tables those of good quality, by what is left of them."""
    own = replace(_SMALL, max_output_rows=None, table_quality_threshold=0.5, table_quality_position="post")
    return corpus.cleaned(_conversations(spark, sf_dir), own, _AnyEnglish(), _scored_by).select("content_hash", "nrows", "ncols")


_NAMES = {"turn": "number", "talk": "code", "role": "type", "text": "status"}


@query(f"SELECT content_hash AS table_id, nrows AS rows, NULL::VARCHAR AS error FROM ({ORACLE_SQL['corpus_clean']})")
def corpus_run(spark, sf_dir):
    """From shards to the manifest: conversations as tables in shards, each twice, and one broken; dedup index, cleaning, a file for each table."""
    import uuid

    from tablesift.streaming.runner import shared_folder

    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    turns = read(spark, sf_dir, "conversations").withColumn("talk", F.concat(F.lit("t"), "turn")).withColumnsRenamed(_NAMES)
    tables = arrow_tables.blobs(turns, "conv_id", list(_NAMES.values()), ["number", "status"])
    rows = tables.select(F.explode(F.array(*[F.concat(F.lit(job), "content_hash") for job in ("a/", "b/")])).alias("key"), "arrow_bytes", F.pmod(F.crc32("content_hash"), F.lit(4)).alias("part"))
    broken = spark.range(1).select(F.lit("a/broken").alias("key"), F.lit(b"no table").alias("arrow_bytes"), F.lit(0).cast("long").alias("part"))
    rows.unionByName(broken).write.partitionBy("part").parquet(f"{folder}/shards")
    corpus.dedup(spark, f"{folder}/shards", f"{folder}/index")
    manifest = corpus.process(spark, f"{folder}/shards", f"{folder}/index", f"{folder}/tables", _SMALL, shared_mount=True)
    return manifest.select("table_id", "rows", "error")


@query(f"SELECT content_hash AS table_id, nrows AS rows, false AS broken FROM ({ORACLE_SQL['corpus_clean']}) UNION ALL SELECT concat('broken', i), -1, true FROM range(3) t(i)")
def corpus_chunks(spark, sf_dir):
    """The same in three chunks of files, with a broken table in each: the run breaks off after the second and is begun again, and no table is missing or there twice."""
    import uuid

    from tablesift.streaming.runner import shared_folder

    folder = f"{shared_folder(spark)}/chunks-{uuid.uuid4().hex}"
    turns = read(spark, sf_dir, "conversations").withColumn("talk", F.concat(F.lit("t"), "turn")).withColumnsRenamed(_NAMES)
    tables = arrow_tables.blobs(turns, "conv_id", list(_NAMES.values()), ["number", "status"])
    broken = spark.range(3).select(F.concat(F.lit("broken"), "id").alias("content_hash"), F.lit(b"no table").alias("arrow_bytes"), F.col("id").alias("part"))
    rows = tables.withColumn("part", F.pmod(F.crc32("content_hash"), F.lit(3))).unionByName(broken).select(F.concat(F.lit("a/"), "content_hash").alias("key"), "arrow_bytes", "part")
    rows.repartition(3, "part").write.partitionBy("part").parquet(f"{folder}/shards")
    corpus.dedup(spark, f"{folder}/shards", f"{folder}/index")
    whole = dict(directory=f"{folder}/shards", index=f"{folder}/index", out=f"{folder}/tables", config=_SMALL, chunk_size=1, shared_mount=True)
    corpus.process_chunks(spark, **whole, only=[0, 1])
    manifest = corpus.process_chunks(spark, **whole)
    return manifest.select("table_id", F.coalesce("rows", F.lit(-1).cast("long")).alias("rows"), F.col("error").isNotNull().alias("broken"))


@query()
def quality_model(spark, sf_dir):
    """A quality model of documents: fit on a split of the labels, evaluated on the rest."""
    docs = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality")), "doc_id")
    words = F.size(F.split("text", r"\s+"))
    features = docs.select(
        F.col("doc_id").cast("string").alias("table_id"), "quality", F.length("text").cast("double").alias("chars"), words.cast("double").alias("words"),
        (F.size(F.array_distinct(F.split("text", r"\s+"))) / words).alias("distinct_words"), (F.regexp_count("text", F.lit(r"[^\p{L}\s]")) / F.greatest(F.length("text"), F.lit(1))).alias("other_chars"),
        (F.length(F.regexp_replace("text", r"[^\p{Lu}]", "")) / F.greatest(F.length("text"), F.lit(1))).alias("upper"),
    )
    names = ["chars", "words", "distinct_words", "other_chars", "upper"]
    model, result = quality.train(features, names)
    top = quality.importances(model, names)
    return result.withColumn("top_feature", F.lit(top[0][0]))


# Streams


@query(ORACLE_SQL["code_rows"])
def stream_code_rows(spark, sf_dir):
    """The row filter on a stream of files, run until it has read what is there."""
    from tablesift.streaming.runner import run_once

    schema = read(spark, sf_dir, "documents").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parquet*")
    return run_once(streams.filtered(stream, O.RowFilterChain([O.CodeRegexFilter()])).select("doc_id", "lang", "n_chars"))


@query(f"SELECT time_bucket(INTERVAL 1 DAY, ts)::VARCHAR AS day, count(*) AS n, round(avg({is_code('props')}::INT), 9) AS frac_code, round(avg({is_pii('props')}::INT), 9) AS frac_pii FROM events WHERE time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY ALL")
def stream_shares(spark, sf_dir):
    """Shares per day of event time; days that the watermark has passed."""
    from tablesift.streaming.runner import run_once

    schema = read(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    got = run_once(streams.shares(stream, "props", "ts", "1 day", "1 hour").select("window.start", "n", "frac_code", "frac_pii"))
    return got.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("day"), "n", F.round("frac_code", 9).alias("frac_code"), F.round("frac_pii", 9).alias("frac_pii"))



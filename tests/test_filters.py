"""Filters and chains on small tables."""

import pytest
from pyspark.sql import functions as F

from tablesift.functions.language import FrequentWords
from tablesift.operators import filters as O
from tablesift.operators.profile import column_profile, table_profile
from tablesift.plans import chains
from tablesift.plans.config import VERSIONS, Config, config


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture()
def numbers(spark):
    return frame(spark, [(1, 199, 3, 199, "A"), (2, 5, 4, 199, "B"), (3, 6, 5, 399, "C")], "x long, `1.456` long, `-3.14` long, `0000` long, category string")


def values(df, column="x"):
    return sorted(r[0] for r in df.select(column).collect())


def test_length_is_strict(spark):
    df = frame(spark, [(1, "A" * 10), (2, "B")], "x long, y string")
    assert values(O.MaxValueLengthFilter(10).apply(df)) == [1, 2]
    assert values(O.MaxValueLengthFilter(9).apply(df)) == [2]


def test_substrings_in_all_cells(spark):
    df = frame(spark, [(123, "keep_me"), (4, "exclude_me"), (5, None)], "x long, y string")
    assert values(O.SubstringFilter(["exclude_me"]).apply(df)) == [5, 123]
    assert values(O.SubstringFilter(["12"]).apply(df)) == [4, 5]
    assert values(O.SubstringFilter(["12"], string_columns_only=True).apply(df)) == [4, 5, 123]
    with pytest.raises(ValueError):
        O.SubstringFilter("12")


def test_code_pii_and_duplicates(spark):
    df = frame(spark, [(1, "# x"), (2, "plain"), (3, "me@mail.org"), (4, None), (4, None)], "x long, y string")
    assert values(O.CodeRegexFilter().apply(df)) == [2, 3, 4, 4]
    assert values(O.PIIRegexFilter().apply(df)) == [1, 2, 4, 4]
    assert values(O.DuplicateRowsFilter().apply(df)) == [1, 2, 3, 4]


def test_samples_are_exact_and_repeatable(spark):
    df = spark.range(100).select(F.col("id").alias("x"))
    one, two = values(O.MaxRowCountFilter(10).apply(df)), values(O.MaxRowCountFilter(10).apply(df.repartition(7)))
    assert len(one) == 10 and one == two
    assert values(O.MaxRowCountFilter(200).apply(df)) == list(range(100))
    assert values(O.MaxRowCountFilter(0).apply(df)) == []


def test_row_chain(spark):
    rows = [("a", 1, 1, "#"), ("b", 2, 2, "ok"), ("c", 3, 3, "a@b.org"), ("b", 2, 2, "ok"), ("###", 4, 4, "ok"), ("x" * 30, 5, 5, "ok")]
    df = frame(spark, rows, "w string, x long, y long, z string")
    chain = O.RowFilterChain([O.MaxValueLengthFilter(20), O.SubstringFilter(["###"]), O.CodeRegexFilter(), O.PIIRegexFilter(), O.DuplicateRowsFilter()])
    assert values(chain.apply(df)) == [2]
    assert chain.apply(df.filter("x = 1")).count() == 0
    with pytest.raises(TypeError):
        chain.append("filter")


def test_columns(numbers):
    assert O.InvalidColumnsFilter(8, 2).apply(numbers).columns == ["x", "1.456", "-3.14", "0000"]
    assert O.InvalidColumnsFilter(9, 2).apply(numbers).columns == numbers.columns
    assert O.InvalidColumnsFilter(9, 3).apply(numbers).columns == ["x", "1.456", "-3.14", "category"]
    missing = numbers.withColumn("category", F.lit(None).cast("double"))
    assert O.ColumnFilterChain([O.InvalidColumnsFilter(9, 2, 0.5)]).apply(missing).columns == numbers.columns[:4]
    few = O.MaxColumnsFilter(2).apply(numbers).columns
    assert len(few) == 2 and few == O.MaxColumnsFilter(2).apply(numbers).columns and set(few) < set(numbers.columns)


def test_profile_treats_nan_as_null(spark):
    df = frame(spark, [(float("nan"), ""), (1.0, "x"), (2.0, " "), (None, None)], "a double, b string")
    got = {r.col_name: r for r in column_profile(df).collect()}
    assert got["a"].frac_null_like == 0.5 and got["a"].enough_unique and not got["a"].string_like
    assert got["b"].frac_null_like == 0.75 and got["b"].enough_unique


def test_table_filters(numbers):
    accepts = lambda *f: O.TableFilterChain(f).accepts(numbers)
    assert accepts(O.RowCountFilter(3), O.RowCountFilter(1, 3)) and not accepts(O.RowCountFilter(4)) and not accepts(O.RowCountFilter(1, 2))
    assert accepts(O.ColumnCountFilter(5)) and not accepts(O.ColumnCountFilter(6)) and not accepts(O.ColumnCountFilter(1, 4))
    assert accepts(O.BadHeadersFilter()) and accepts(O.BadHeadersFilter(0.6)) and not accepts(O.BadHeadersFilter(0.5))
    assert accepts(O.SchemaFilter(2)) and not accepts(O.SchemaFilter(3)) and accepts(O.SchemaFilter(None))
    assert accepts(O.ValidColumnCountFilter(9, 2, None, 5)) and not accepts(O.ValidColumnCountFilter(8, 2, None, 5))
    assert accepts(O.CodeDetectionFilter(0.1), O.PIIDetectionFilter(0.1))
    assert not O.TableFilterChain([]).accepts(None)


def test_header_shapes(spark):
    bad = lambda names, **k: not O.TableFilterChain([O.BadHeadersFilter(**k)]).accepts(frame(spark, [tuple(1 for _ in names)], ", ".join(f"`{n}` int" for n in names)))
    assert bad(["{a", "b}"]) and bad(['"k": "v"', "x"]) and not bad(["a", "b"])
    assert bad(["Unnamed: 0", "Unnamed: 1", "x"], max_frac_unnamed=0.5) and not bad(["Unnamed: 0", "x"], max_frac_unnamed=0.5)


def test_code_and_pii_thresholds(spark):
    df = frame(spark, [("#", "x@y.org"), ("a", "b"), ("c", "d"), ("e", "f")], "a string, b string")
    accepts = lambda f: O.TableFilterChain([f]).accepts(df)
    assert accepts(O.CodeDetectionFilter(0.25)) and not accepts(O.CodeDetectionFilter(0.2)) and accepts(O.CodeDetectionFilter())
    assert not accepts(O.PIIDetectionFilter(0.5)) and accepts(O.PIIDetectionFilter(0.5, strict=True)) and accepts(O.PIIDetectionFilter())


def test_quality_and_language_filters(spark):
    df = frame(spark, [(1, 2)], "`name of city` int, total int")
    score = lambda s: O.TableQualityFilter(lambda d: d, lambda d: d.limit(1).select(F.lit(s).alias("score")), 0.5)
    assert O.TableFilterChain([score(0.6)]).accepts(df) and not O.TableFilterChain([score(0.5)]).accepts(df)
    assert O.TableFilterChain([O.EnglishFilter(FrequentWords())]).accepts(df)


def test_table_profile(numbers):
    row = table_profile(numbers).first()
    assert (row.nrows, row.ncols, row.headers) == (3, 5, "x 1.456 -3.14 0000 category")
    assert {(d.dtype, d.n) for d in row.dtype_counts} == {("bigint", 4), ("string", 1)}


def test_configs(tmp_path):
    assert len(VERSIONS) == 15 and config("v6").min_rows == 64
    assert config("v8.1").table_quality_threshold == 0.01 and config("v6", min_cols=3).min_cols == 3
    path = tmp_path / "c.json"
    assert config("v5").to_json(str(path)) == path.read_text()
    with pytest.raises(ValueError):
        config("v1")
    with pytest.raises(ValueError):
        Config(pii_detect_threshold=2.0)
    with pytest.raises(ValueError):
        chains.table_chain(config("v7"))
    assert len(chains.post_chain(config("v9.3")).filters) == 1


def test_process_table(spark):
    df = spark.range(100).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(6)], F.lit("same").alias("constant"))
    out = chains.process_table(df, config("v6", max_output_rows=70))
    assert out.count() == 70 and out.columns == [f"c{i}" for i in range(6)]
    assert chains.process_table(df.limit(10), config("v6")) is None


def test_accepted_tables(spark):
    # At this scale factor and above: the tables with six columns of which none counts as code.
    sf_dir = "/root/testdata/sf0.01"
    names = [t for t in ("events", "lineitem", "orders", "part", "customer") if chains.table_chain(config("v6")).accepts(spark.read.parquet(f"{sf_dir}/{t}.parquet"))]
    assert names == ["events", "lineitem", "orders"]

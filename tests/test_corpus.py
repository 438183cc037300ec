"""Deduplication, shards, blobs, the corpus pipeline, sinks, the quality model, streams and the command line."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablesift import cli
from tablesift.operators import dedup, quality, sampling, summarize
from tablesift.operators.filters import CodeRegexFilter, DuplicateRowsFilter, RowFilterChain
from tablesift.plans import corpus
from tablesift.plans.config import config
from tablesift.sources import arrow_tables, shards, sinks
from tablesift.streaming import filters as streams
from tablesift.streaming.runner import run_once


def blob(**columns):
    return arrow_tables.encoded(pa.table(columns))


def good(n=80, extra=None):
    table = {"name": [f"n{i}" for i in range(n)], "date": list(range(n)), "city": [f"c{i % 7}" for i in range(n)], "price": [i / 2 for i in range(n)], "total": [i * 3 for i in range(n)], "year": [2000 + i % 9 for i in range(n)]}
    return blob(**(table | (extra or {})))


@pytest.fixture()
def shard_dir(spark, tmp_path):
    rows = {
        "a/one.parquet": [("job/h1", good()), ("job/h2", b"broken"), ("job/h3", good(10))],
        "b/two.parquet": [("other/h1", good()), ("job/h4", good(extra={"note": ["#"] * 80})), ("job/h5", good(90, {"same": [1] * 90, "mail": ["x"] * 89 + ["a@b.org"]})), ("job/h6", good(90, {"same": [1] * 90}))],
        "b/x_two.parquet": [("job/h6", good(90)), ("job/h7", None)],
    }
    import pyarrow.parquet as pq

    for path, own in rows.items():
        os.makedirs(tmp_path / "in" / os.path.dirname(path), exist_ok=True)
        pq.write_table(pa.table({"key": [k for k, _ in own], "arrow_bytes": pa.array([b for _, b in own], pa.binary()), "bucket": ["x"] * len(own)}), tmp_path / "in" / path)
    return str(tmp_path / "in")


def test_corpus_pipeline(spark, shard_dir, tmp_path):
    index = corpus.dedup(spark, shard_dir, str(tmp_path / "index"))
    got = {r.content_hash: r for r in index.collect()}
    assert sorted(got) == [f"h{i}" for i in range(1, 8)]
    assert got["h1"].path.endswith("a/one.parquet") and got["h6"].path.endswith("b/two.parquet")
    manifest = corpus.process(spark, shard_dir, str(tmp_path / "index"), str(tmp_path / "out"), config("v6", max_output_rows=70)).collect()
    assert {(r.table_id, r.rows, r.error) for r in manifest} == {("h1", 70, None), ("h6", 70, None)}
    table = pa.parquet.read_table(tmp_path / "out" / "h6.parquet")
    assert table.column_names == ["name", "date", "city", "price", "total", "year"] and table.schema.field("price").type == pa.float64()
    chunk = corpus.process(spark, shard_dir, str(tmp_path / "index"), str(tmp_path / "out"), config("v6"), chunk=0, chunk_size=1, file_format="csv").collect()
    assert all(r.path.endswith(".csv") and "/chunk-0000/" in r.path for r in chunk)


def test_head_of_shards(spark, shard_dir, tmp_path):
    index = corpus.dedup(spark, shard_dir, str(tmp_path / "index"), max_shards=1)
    assert index.count() == 3


def test_quality_in_the_pipeline(spark, shard_dir):
    tables = shards.read_shards(spark, shard_dir).select(dedup.content_hash(F.col("key")).alias("content_hash"), "arrow_bytes").dropDuplicates(["content_hash"])
    score = lambda cells: cells.select("table_id").distinct().withColumn("score", (F.col("table_id") == "h6").cast("double"))
    for version in ("v8", "v7"):
        assert [r.content_hash for r in corpus.cleaned(tables, config(version), quality=score).collect()] == ["h6"]
    with pytest.raises(ValueError):
        corpus.cleaned(tables, config("v7"))


def test_facts_and_cells(spark):
    df = spark.createDataFrame([("a", bytearray(blob(x=[1, None], y=["u", None]))), ("b", bytearray(b"no")), ("c", None)], "content_hash string, arrow_bytes binary")
    facts = {r.content_hash: r for r in arrow_tables.with_facts(df).collect()}
    assert (facts["a"].nrows, facts["a"].ncols, facts["a"].names, facts["a"].error) == (2, 2, ["x", "y"], None)
    assert facts["b"].nrows is None and facts["b"].error and facts["c"].error == "no bytes"
    assert sorted((r.row_idx, r.col_name, r.kind, r.value) for r in arrow_tables.cells(df).collect() if r.value) == [(0, "x", "numeric", "1"), (0, "y", "object", "u")]


def test_dedup_ties(spark):
    df = spark.createDataFrame([("b/h", "p2"), ("a/h", "p2"), ("c/h", "p3"), ("x/k", "p1"), ("x/k", "p1")], "key string, path string")
    index = dedup.dedup_index(df)
    assert sorted(map(tuple, index.collect())) == [("a/h", "p2", "h"), ("x/k", "p1", "k")]
    assert dedup.deduped(df, index).count() == 2 and dedup.deduped(df, index, strict=False).count() == 3


@pytest.mark.parametrize("pairs,files", [([], 0), ([("f", "s")], 1), ([("f", "a"), ("g", "a"), ("g", "b")], 1), ([("f", "a"), ("f", "b"), ("g", "b"), ("g", "c"), ("h", "c")], 2)])
def test_set_cover(spark, pairs, files):
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    got = dedup.covering_set(spark.createDataFrame(pairs, "file string, string string")).collect()
    assert len({r.file for r in got}) == files and sorted(r.string for r in got) == sorted({s for _, s in pairs})


def test_set_cover_is_the_greedy_one(spark):
    import random

    rng = random.Random(3)
    pairs = {(f"f{rng.randrange(30):02}", f"s{rng.randrange(60)}") for _ in range(220)}
    left, want = set(pairs), {}
    while left:
        count = {f: sum(g == f for g, _ in left) for f, _ in left}
        best = min(count, key=lambda f: (-count[f], f))
        want |= {s: best for f, s in left if f == best}
        left = {(f, s) for f, s in left if s not in want}
    spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    got = dedup.covering_set(spark.createDataFrame(sorted(pairs), "file string, string string")).collect()
    assert {r.string: r.file for r in got} == want and len(got) == len(want)


def test_unknown_extension(spark):
    with pytest.raises(ValueError):
        shards.read_file(spark, "x.json")


def test_side_cars(spark, tmp_path):
    for folder, features in (("a", [("x", True), ("y", False)]), ("b", [("x", False), ("y", True)])):
        os.makedirs(tmp_path / folder)
        (tmp_path / folder / "t.csv").write_text("x,y\n1,2\n")
        (tmp_path / folder / "f.jsonl").write_text("\n".join(json.dumps({"name": n, "is_target": t}) for n, t in features))
    os.makedirs(tmp_path / "c")
    (tmp_path / "c" / "variables1.csv").write_text("q\n")
    (tmp_path / "c" / "f.jsonl").write_text("{}")
    got = shards.feature_lists(spark, str(tmp_path)).collect()
    assert sorted(r.target for r in got) == ["x", "y"]
    assert shards.read_file(spark, f"{tmp_path}/a/t.csv").columns == ["x", "y"]
    (tmp_path / "a" / "f.jsonl").write_text('{"name": "x", "is_target": false}')
    with pytest.raises(Exception, match="not exactly one target"):
        shards.feature_lists(spark, str(tmp_path)).collect()
    stats = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "col_name string, s double")
    features = spark.createDataFrame([("x", True), ("y", False)], "name string, is_target boolean")
    assert {(r.col_name, r.is_target) for r in shards.label_targets(stats, features).collect()} == {("x", True), ("y", False)}


def test_summaries(spark):
    import pandas as pd

    pdf = pd.DataFrame({"a": [1.0, 2.0, 2.0, 5.0, None, 9.0], "s": ["x", "yy", "x", None, "zzz", "x"]})
    df = spark.createDataFrame([(None if a != a else a, s) for a, s in zip(pdf.a, pdf.s)], "a double, s string")
    row = summarize.column_summary(df, "a").first()
    assert row.skewness == pytest.approx(pdf.a.skew()) and row.kurtosis == pytest.approx(pdf.a.kurt()) and row["std"] == pytest.approx(pdf.a.std())
    assert row.missing == 1 and row.most_frequent_count == 2 and row.mad == pytest.approx((pdf.a - pdf.a.mean()).abs().mean())
    row = summarize.column_summary(df, "s").first()
    assert row.n_unique == 3 and row.max_length == 4 and row.median_length == 1.5
    constant = summarize.column_summary(spark.createDataFrame([(3.0,)] * 5, "a double"), "a").first()
    assert constant.skewness == 0 and constant.kurtosis == 0 and constant.entropy == 0
    empty = summarize.column_summary(df.filter("false"), "s").collect()
    assert len(empty) <= 1
    features = summarize.table_features(df)
    assert len(features.columns) == len(summarize.feature_names()) == 381
    first = features.first()
    assert first.table_n == 6 and first.num_std_max == pytest.approx(pdf.a.std())
    assert summarize.public_name("num_std_quantile0_1") == "num_std_quantile0.1"


def test_pearson_with_nulls(spark):
    import numpy as np
    import pandas as pd

    x = np.random.default_rng(1).normal(1e6, 1, (400, 4))
    x[:, 1] += x[:, 0]
    x[np.random.default_rng(2).random(x.shape) < 0.1] = np.nan
    want = pd.DataFrame(x, columns=list("abcd")).corr()
    df = spark.createDataFrame([tuple(None if v != v else float(v) for v in r) + (1.0,) for r in x], "a double, b double, c double, d double, e double").repartition(5)
    got = {(r.a, r.b): r.r for r in summarize.pairwise_pearson(df, list("abcde")).collect()}
    assert len(got) == 10 and all(r is None if "e" in k else abs(r - want.loc[k]) < 1e-9 for k, r in got.items())
    assert summarize.pairwise_pearson(df.filter("false"), ["a", "b"]).count() <= 1
    twice = summarize.over_columns(spark.createDataFrame([("t", 1.0), ("t", 3.0)], "table_id string, s double"), ["s"], ["table_id"], {"sum": F.sum}).first()
    assert twice.s_sum == 4.0


def test_monotonic_dates(spark):
    df = spark.range(50).select(F.col("id"), F.timestamp_seconds(F.col("id") * 60).alias("t"), F.timestamp_seconds(F.col("id") % 7).alias("u"))
    assert summarize.column_summary(df, "t", F.col("id")).first().is_monotonic == 1.0
    assert summarize.column_summary(df, "u", F.col("id")).first().is_monotonic == 0.0
    assert summarize.column_summary(df.limit(1), "t", F.col("id")).first().time_span_secs == 0.0


def test_model_round_trip(spark, tmp_path):
    df = spark.range(300).select(F.col("id").cast("string").alias("table_id"), (F.col("id") % 10).cast("double").alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") * 1.0).alias("b"), (F.col("id") % 10 > 4).cast("int").alias("quality"))
    model, result = quality.train(df, ["a", "b"])
    assert result.first().accuracy > 0.95 and quality.importances(model, ["a", "b"])[0][0] == "a"
    again = quality.load(quality.save(model, str(tmp_path)))
    one, two = (quality.scored(df, m, ["a", "b"]).orderBy("table_id").select("score").collect() for m in (model, again))
    assert one == two


def test_split_is_exact(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    got = {(r.y, r.in_train): r["count"] for r in sampling.stratified_split(df, "y", "id").groupBy("y", "in_train").count().collect()}
    assert got == {(0, True): 720, (0, False): 180, (1, True): 80, (1, False): 20}


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(f"j/h{i % 3}", f"2024-01-01 00:0{i}:00", "#" if i == 2 else "x") for i in range(6)], "key string, t string, text string").withColumn("t", F.to_timestamp("t"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    assert run_once(streams.filtered(stream(), RowFilterChain([CodeRegexFilter()]))).count() == 5
    assert run_once(streams.deduped(stream(), "t", "1 hour")).count() == 3
    with pytest.raises(ValueError):
        streams.filtered(stream(), RowFilterChain([DuplicateRowsFilter()]))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", bytearray(blob(x=[1]))), ("b", None), ("c", bytearray(b"no"))], "content_hash string, arrow_bytes binary")
    got = {r.table_id: r for r in sinks.write_tables(df, str(tmp_path / "o")).collect()}
    assert got["a"].rows == 1 and "b" not in got and got["c"].error and os.listdir(tmp_path / "o") == ["a.parquet"]
    with pytest.raises(ValueError):
        sinks.write_tables(df, "x", "json")
    sinks.write_run(str(tmp_path / "r.json"), a=1)
    assert json.loads((tmp_path / "r.json").read_text()) == {"a": 1}


def test_command_line(spark, shard_dir, tmp_path, capsys):
    cli.main(["config", "v6"])
    assert json.loads(capsys.readouterr().out)["min_rows"] == 64
    cli.main(["dedup", shard_dir, str(tmp_path / "i")])
    cli.main(["process", shard_dir, str(tmp_path / "i"), str(tmp_path / "o")])
    assert spark.read.parquet(f"{tmp_path}/o-manifest").count() == 2


def test_features_and_models_by_command(spark, shard_dir, tmp_path):
    cli.main(["features", shard_dir, str(tmp_path / "f")])
    features = spark.read.parquet(str(tmp_path / "f"))
    assert len(features.columns) == 382 and {r.table_id for r in features.collect()} == {"h1", "h3", "h4", "h5", "h6"}
    assert features.filter("table_id = 'h1'").first().table_n == 80
    rows = spark.range(200).select(F.col("id").cast("string").alias("table_id"), (F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"))
    rows.filter("a <= 4").write.parquet(str(tmp_path / "low"))
    rows.filter("a > 4").write.parquet(str(tmp_path / "high"))
    cli.main(["train", str(tmp_path / "m"), "--low", str(tmp_path / "low"), "--high", str(tmp_path / "high"), "--names", "a", "b"])
    run = json.loads((tmp_path / "m" / "run.json").read_text())
    assert run["accuracy"] > 0.95 and run["importances"][0][0] == "a"
    report = spark.read.option("header", "true").csv(str(tmp_path / "m" / "report")).collect()
    assert {r["class"] for r in report} == {"0", "1"} and all(float(r.f1) > 0.9 for r in report)
    cli.main(["quantiles", str(tmp_path / "high"), run["model"], str(tmp_path / "q"), "--names", "a", "b"])
    assert spark.read.option("header", "true").csv(str(tmp_path / "q")).count() == 9


def test_quantiles_are_exact(spark):
    import numpy as np

    values = np.round(np.random.default_rng(4).beta(0.3, 2, 3000), 3)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "s double")
    for bins in (3, 1000):
        for r in summarize.score_quantiles(df, "s", bins=bins).collect():
            assert abs(r["value"] - np.quantile(values, r["quantile"])) < 1e-9


def test_decisions_are_those_of_the_filters(spark):
    from tablesift.plans import chains

    chain = chains.table_chain(config("v6", min_rows=3, min_cols=2))
    rows = [("ab", "x", 1), ("cd", "y", 2), ("ef", "z", 3)]
    tables = [rows, rows[:2], [("a#", "x", 1), *rows[1:]], [("a@b.org", "x", 1), *rows], [("same", "x", 1)] * 3]
    for own in tables:
        df = spark.createDataFrame(own, "name string, city string, year int")
        assert chain.decided(df).first().accepted == chain.accepts(df)
    odd = spark.createDataFrame([("a", "b", 1)] * 4, "`1` string, `2` string, year int")
    assert chain.decided(odd).first().accepted is False is chain.accepts(odd)


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

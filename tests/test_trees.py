"""Trees as expressions and SQL against the fitted model, and as a filter in the corpus pipelines."""

import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_corpus import blob

from tablesift.operators import quality, summarize, trees
from tablesift.plans import corpus
from tablesift.plans.config import config
from tablesift.sources import arrow_tables

NAMES = ["a", "b.c", "empty"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    odd = [None, float("nan"), float("inf"), float("-inf"), 1e300]
    rows = [(str(i), rng.choice([*odd, *[rng.uniform(-3, 3)] * 12]), rng.choice([*odd, *[float(rng.randint(0, 4))] * 12]), None) for i in range(400)]
    rows = [(*r, int((r[1] or 0) == (r[1] or 0) and (r[1] or 0) > 0.5 or r[2] == 3.0)) for r in rows]
    return spark.createDataFrame(rows, "table_id string, a double, `b.c` double, empty double, quality int").withColumnRenamed("b.c", "b")


@pytest.mark.parametrize("trials", [1, 4])
def test_expression_and_sql_are_the_model(spark, data, tmp_path, trials):
    names = ["a", "b", "empty"]
    model = quality.fit(data, names, trials=trials, max_iter=6)
    own = trees.compiled(model, names)
    want = {r.table_id: r.score for r in quality.scored(data, model, names).collect()}
    got = {r.table_id: r.score for r in data.select("table_id", own.score().alias("score")).collect()}
    assert want.keys() == got.keys() and all(abs(want[k] - got[k]) < 1e-12 for k in want)
    t = pa.table({c: pa.array([r[c] for r in data.collect()], pa.string() if c == "table_id" else pa.float64()) for c in ("table_id", *names)})
    rows = duckdb.sql(f"SELECT table_id, {own.sql()} FROM t").fetchall()
    assert len(t) == len(rows) and all(abs(want[k] - v) < 1e-12 for k, v in rows)
    trees.save(own, spark, f"{tmp_path}/model")
    assert trees.load(spark, f"{tmp_path}/model") == own and "empty" not in own.features()


def test_only_what_trees_ask_for_is_read(spark, data, tmp_path):
    data.write.parquet(f"{tmp_path}/features")
    own = trees.Boosted(((1.0, ("a", 0.5, -1.0, 1.0)),), {"a": 0.0})
    plan = spark.read.parquet(f"{tmp_path}/features").select(own.score())._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:double>" in plan and "Python" not in plan


def test_small_models():
    assert trees.Boosted((), {}).sql() == "(1 / (1 + exp(-2 * (0.0))))"
    one = trees.Boosted(((2.0, 0.25),), {})
    assert duckdb.sql(f"SELECT {one.sql()}").fetchall()[0][0] == pytest.approx(0.7310585786)
    assert trees.Boosted.from_json(one.to_json()) == one and one.features() == []


def test_as_a_filter_before_and_after(spark):
    """What is asked after filtering is the table as it is written: rows with code are gone from it."""
    base = {"name": [f"n{i}" for i in range(80)], "date": list(range(80)), "city": [f"c{i % 7}" for i in range(80)], "price": [i / 2 for i in range(80)], "total": [i * 3 for i in range(80)]}
    codes = [f"x{i}" if i > 2 else "import os\nimport sys\ndef f(x):\n    return x\n" * 30 for i in range(80)]
    rows = [("plain", blob(**base, note=[f"w{i}" for i in range(80)])), ("coded", blob(**base, note=codes))]
    tables = spark.createDataFrame([(k, bytearray(v)) for k, v in rows], "content_hash string, arrow_bytes binary")
    # Short texts are good.
    short = trees.Boosted(((1.0, ("obj_max_length_max", 50.0, 1.0, -1.0)),), {})
    score = trees.quality_of(short, summarize.features_of_tables)
    kept = {p: {r.content_hash: r for r in corpus.cleaned(tables, config("v6", table_quality_threshold=0.5, table_quality_position=p), quality=score).collect()} for p in ("pre", "post")}
    assert set(kept["pre"]) == {"plain"} and set(kept["post"]) == {"plain", "coded"}
    # The score of what is written, table by table.
    for name, row in kept["post"].items():
        table, _ = arrow_tables.decoded(bytes(row.arrow_bytes))
        df = spark.createDataFrame(table.to_pandas())
        assert summarize.table_features(df).select(short.score().alias("s")).first().s > 0.5, name
    assert kept["post"]["coded"].nrows == 77


def test_features_are_read_once(spark):
    """Each table is decoded once for all its features."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    cells = summarize.cells_of(spark.range(50).select("id", F.concat(F.lit("x"), "id").alias("t"))).mapInArrow(counted, "table_id string, row_idx long, col_idx int, col_name string, kind string, value string")
    assert len(summarize.features_of_tables(cells).collect()) == 1 and seen.value == 100

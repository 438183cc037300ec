"""The pipeline: each stage against a plain version of what it should do."""

import glob

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_operators import PASSAGE, SCHEMA, brute_components, filler

from tablesift.llm import common, secrets


@pytest.fixture()
def folder(spark, tmp_path):
    """A small folder of tables with a case for each stage."""
    import random

    rng = random.Random(9)
    docs = [(i, f"{filler(rng, 80)}") for i in range(60)]
    docs += [(60 + i, f"{filler(rng)} you idiot moron {filler(rng)}") for i in range(40)]
    docs += [(100, docs[0][1]), (101, docs[1][1] + " more"), (102, f"{filler(rng)} {PASSAGE} {filler(rng)}"), (103, f"{filler(rng)} {PASSAGE} {filler(rng)}"), (104, filler(rng) + " token=abcdefghijk"), (105, None), (106, "")]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(60 <= i < 100)) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one, two, three, four, five = (f for _, f in corpus_pipeline.STAGES)
    before = texts(docs)
    after = one(spark, docs, folder)
    assert after.columns == docs.columns and set(texts(after)) == set(before) - set(range(60, 100))
    lines = two(spark, after, folder)
    got = texts(lines)
    assert lines.columns == docs.columns and PASSAGE in got[102] and "sentence 3" not in got[103] and got[5] == before[5] and got[105] is None
    assert all(r.n_chars == len(r.text) for r in lines.collect() if r.text is not None)
    near = three(spark, lines, folder)
    rows = list(texts(lines).items())
    smallest = {eval(c)[2] for c in brute_components(rows) if eval(c)[1]}
    assert near.columns == docs.columns and set(texts(near)) == smallest | {i for i, t in rows if not (t or "").split()}
    clean = four(spark, near, folder)
    got = texts(clean)
    assert clean.columns == docs.columns and got[104].endswith("[assign]") and not any(secrets.base_spans(t or "") for t in got.values())
    assert {i for i in got if got[i] != texts(near)[i]} == {104}
    pieces = five(spark, clean, folder).collect()
    assert {p.doc_id for p in pieces} == set(got)


def test_run(spark, folder, sf_dir):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} & {60, 99} == set() and len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_of_any_name_stay(spark, folder):
    """A stage's own columns don't take the place of the input's."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name in ("score", "__score", "removed", "base", "spans", "a.b"):
        docs = docs.withColumn(name, F.lit("kept"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert set(docs.select("score", "__score", "removed", "base", "spans", "`a.b`").distinct().first()) == {"kept"}
        docs = docs.select("*")


def test_run_keeps_no_copies(spark, folder):
    """Of the tables between stages only the last is left, as the result is read from it."""
    from tablesift.llm.common import _shared_folder

    place = _shared_folder(spark).removeprefix("file:")
    before = set(glob.glob(f"{place}/*.parquet"))
    corpus_pipeline.run(spark, folder).collect()
    left = set(glob.glob(f"{place}/*.parquet")) - before
    assert sum("text" in spark.read.parquet(p).columns and "n_chars" in spark.read.parquet(p).columns for p in left) == 1


def test_batches_are_bounded(spark, folder):
    """A stage doesn't hand a whole partition of texts to a worker at once, and keeps to the user's own limit."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    large = spark.range(0, 2000, 1, 1).select("id", F.repeat(F.lit("word "), 2000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "size": [batch.nbytes]})

    stages = dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "near_duplicates", "secrets", "packing"):
        spark.conf.unset(limit)
        stages[name](spark, docs, folder)
        got = large.mapInArrow(sizes, "rows long, size long").collect()
        assert sum(r.rows for r in got) == 2000 and max(r.size for r in got) <= 1.25 * common.BATCH_BYTES, name
    spark.conf.set(limit, "1m")
    stages["secrets"](spark, docs, folder)
    assert spark.conf.get(limit) == "1m"
    spark.conf.unset(limit)

"""The sink that is all or nothing, and chunks that go on where a run broke off."""

import glob
import os

import pyarrow as pa
import pyarrow.csv
import pyarrow.parquet
import pytest
from pyspark.sql import functions as F
from test_corpus import blob, good

from tablesift.operators.sampling import chunk_of
from tablesift.plans import corpus
from tablesift.plans.config import config
from tablesift.queries import ORACLE_SQL, QUERIES
from tablesift.sources import arrow_tables, shards, sinks, transaction


def tables(spark, rows):
    return spark.createDataFrame([(k, None if b is None else bytearray(b)) for k, b in rows], "content_hash string, arrow_bytes binary").repartition(3)


ROWS = [("x", blob(a=[1, 2])), ("y", b"broken"), ("z", None), ("manifest", blob(a=["é"])), ("x", blob(a=[3]))]


def files(folder, attempts=True):
    found = sorted(os.path.relpath(p, folder) for p in glob.glob(f"{folder}/**", recursive=True) if os.path.isfile(p))
    return [f for f in found if attempts or not f.startswith("_attempts")]


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_files_and_manifest(spark, tmp_path, kind):
    manifest = transaction.save_tables(tables(spark, ROWS), f"{tmp_path}/out", kind)
    rows = sorted((r.table_id, r.rows, r.error is None) for r in manifest.collect())
    assert rows == [("manifest", 1, True), ("x", 1, True), ("x", 2, True), ("y", None, False)] == sorted((r.table_id, r.rows, r.error is None) for r in manifest.collect())
    read = pa.parquet.read_table if kind == "parquet" else pa.csv.read_csv
    assert sorted(read(r.path).num_rows for r in manifest.collect() if r.path) == [1, 1, 2] and len({r.path for r in manifest.collect() if r.path}) == 3
    told = transaction.committed(spark, f"{tmp_path}/out")
    assert (told["tables"], told["errors"]) == (3, 1) and not files(f"{tmp_path}/out/_attempts")


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    out = f"{tmp_path}/out"
    fails = tables(spark, ROWS).withColumn("arrow_bytes", F.when(F.col("content_hash") == "y", F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("arrow_bytes")))
    with pytest.raises(Exception, match="lost"):
        transaction.save_tables(fails, out)
    # A task that was still running may end later; the next commit deletes what it leaves.
    assert transaction.committed(spark, out) is None and files(out, False) == [] and transaction.read_manifest(spark, out).count() == 0
    # What was committed before a failing run stays as it is.
    first = sorted(map(tuple, transaction.save_tables(tables(spark, ROWS[:1]), out).collect()))
    before = files(out)
    assert not any(f.startswith("_attempts") for f in before)
    with pytest.raises(Exception, match="lost"):
        transaction.save_tables(fails, out, overwrite=True)
    assert files(out, False) == before and sorted(map(tuple, transaction.read_manifest(spark, out).collect())) == first


def test_a_commit_is_refused_or_replaced(spark, tmp_path):
    out = f"{tmp_path}/out"
    transaction.save_tables(tables(spark, ROWS), out)
    before = files(out)
    with pytest.raises(Exception, match="holds a commit"):
        transaction.save_tables(tables(spark, ROWS[:1]), out)
    assert files(out) == before
    again = transaction.save_tables(tables(spark, ROWS[3:4]), out, overwrite=True)
    assert [r.table_id for r in again.collect()] == ["manifest"] and len(files(out)) == 3
    assert transaction.save_tables(tables(spark, ROWS).filter("false"), f"{tmp_path}/none").count() == 0 and transaction.committed(spark, f"{tmp_path}/none")["tables"] == 0
    with pytest.raises(Exception, match="parquet"):
        transaction.save_tables(tables(spark, ROWS), f"{tmp_path}/other", "xlsx")


@pytest.fixture()
def shard_dir(spark, tmp_path):
    for i in range(5):
        rows = [(f"job/t{i}{j}", good(80 + j)) for j in range(3)] + [(f"job/broken{i}", b"no"), (f"job/small{i}", good(5)), ("job/t00", good(80))]
        os.makedirs(tmp_path / "in", exist_ok=True)
        pa.parquet.write_table(pa.table({"key": [k for k, _ in rows], "arrow_bytes": pa.array([b for _, b in rows], pa.binary())}), tmp_path / "in" / f"s{i}.parquet")
    corpus.dedup(spark, str(tmp_path / "in"), str(tmp_path / "index"))
    return tmp_path


def test_chunks_are_the_whole_run_and_go_on(spark, shard_dir, monkeypatch):
    own = [spark, f"{shard_dir}/in", f"{shard_dir}/index"]
    want = {(r.table_id, r.rows) for r in corpus.process(*own, f"{shard_dir}/one", config("v6")).collect()}
    assert len(want) == 15 and corpus.chunks_of(spark, f"{shard_dir}/in", 2) == 3
    begun = []
    real = transaction.save_tables

    def breaks(rows, directory, *args, **more):
        begun.append(directory)
        if len(begun) == 2:  # the second chunk breaks off in its tasks
            rows = rows.withColumn("arrow_bytes", F.when(F.col("content_hash").startswith("t"), F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("arrow_bytes")))
        return real(rows, directory, *args, **more)

    monkeypatch.setattr(transaction, "save_tables", breaks)
    with pytest.raises(Exception, match="lost"):
        corpus.process_chunks(*own, f"{shard_dir}/out", config("v6"), chunk_size=2)
    monkeypatch.setattr(transaction, "save_tables", real)
    got = corpus.process_chunks(*own, f"{shard_dir}/out", config("v6"), chunk_size=2).collect()
    assert {(r.table_id, r.rows) for r in got if r.error is None} == want and len(got) == 20
    assert {r.table_id for r in got if r.error} == {f"broken{i}" for i in range(5)} and {r.chunk for r in got} == {0, 1, 2}
    assert all(pa.parquet.read_table(r.path).num_rows == r.rows for r in got if r.path)
    # All chunks are done, so nothing is begun again.
    stamps = {p: os.stat(f"{shard_dir}/out/{p}").st_mtime_ns for p in files(f"{shard_dir}/out")}
    assert len(corpus.process_chunks(*own, f"{shard_dir}/out", config("v6"), chunk_size=2).collect()) == 20
    assert stamps == {p: os.stat(f"{shard_dir}/out/{p}").st_mtime_ns for p in files(f"{shard_dir}/out")}


def test_a_chunk_reads_its_part_of_the_index(spark, shard_dir):
    paths = shards.shard_paths(shards.read_shards(spark, f"{shard_dir}/in"))
    mine = chunk_of(paths, "path", 2, 1).select("path")
    index = sinks.read_index_of(spark, f"{shard_dir}/index", mine)
    assert "dynamicpruningexpression" in index._jdf.queryExecution().executedPlan().toString()
    whole = sinks.read_index(spark, f"{shard_dir}/index")
    assert sorted(map(tuple, index.collect())) == sorted(map(tuple, whole.join(mine, "path", "left_semi").select("key", "path", "content_hash").collect()))
    assert arrow_tables.decoded(good())[0].num_rows == 80


def test_index_folders_have_names_that_fit(spark, tmp_path):
    # "=" takes three bytes in a folder's name and "é" two, so the fourth is one byte too long and the third just fits.
    start = "file:///in/"
    fits = start + "=" * 70 + "é" * 10 + "x" * (249 - 17 - 210 - 20)
    paths = [f"{start}a.parquet", start + "y" * 400 + ".parquet", fits + ".parquet", fits + "x.parquet"]
    index = spark.createDataFrame([(f"a/t{i}", p, f"t{i}") for i, p in enumerate(paths)], "key string, path string, content_hash string")
    sinks.write_index(index, f"{tmp_path}/index")
    folders = [f for f in os.listdir(f"{tmp_path}/index") if f.startswith("shard=")]
    assert len(folders) == 4 and max(len(f.encode()) for f in folders) == 255 and sum(f.startswith("shard=md5-") for f in folders) == 2
    for i, p in enumerate(paths):
        mine = spark.createDataFrame([(p,)], "path string")
        assert [tuple(r) for r in sinks.read_index_of(spark, f"{tmp_path}/index", mine).collect()] == [(f"a/t{i}", p, f"t{i}")]


def test_stores_behind_a_mount_table_and_odd_names(spark, tmp_path):
    os.makedirs(tmp_path / "store")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.mounted.link./shared", f"file://{tmp_path}/store")
    assert sinks.qualified(spark, "viewfs://mounted/shared/a/b") == f"file://{tmp_path}/store/a/b"
    for out in (f"{tmp_path}/a b%20#é", "viewfs://mounted/shared/out"):
        manifest = transaction.save_tables(tables(spark, ROWS), out)
        assert sorted((r.table_id, r.rows) for r in manifest.collect() if r.path) == [("manifest", 1), ("x", 1), ("x", 2)]
        assert all(pa.parquet.read_table(r.path).num_rows == r.rows for r in manifest.collect() if r.path)


@pytest.mark.parametrize("name", ["corpus_chunks", "corpus_run"])
def test_queries_in_a_long_shared_folder_of_a_cluster(name, spark, sf_dir, duck, tmp_path, monkeypatch):
    context = spark.sparkContext
    before = context._jsc.sc().getCheckpointDir()
    context.setCheckpointDir(f"{tmp_path}/{'jobs-of-a-cluster/' * 8}shared")
    monkeypatch.setattr(context, "master", "spark://cluster:7077")  # what the sinks ask; nothing is started
    try:
        got = QUERIES[name](spark, sf_dir)
        want = duck.execute(ORACLE_SQL[name])
        assert sorted(map(repr, map(tuple, got.select(*[c[0] for c in want.description]).collect()))) == sorted(map(repr, want.fetchall()))
    finally:
        if before.isDefined():
            context.setCheckpointDir(os.path.dirname(before.get()))

"""Every query that has SQL gives the same rows in both engines."""

import pytest

from tablesift.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(name, spark, sf_dir, duck):
    got, want = QUERIES[name](spark, sf_dir), duck.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    plain = lambda rows: sorted(repr(tuple(None if v != v else v for v in r)) for r in rows)
    assert plain(got.select(*[f"`{n}`" for n in names]).collect()) == plain(want.fetchall())


def test_set_cover_covers_once(spark, sf_dir):
    got = QUERIES["set_cover"](spark, sf_dir).toPandas()
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("concat_ws('/', event_type, to_date(ts)) AS s").distinct().toPandas()
    assert sorted(got["string"]) == sorted(events["s"])


def test_quality_model_is_better_than_the_majority(spark):
    """On rows that it isn't fitted on."""
    got = QUERIES["quality_model"](spark, "/root/testdata/sf0.01").toPandas().iloc[0]
    good = got["true_positive"] + got["false_negative"]
    assert got["n"] == got[["true_positive", "false_positive", "false_negative", "true_negative"]].sum() and got["accuracy"] > max(good, got["n"] - good) / got["n"] and got["roc_auc"] > 0.8


def test_languages_are_detected(spark, sf_dir):
    got = QUERIES["detected_languages"](spark, sf_dir).toPandas()
    assert got.loc[got.known == got.lang, "n"].sum() > 0.9 * got["n"].sum()
    held = got[got.held_out]
    assert len(held) and held.loc[held.known == held.lang, "n"].sum() > 0.9 * held["n"].sum()
    assert got.loc[got.lang == "en", "english"].sum() > 0.9 * got.loc[got.lang == "en", "n"].sum() and not got.loc[got.lang != "en", "english"].sum()

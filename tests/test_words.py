"""The Treebank's rules, by sentences whose words are known, and the same in SQL."""

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesift.functions import words

KNOWN = {
    "Good muffins cost $3.88\nin New York.  Please buy me\ntwo of them.\nThanks.": "Good muffins cost $ 3.88 in New York. Please buy me two of them. Thanks .",
    "They'll save and invest more.": "They 'll save and invest more .",
    "hi, my name can't hello,": "hi , my name ca n't hello ,",
    'He said "no way" to it': "He said `` no way '' to it",
    '"quoted"': "`` quoted ''",
    "unit_price (EUR)": "unit_price ( EUR )",
    "cannot, gonna gotta lemme gimme wanna go": "can not , gon na got ta lem me gim me wan na go",
    "'Tis what 'twas, d'ye see": "'T is what 't was , d 'ye see",
    "Ann's and the dogs' toys": "Ann 's and the dogs ' toys",
    "10:30, 1,000.5 and ratio:x": "10:30 , 1,000.5 and ratio : x",
    "wait... what?! a--b [c] {d} <e>": "wait ... what ? ! a -- b [ c ] { d } < e >",
    "e.g. Mr. Smith (Jr.)": "e.g. Mr. Smith ( Jr . )",
    "50% off #1 @home a;b": "50 % off # 1 @ home a ; b",
    "égonna Éva's": "égonna Éva 's",
    "": "",
    "  \t ": "",
}


@pytest.mark.parametrize("text", KNOWN)
def test_known_words(spark, text):
    got = spark.range(1).select(words.words(F.lit(text))).first()[0]
    assert " ".join(got) == KNOWN[text]


def test_null(spark):
    assert spark.range(1).select(words.words(F.lit(None).cast("string"))).first()[0] is None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", "I", "'s", "n't", "can", "not", ".", "..", "...", ",", ":", '"', "''", "``", "'", "(", ")", "--", " ", "3.5", "gonna", "?", ";", "]"]), max_size=12).map("".join), min_size=1, max_size=30))
def test_sql_is_the_same(spark, texts):
    """Where a contraction touches no letter beyond ASCII, which bounds a word in one of the engines only."""
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r[0]: list(r[1]) for r in spark.createDataFrame(rows, "i long, t string").select("i", words.words(F.col("t"))).collect()}
    frame = __import__("pandas").DataFrame(rows, columns=["i", "t"])  # noqa: F841
    want = dict(duckdb.sql(f"SELECT i, {words.words_sql('t')} FROM frame").fetchall())
    assert got == want

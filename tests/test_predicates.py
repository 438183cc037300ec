"""Predicates against Python's own patterns and known samples."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesift.functions import predicates as P
from tablesift.functions.language import FrequentWords, KnownLanguage, ModelDetector


def flags(spark, predicate, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(predicate(F.col("t"))).collect()]


CODE = ["def f(x):\n  pass", "function go () {", "a = max(1, 2) {", "x # note", "/* remark */", "System.out.println(x)", "y => 1", "std::sort", "a->b", "wait.. what", " int 9=", "please print this"]
PLAIN = ["a sentence (with brackets).", "f(x) = 3", "int x = 3", "printer", "10:30", "a-b", "3 > 2", "", "https://example.org/x", "e.g. this", None]
PII = ["a.b@c.org", "write to X_y%1@mail.example.COM now", "(12) 345-678", "555-123-4567", "1.2.3", "2024-01-05", "10.0.0.1"]
NO_PII = ["a@b", "1234567", "2024/01/05", "@handle", "12-34", "", None, "call 5551234567"]


@pytest.mark.parametrize("predicate,yes,no", [(P.contains_code, CODE, PLAIN), (P.contains_pii, PII, NO_PII), (P.is_number, ["1", "-3.14", "01", "1..5", "0000"], ["3.", ".5", "+1", "1e5", "", "x", None])])
def test_samples(spark, predicate, yes, no):
    assert flags(spark, predicate, yes) == [True] * len(yes)
    assert flags(spark, predicate, no) == [False] * len(no)


def test_key_value_headers(spark):
    assert flags(spark, P.is_key_value, ['"a": "b"', "x 'k': 'v' y", '{"a":"b"}', "\"a\"x:y\"b\""]) == [True] * 4
    assert flags(spark, P.is_key_value, ["a: b", '"a: b"', "'a' 'b'", None]) == [False] * 4


def test_null_like(spark):
    assert flags(spark, P.null_like, [None, "", "  ", "\t", "\n ", "x", " x ", "0", "nan", "None"]) == [True] * 5 + [False] * 5


def test_share_counts_nulls(spark):
    df = spark.createDataFrame([("#",), ("x",), (None,), ("y",)], "t string")
    assert df.agg(P.share(P.contains_code(F.col("t")))).first()[0] == 0.25


def test_substrings(spark):
    assert flags(spark, lambda c: P.contains_any(c, ["@@@", "###"]), ["a@@@", "##", "x###y", None]) == [True, False, True, False]
    with pytest.raises(ValueError):
        P.contains_any(F.lit("x"), "abc")


def test_clipping_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (float("inf"),), (2e15,), (-2e15,), (1.0,)], "x double")
    assert [r[0] for r in df.select(P.clipped(F.col("x"))).collect()] == [None, None, 1e15, -1e15, 1.0]


def test_bytes(spark):
    df = spark.createDataFrame([(bytearray("é".encode()),), (bytearray(b"\xe9"),), (bytearray(b""),)], "b binary")
    assert [r[0] for r in df.select(P.decoded(F.col("b"))).collect()] == ["é", "é", ""]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="def f(x):{}#/*-> .=:int class\n\t'\"09é@-", max_size=40), min_size=1, max_size=40))
def test_same_as_python(spark, texts):
    code, pii = re.compile(P.CODE), re.compile(P.PII, re.IGNORECASE)
    assert flags(spark, P.contains_code, texts) == [bool(code.search(t)) for t in texts]
    assert flags(spark, P.contains_pii, texts) == [bool(pii.search(t)) for t in texts]


def test_languages(spark):
    texts = ["name of the city and total price", "der name und die anzahl von dem jahr", None, "", "zzz qqq"]
    found = flags(spark, FrequentWords(), texts)
    assert [f and f.lang for f in found] == ["en", "de", None, None, "und"]
    assert flags(spark, lambda c: P.is_english(FrequentWords()(c)), texts) == [True, False, False, False, False]
    model = ModelDetector(lambda: lambda texts: [("en" if "the" in t else "xx", 1.2) for t in texts])
    assert [f and (f.lang, f.score) for f in flags(spark, model, ["the", "le", None])] == [("en", 1.0), ("xx", 1.0), None]
    df = spark.createDataFrame([("x", "fr")], "t string, l string")
    assert df.select(KnownLanguage("l")(F.col("t")).alias("r")).first().r.lang == "fr"


def test_header_words(spark):
    df = spark.createDataFrame([("unit_price (EUR)",)], "n string")
    row = df.select(P.header_chars(F.col("n")), P.header_underscores(F.col("n")), P.header_words(F.col("n"))).first()
    assert list(row) == [16.0, 1.0, 4.0]

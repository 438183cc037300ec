"""Periodic runs against a search by every lag."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_operators import documents, edge, empty  # noqa: F401

from tablesift.llm import periodic


def runs_by_lag(words, least=6, exponent=4):
    best = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, exponent * q):
                best.setdefault((start, i - start + q), q)
            i += 1
    return sorted((s, n, q) for (s, n), q in best.items())


def of_texts(texts, **more):
    text, start, length, period = periodic.find_runs([np.array(t, np.int64) for t in texts], **more)
    return [sorted(zip(start[text == i].tolist(), length[text == i].tolist(), period[text == i].tolist())) for i in range(len(texts))]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def composed(rng):
    kinds, out = rng.choice([1, 2, 3, 5, 30]), []
    for _ in range(rng.randint(0, 6)):
        part = [rng.randrange(kinds) for _ in range(rng.choice([1, 2, 3, 7, 15, 16, 17, 31, 32, 33, 63, 64, 65, 100]))]
        if rng.random() < 0.4:  # a period that has runs itself
            part = part[: max(1, len(part) // rng.choice([2, 3, 5]))] * rng.choice([3, 4, 5]) + [9]
        out += (part * 8)[: int(len(part) * rng.uniform(0.5, 6.5))]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_runs_are_those_of_every_lag(seed):
    rng = random.Random(seed)
    texts = [composed(rng) for _ in range(30)] + [fibonacci(rng.randint(0, 400)), fibonacci(40) * 6, [bin(i).count("1") % 2 for i in range(60)] * 5, [], [1]]
    assert of_texts(texts) == [runs_by_lag(t) for t in texts]
    # Without direct scans to speak of, the minimizers find the same.
    assert of_texts(texts, first_scale=2) == [runs_by_lag(t) for t in texts]


@settings(deadline=None, max_examples=100)
@given(st.lists(st.lists(st.integers(0, 2), max_size=150), max_size=4))
def test_runs_of_any_words(texts):
    texts = [t * 3 + t[:7] for t in texts] + texts
    assert of_texts(texts, first_scale=4) == [runs_by_lag(t) for t in texts]


def test_seeds_between_texts_alone():
    """Equal minimizers that stand in two texts, with a shorter one left out between them, are no seeds."""
    rng = random.Random(2)
    for _ in range(300):
        texts = [[rng.randrange(2) for _ in range(rng.choice([16, 17, 20, 33, 40, 70]))] if rng.random() < 0.5 else [rng.randrange(3)] * rng.randint(0, 3) for _ in range(rng.randint(2, 9))]
        assert of_texts(texts, first_scale=4) == [runs_by_lag(t) for t in texts]


def test_long_runs_are_found_in_little_time():
    period = np.random.default_rng(1).integers(0, 5, 60_000)
    one, tiled, zipf = np.zeros(300_000, np.int64), np.tile(period, 5), np.random.default_rng(2).zipf(1.3, 300_000) % 1000
    text, start, length, found = periodic.find_runs([one, tiled, zipf])
    assert (0, 0, 300_000, 1) in set(zip(*map(np.ndarray.tolist, (text, start, length, found))))
    assert (1, 0, 300_000, 60_000) in set(zip(*map(np.ndarray.tolist, (text, start, length, found))))


def test_fewer_periods_than_four_are_refused():
    with pytest.raises(ValueError):
        periodic.find_runs([np.zeros(9, np.int64)], exponent=3)


def by_hand(doc_id, text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_by_lag(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_by_hand(spark, tmp_path):
    rng = random.Random(5)
    pool = ["a", "b", "the", "é", "A", "x,"]
    rows = [(i, " ".join(rng.choice(pool[: rng.randint(1, 6)]) for _ in range(rng.randint(0, 120)))) for i in range(150)]
    rows += [(None, "a " * 40), (7, None), (8, ""), (9, " \t\x0b\n "), (10, "a\x0bb " * 9), (10, "a\x0bb " * 9), (11, "no break " * 8), (12, "word " * 5000)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, periodic.op11_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((by_hand(*r) for r in rows), key=repr)
    assert any(r[1] for r in got)


def test_other_columns_and_whole_output(spark, edge, empty):  # noqa: F811
    edge = edge.withColumn("n_runs", edge["doc_id"]).withColumn("runs", edge["doc_id"])
    found = periodic.periodic_runs(edge)
    assert set(found.columns) == set(edge.columns) | {"n_runs", "runs", "collapsed"}
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(found.collect()) == edge.count()
    assert [tuple(r) for r in rows[6]["runs"]] == [(0, 30_000, 1)] and rows[6]["collapsed"] == "word"
    assert rows[1]["n_runs"] == 0 and rows[1]["collapsed"] == ""
    assert rows[3]["collapsed"] == "" and rows[9]["a.b"] == "clash"
    assert periodic.periodic_runs(empty).count() == 0

"""Mutual information by neighbours against a plain count, and on many tables and columns at once."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesift.operators import information, summarize


def plain(x, y, k=3):
    rows = [(a, b) for a, b in zip(x, y) if not (math.isnan(a) or math.isnan(b))]
    n = len(rows)
    if n < 2:
        return n, None
    k = min(k, n - 1)
    sx, sy = (float(np.std([r[i] for r in rows])) or 1.0 for i in (0, 1))
    h = lambda m: sum(1 / i for i in range(1, m + 1))
    total = 0.0
    for i, (a, b) in enumerate(rows):
        apart = [(math.floor(abs(a - c) / sx * 1e9 + 0.5), math.floor(abs(b - d) / sy * 1e9 + 0.5)) for j, (c, d) in enumerate(rows) if j != i]
        radius = sorted(max(p) for p in apart)[k - 1]
        total += h(sum(p[0] < radius for p in apart)) + h(sum(p[1] < radius for p in apart))
    return n, max(0.0, h(n - 1) + h(k - 1) - total / n)


@pytest.mark.parametrize("seed", range(8))
def test_estimate_is_the_plain_count(seed):
    rng = np.random.default_rng(seed)
    n = [2, 3, 4, 5, 30, 60, 80, 50][seed]
    x = rng.integers(0, 5, n).astype(float) if seed % 2 else rng.normal(size=n)
    y = x + rng.normal(size=n) / 2 if seed % 3 else np.full(n, 7.0)
    x[rng.random(n) < 0.1] = np.nan
    got, want = information.estimate(x, y), plain(x.tolist(), y.tolist())
    assert got[0] == want[0] and (got[1] is None) == (want[1] is None) and (got[1] is None or abs(got[1] - want[1]) < 1e-9)


def test_it_tells_what_depends():
    rng = np.random.default_rng(0)
    x = rng.normal(size=500)
    assert information.estimate(x, np.sin(3 * x))[1] > 1.5 and information.estimate(x, rng.normal(size=500))[1] < 0.1
    # Of normal variables it is known.
    y = 0.8 * x + 0.6 * rng.normal(size=500)
    assert abs(information.estimate(x, y)[1] + 0.5 * math.log(1 - 0.64)) < 0.12


def test_wide_tables_are_dealt_out_and_sampled(spark):
    rng = np.random.default_rng(1)
    rows = [(f"t{t}", i, *[float(v) for v in rng.normal(size=9)]) for t in range(3) for i in range(40 if t else 700)]
    df = spark.createDataFrame(rows, ["t", "i", *[f"c{j}" for j in range(9)]])
    names = [f"c{j}" for j in range(9)]
    many = information.neighbour_information(df, names, F.col("i"), F.col("t"), pairs=5)
    one = information.neighbour_information(df, names, F.col("i"), F.col("t"))
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, one.collect()))
    got = {(r.table_id, r.a, r.b): r for r in one.collect()}
    assert len(got) == 3 * 36 and {r.n for r in got.values() if r.table_id == "t0"} == {512}
    own = [r for r in rows if r[0] == "t1"]
    assert abs(got["t1", "c0", "c5"].mutual_information - plain([r[2] for r in own], [r[7] for r in own])[1]) < 1e-9
    assert information.neighbour_information(df.filter("false"), names, F.col("i")).count() == 0
    assert information.neighbour_information(df, ["c0"], F.col("i")).count() == 0


def test_from_cells(spark):
    df = spark.createDataFrame([(float(i), "x", i % 3, None if i == 4 else i * 2.0) for i in range(30)], "a double, b string, c long, d double")
    cells = summarize.cells_of(df.repartition(3), table_id="t")
    got = {(r.a, r.b): r for r in information.neighbour_information_of_tables(cells).collect()}
    assert set(got) == {("a", "c"), ("a", "d"), ("c", "d")}
    x, c, d = [float(i) for i in range(30)], [float(i % 3) for i in range(30)], [math.nan if i == 4 else i * 2.0 for i in range(30)]
    for (a, b), (p, q) in {("a", "c"): (x, c), ("a", "d"): (x, d), ("c", "d"): (c, d)}.items():
        n, want = plain(p, q)
        assert got[a, b].n == n and abs(got[a, b].mutual_information - want) < 1e-9

"""Hard negatives against all products at once."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesift.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, n string"


def mined(rows, anchors, positives=5, negatives=10, low=30, high=90, scale=256):
    """(anchor, positive, rank, negative, scores) by hand, with Python's integers."""
    rows = [(i, x, y) for i, x, y in rows if i is not None and y is not None and x and all(v is not None and math.isfinite(v) for v in x)]
    whole = [(i, [int(v) * scale if abs(v) > 2**53 else math.floor(v * scale) for v in x], y) for i, x, y in rows]
    out = []
    for anchor in sorted({i for i, _, _ in whole if anchors(i)}):
        x, y = min((y, x) for i, x, y in whole if i == anchor)[::-1]
        scores = sorted((-sum(a * b for a, b in zip(x, v)), i, label) for i, v, label in whole if i != anchor)
        for p, (minus, positive, _) in enumerate([s for s in scores if s[2] == y][:positives]):
            held = [s for s in scores if s[2] != y and low * -minus <= 100 * -s[0] <= high * -minus][:negatives]
            out += [(anchor, positive, p + 1, rank + 1, s[1], -minus, -s[0]) for rank, s in enumerate(held)]
    return sorted(out)


def made(spark, rows, **more):
    df = spark.createDataFrame([(i, x, y, "clash") for i, x, y in rows], SCHEMA).withColumnsRenamed({"n": more.pop("clash", "n")})
    got = hn.hard_negatives(df, F.col("vec_id") % 10 == 0, **more)
    return sorted(map(tuple, got.select("anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score").collect()))


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 5, 9), (64, 33, 70), (129, 64, 257), (200, 100, 131)])
def test_strassen_is_the_product(shape):
    rng = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = rng.integers(-(1 << 40), 1 << 40, (m, k)), rng.integers(-(1 << 20), 1 << 20, (k, n))
    for leaf, depth in ((1, 1), (4, 2), (64, 16)):
        assert (hn.strassen(a, b, leaf, depth) == a @ b).all()
    big = a.astype(object) * 10**30
    assert (hn.strassen(big, b.astype(object), 8, 8) == big @ b.astype(object)).all()


def test_wide_scores_are_in_order():
    some = [0, 5, 1 << 62, (1 << 63) - 2, (1 << 63) - 1, 1 << 63, (1 << 70) + 1, 1 << 700]
    some = sorted({*some, *[-s for s in some], -(1 << 63) - 1, -(1 << 64)})
    rng = random.Random(1)
    mixed = [(max(-(1 << 63), min((1 << 63) - 1, s)), hn.wide(s), s) for s in rng.sample(some, len(some))]
    assert all(hn.whole(a, b) == s for a, b, s in mixed)
    key = lambda r: (r[0], (r[1] is None) if r[0] < 0 else (r[1] is not None), r[1] or b"")
    assert [r[2] for r in sorted(mixed, key=key)] == some


@pytest.mark.parametrize("seed", range(3))
def test_by_hand(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in rng.integers(0, 3 if seed else 200, 6) / 2 - (0.3 if seed == 2 else 0)], int(min(rng.integers(0, 8), 3))) for i in range(150)]
    rows += [rows[3], rows[10], (20, [1.0] * 6, 0), (None, [1.0] * 6, 1), (151, None, 1), (152, [], 1), (153, [1.0] * 6, None), (154, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (155, [math.nan] * 6, 1), (156, [math.inf] * 6, 1), (-10, [2.5] * 6, 2), (160, [0.0] * 6, 1)]
    want = mined(rows, lambda i: i % 10 == 0)
    assert want and made(spark, rows) == want
    # Blocks of a few rows, merged over blocks and tasks.
    assert made(spark, rows, anchor_bytes=200, row_bytes=300) == want


def test_scores_beyond_64_bits(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.integers(1, 9, 4)], i % 3) for i in range(60)]
    rows += [(i, [float(v) * 10.0 ** int(rng.integers(15, 300)) for v in rng.integers(1, 9, 4)], i % 3) for i in range(60, 130)]
    fits = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    assert made(spark, rows) == [(*r[:5], fits(r[5]), fits(r[6])) for r in mined(rows, lambda i: i % 10 == 0)]


def test_edges(spark):
    assert made(spark, []) == []
    one = [(0, [1.0, 2.0], 1)]
    assert made(spark, one) == []
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [0.5, 3.0], 2), (4, [0.95, 0.0], 2), (5, [1.0, 0.0, 0.0], 2)]
    for clash in ("cell", "ids", "score", "bounds", "positive"):
        assert made(spark, rows, clash=clash) == mined(rows[:5], lambda i: i % 10 == 0)


def test_a_hot_label_and_equal_scores(spark):
    rows = [(i, [1.0, float(i % 4)], 0 if i % 3 else 1) for i in range(400)]
    assert made(spark, rows, row_bytes=1 << 10) == mined(rows, lambda i: i % 10 == 0)

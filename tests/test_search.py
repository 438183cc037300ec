"""Successive halving: how many fits there are, and that a seed decides."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from tablesift.operators import quality, search, trees


class Stand:
    """In the place of a fitted model: a known score, the better the nearer the trial's depth is to 4 and the smaller its number."""

    fits: list = []
    lock = threading.Lock()

    def __init__(self, trial, count):
        self.trial = trial
        with Stand.lock:
            Stand.fits.append((trial.number, count))

    def transform(self, rows):
        # Flips the order of some rows: the farther from depth 4, the more.
        noise = (F.abs(F.xxhash64("features")) % 10 < abs(self.trial.depth - 4) * 2 + self.trial.least / 10).cast("int")
        return rows.withColumn("rawPrediction", F.when(noise == 1, 1 - F.col("quality")).otherwise(F.col("quality")))


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(1)
    rows = [(f"t{i}", x := rng.gauss(0, 1), rng.gauss(0, 1), int(x + rng.gauss(0, 0.3) > 0)) for i in range(300)]
    return spark.createDataFrame(rows, "table_id string, a double, b double, quality int").repartition(2)


@pytest.mark.parametrize(("trials", "want"), [(1, [(1, 3)]), (2, [(2, 3), (1, 9)]), (20, [(20, 3), (6, 9), (2, 27), (1, 81)]), (50, [(50, 3), (16, 9), (5, 27), (1, 81)]), (200, [(200, 3), (66, 9), (22, 27), (7, 81)])])
def test_rungs(trials, want):
    assert search.rungs(trials) == want


@pytest.mark.parametrize("trials", [20, 50])
def test_losers_stop_early_and_a_seed_decides(features, trials):
    got = []
    for parallel in (1, 4):
        Stand.fits = []
        found = search.search
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(search, "PipelineModel", lambda stages: stages[-1])
            found = search.search(features, ["a", "b"], trials=trials, parallel=parallel, fit=lambda rows, t, n, label, seed: Stand(t, n))
        assert found.fits() == len(Stand.fits) == sum(n for n, _ in search.rungs(trials))
        for (count, n), (own, scores) in zip(search.rungs(trials), found.rungs):
            assert own == n and len(scores) == count and [s for _, s in scores] == sorted((s for _, s in scores), reverse=True)
        # Who goes on was among the best of the rung before.
        for (_, before), (_, after) in zip(found.rungs, found.rungs[1:]):
            assert {t for t, _ in after} == {t for t, _ in before[: len(after)]}
        got.append((found.trial, found.history()))
    assert got[0] == got[1] and got[0][0].depth == min((t.depth for t in search.drawn(trials, 42)), key=lambda d: abs(d - 4))
    assert search.drawn(trials, 1) != search.drawn(trials, 2)


def test_the_winner_is_a_model(spark, features):
    found = search.search(features, ["a", "b"], trials=4, first=1, most=3)
    assert [n for n, _ in found.rungs] == [1, 3] and found.fits() == 5
    scores = quality.scored(features, found.model, ["a", "b"])
    assert quality.evaluate(scores).first().accuracy > 0.85
    own = trees.compiled(found.model, ["a", "b"])
    both = scores.select("table_id", "score").join(features.select("table_id", own.score().alias("own")), "table_id")
    assert both.filter(F.abs(F.col("score") - F.col("own")) > 1e-12).count() == 0
    with pytest.raises(ValueError):
        search.search(features.withColumn("quality", F.lit(1)), ["a", "b"], trials=2)

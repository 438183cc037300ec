"""Search over the parameters of the quality model by successive halving.

Trials are drawn from a space by a seed. All of them are fitted with few trees, side by side,
and judged on rows that none is fitted on; the best third goes on with three times as many trees, and
so on, until one is left or the budget of trees is reached.  Losers cost few trees, so fifty trials
cost about as much as a handful of whole fits.

Features are prepared and settled once for all trials.  Fits are Spark jobs of their own, submitted from
a few threads, so executors that one fit leaves idle work for another.

Defined results: the same seed and rows give the same trials, rungs and winner, whatever ends first; trials
with equal scores go on in their order; a split without both classes in its judging part is an error.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tablesift.operators.quality import prepared
from tablesift.operators.sampling import stratified_split
from tablesift.streaming.runner import shared_folder

#: Of the trials of a rung one in so many goes on, with so many times the trees.
ETA = 3
FIRST_TREES, MOST_TREES = 3, 81


@dataclass(frozen=True)
class Trial:
    number: int
    depth: int
    step: float
    share: float  # of rows for each tree
    least: int  # rows in a leaf
    features: str  # tried at a split


@dataclass
class Search:
    """The winner, fitted, and each rung: trees, and (trial, area under the curve), the best first."""

    model: PipelineModel
    trial: Trial
    rungs: list[tuple[int, list[tuple[Trial, float]]]] = field(default_factory=list)

    def fits(self) -> int:
        return sum(len(own) for _, own in self.rungs)

    def history(self) -> list[dict]:
        """A row for each fit, for a report."""
        return [{"rung": i, "trees": n, "auc": auc} | asdict(t) for i, (n, own) in enumerate(self.rungs) for t, auc in own]


def drawn(trials: int, seed: int) -> list[Trial]:
    rng = random.Random(seed)
    return [Trial(i, rng.randint(2, 6), math.exp(rng.uniform(math.log(0.03), math.log(0.3))), rng.choice([0.5, 0.7, 0.85, 1.0]), rng.choice([1, 2, 5, 10]), rng.choice(["sqrt", "0.5", "all"])) for i in range(trials)]


def rungs(trials: int, first: int = FIRST_TREES, most: int = MOST_TREES, eta: int = ETA) -> list[tuple[int, int]]:
    """How many trials are fitted, with how many trees, rung by rung."""
    out, count, trees = [], trials, first
    while True:
        out.append((count, min(trees, most)))
        if count == 1 or trees >= most:
            return out
        count, trees = max(1, count // eta), trees * eta


def _fitted(rows: DataFrame, trial: Trial, trees: int, label: str, seed: int) -> PipelineModel:
    gbt = GBTClassifier(
        labelCol=label, featuresCol="features", maxIter=trees, maxDepth=trial.depth, stepSize=trial.step, subsamplingRate=trial.share,
        minInstancesPerNode=trial.least, featureSubsetStrategy=trial.features, seed=seed, cacheNodeIds=False,
    )
    return gbt.fit(rows)


def search(
    features: DataFrame,
    names: list[str],
    label: str = "quality",
    key: str = "table_id",
    trials: int = 20,
    seed: int = 42,
    parallel: int = 4,
    first: int = FIRST_TREES,
    most: int = MOST_TREES,
    fit: Callable[[DataFrame, Trial, int, str, int], object] = _fitted,
) -> Search:
    """The best of ``trials`` draws on ``features``; a fifth of the rows, by digest and label, judges.

    The model is a pipeline as ``tablesift.operators.quality.fit`` makes one, for scoring, saving and ``trees.compiled``.
    """
    shared_folder(features.sparkSession)
    rows = prepared(features.select(key, label, *names), names).withColumn(label, F.col(label).cast("double"))
    held = rows.agg(*[F.count(n).alias(f"c{i}") for i, n in enumerate(names)]).first()
    rows = stratified_split(rows.fillna(0.0, [n for i, n in enumerate(names) if not held[i]]), label, key, seed=seed)
    before = Pipeline(stages=[Imputer(inputCols=names, outputCols=[f"{n}__in" for n in names]), VectorAssembler(inputCols=[f"{n}__in" for n in names], outputCol="features", handleInvalid="keep")])
    made = before.fit(rows.filter("in_train"))
    ready = made.transform(rows).select(label, "features", "in_train").checkpoint()
    train, judge = ready.filter("in_train").drop("in_train"), ready.filter("NOT in_train").drop("in_train")
    if judge.select(label).distinct().count() < 2:
        raise ValueError("the rows that judge have one class only")
    area = BinaryClassificationEvaluator(labelCol=label)

    left, found, best = drawn(trials, seed), [], None
    with ThreadPoolExecutor(parallel) as pool:
        for _, trees in rungs(trials, first, most):
            task = inheritable_thread_target(features.sparkSession)(lambda t, n=trees: (m := fit(train, t, n, label, seed), area.evaluate(m.transform(judge))))
            done = list(pool.map(task, left))
            ranked = sorted(zip(left, done), key=lambda r: (-r[1][1], r[0].number))
            found.append((trees, [(t, auc) for t, (_, auc) in ranked]))
            best = ranked[0]
            left = sorted((t for t, _ in ranked[: max(1, len(left) // ETA)]), key=lambda t: t.number)
    trial, (model, _) = best
    return Search(PipelineModel(stages=[*made.stages, model]), trial, found)

"""The quality model: fit on table features, evaluate, save, and score as a filter.

Boosted trees of Spark ML stand for any classifier with probabilities.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesift.functions.predicates import clipped
from tablesift.operators.sampling import stratified_split

TOP = 20


def prepared(features: DataFrame, names: list[str]) -> DataFrame:
    """Infinity and NaN as missing, and clipped."""
    return features.withColumns({n: clipped(F.when(~F.isnan(F.col(n).cast("double")), F.col(n).cast("double"))) for n in names})


def fit(features: DataFrame, names: list[str], label: str = "quality", trials: int = 1, seed: int = 42, max_iter: int = 20) -> PipelineModel:
    """Fit on all rows given; with more than one trial, tree depth and step are searched."""
    trees = GBTClassifier(labelCol=label, featuresCol="features", maxIter=max_iter, maxDepth=4, seed=seed)
    stages = [Imputer(inputCols=names, outputCols=[f"{n}__in" for n in names]), VectorAssembler(inputCols=[f"{n}__in" for n in names], outputCol="features", handleInvalid="keep")]
    rows = prepared(features, names).withColumn(label, F.col(label).cast("double"))
    # A column without any value can't be imputed; it tells nothing, and is 0.
    held = rows.agg(*[F.count(n).alias(f"c{i}") for i, n in enumerate(names)]).first()
    rows = rows.fillna(0.0, [n for i, n in enumerate(names) if not held[i]])
    if trials > 1:
        depths = [3, 4, 5, 6][: max(1, min(4, trials // 2))]
        grid = ParamGridBuilder().addGrid(trees.maxDepth, depths).addGrid(trees.stepSize, [0.05, 0.1]).build()
        trees = TrainValidationSplit(estimator=trees, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol=label), trainRatio=0.8, seed=seed)
    return Pipeline(stages=[*stages, trees]).fit(rows)


def scored(features: DataFrame, model: PipelineModel, names: list[str]) -> DataFrame:
    """Add ``score``, the probability of label 1; features are found by name, in the order of the model."""
    rows = prepared(features, names)
    made = {f"{n}__in" for n in names} | {"features", "rawPrediction", "prediction"}
    out = model.transform(rows).withColumn("score", vector_to_array("probability")[1])
    return out.drop(*made, "probability")


def evaluate(scores: DataFrame, label: str = "quality") -> DataFrame:
    """Accuracy, area under the curve, and the counts per class, as one row."""
    rows = scores.select(F.col(label).cast("double").alias("label"), F.col("score"), (F.col("score") >= 0.5).cast("double").alias("prediction"))
    auc = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(rows)
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(rows)
    of = lambda y, p: F.sum(((F.col("label") == y) & (F.col("prediction") == p)).cast("long"))
    got = rows.agg(F.count(F.lit(1)).alias("n"), of(1, 1).alias("true_positive"), of(0, 1).alias("false_positive"), of(1, 0).alias("false_negative"), of(0, 0).alias("true_negative"))
    return got.withColumns({"accuracy": F.lit(accuracy), "roc_auc": F.lit(auc)})


def report(scores: DataFrame, label: str = "quality") -> DataFrame:
    """Precision, recall, F1 and support of each class."""
    rows = scores.select(F.col(label).cast("int").alias("label"), (F.col("score") >= 0.5).cast("int").alias("prediction"))
    counts = rows.groupBy("label", "prediction").count()
    both = counts.select(F.explode(F.array(F.struct(F.col("label").alias("class"), F.lit(True).alias("true")), F.struct(F.col("prediction").alias("class"), F.lit(False).alias("true")))).alias("c"), "label", "prediction", "count").select("c.*", "label", "prediction", "count")
    hit = F.sum(F.when(F.col("true") & (F.col("label") == F.col("prediction")), F.col("count")).otherwise(0))
    support, called = F.sum(F.when(F.col("true"), F.col("count")).otherwise(0)), F.sum(F.when(~F.col("true"), F.col("count")).otherwise(0))
    got = both.groupBy("class").agg(hit.alias("hit"), support.alias("support"), called.alias("called"))
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    got = got.select("class", part("hit", "called").alias("precision"), part("hit", "support").alias("recall"), "support")
    f1 = F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return got.select("class", "precision", "recall", f1.alias("f1"), "support")


def importances(model: PipelineModel, names: list[str], top: int = TOP) -> list[tuple[str, float]]:
    """The features with the largest importance."""
    last = model.stages[-1]
    trees = getattr(last, "bestModel", last)
    weights = trees.featureImportances.toArray()
    return sorted(zip(names, map(float, weights)), key=lambda x: (-x[1], x[0]))[:top]


def save(model: PipelineModel, directory: str) -> str:
    """Save under a name of its own; returns the path."""
    path = f"{directory}/model-{uuid.uuid4().hex}"
    model.write().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train(features: DataFrame, names: list[str], label: str = "quality", key: str = "table_id", trials: int = 1) -> tuple[PipelineModel, DataFrame]:
    """Split by label, fit on the training part, evaluate on the rest."""
    split = stratified_split(features, label, key)
    model = fit(split.filter("in_train"), names, label, trials)
    return model, evaluate(scored(split.filter("NOT in_train"), model, names), label)


def cells_quality(features: Callable[[DataFrame], DataFrame], model: PipelineModel, names: list[str]) -> Callable[[DataFrame], DataFrame]:
    """A quality function for ``tablesift.plans.corpus.cleaned``."""
    return lambda cells: scored(features(cells), model, names).select("table_id", "score")

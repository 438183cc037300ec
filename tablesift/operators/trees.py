"""Fitted trees as Column expressions, as SQL and as JSON.

A fitted model of boosted trees, with what it puts in the place of missing values, is a function
of columns.  As an expression it is part of the plan: no transformer, no vectors and no
Python are needed to score, columns that no tree asks for aren't read, and the same function as SQL
runs in any engine.

Defined results: a missing value is null, NaN or infinity upwards and is replaced as in the model; other
values are clipped; a model without trees gives 0.5.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import ImputerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesift.functions.kinds import named
from tablesift.functions.predicates import CLIP, clipped

#: A leaf is its value; any other node is (feature, threshold, node up to the threshold, node above it).
Node = float | tuple[str, float, "Node", "Node"]

_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)$")


@dataclass(frozen=True)
class Boosted:
    """Boosted trees for two classes, each with its weight, and the values for missing ones."""

    trees: tuple[tuple[float, Node], ...]
    missing: dict[str, float]

    def features(self) -> list[str]:
        """The columns that are read, sorted."""

        def of(node: Node) -> set[str]:
            return set() if not isinstance(node, tuple) else {node[0]} | of(node[2]) | of(node[3])

        return sorted(set().union(*[of(t) for _, t in self.trees]))

    def score(self) -> Column:
        """The probability of class 1, from the columns of the features' names."""

        def value(name: str) -> Column:
            x = named(name).cast("double")
            return F.coalesce(clipped(F.when(~F.isnan(x), x)), F.lit(self.missing.get(name, 0.0)))

        own = {n: value(n) for n in self.features()}

        def of(node: Node) -> Column:
            return F.lit(float(node)) if not isinstance(node, tuple) else F.when(own[node[0]] <= node[1], of(node[2])).otherwise(of(node[3]))

        margin = reduce(lambda a, b: a + b, [F.lit(w) * of(t) for w, t in self.trees], F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))

    def sql(self) -> str:
        """The same as an SQL expression."""

        def value(name: str) -> str:
            quoted = '"' + name.replace('"', '""') + '"'
            return f"coalesce(CASE WHEN NOT isnan({quoted}) AND {quoted} < 'infinity'::DOUBLE THEN greatest(least({quoted}, {CLIP!r}), -{CLIP!r}) END, {self.missing.get(name, 0.0)!r})"

        def of(node: Node) -> str:
            return f"({float(node)!r})" if not isinstance(node, tuple) else f"CASE WHEN {value(node[0])} <= {float(node[1])!r} THEN {of(node[2])} ELSE {of(node[3])} END"

        margin = " + ".join([f"{float(w)!r} * ({of(t)})" for w, t in self.trees]) or "0.0"
        return f"(1 / (1 + exp(-2 * ({margin}))))"

    def to_json(self) -> str:
        return json.dumps({"trees": [{"weight": w, "tree": t} for w, t in self.trees], "missing": self.missing}, sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Boosted:
        def of(node: object) -> Node:
            return float(node) if not isinstance(node, list) else (node[0], float(node[1]), of(node[2]), of(node[3]))  # type: ignore[arg-type,index]

        got = json.loads(text)
        return Boosted(tuple((float(t["weight"]), of(t["tree"])) for t in got["trees"]), {k: float(v) for k, v in got["missing"].items()})


def _node(lines: Iterator[str], names: list[str]) -> Node:
    line = next(lines)
    if line.startswith("Predict: "):
        return float(line.removeprefix("Predict: "))
    found = _SPLIT.match(line)
    if found is None:
        raise ValueError(f"only splits of numbers are known: {line}")
    below = _node(lines, names)
    if not next(lines).startswith("Else "):
        raise ValueError("a split has two sides")
    return (names[int(found[1])], float(found[2]), below, _node(lines, names))


def compiled(model: PipelineModel, names: list[str]) -> Boosted:
    """Of a model that ``tablesift.operators.quality.fit`` has fitted on the features ``names``."""
    last = model.stages[-1]
    boosted = getattr(last, "bestModel", last)
    missing = {}
    for stage in model.stages:
        if isinstance(stage, ImputerModel):
            row = stage.surrogateDF.first()
            missing = {n: float(row[n]) for n in names}
    made = []
    for weight, tree in zip(boosted.treeWeights, boosted.trees):
        lines = iter([line.strip() for line in tree.toDebugString.splitlines()[1:] if line.strip()])
        made.append((float(weight), _node(lines, names)))
    return Boosted(tuple(made), missing)


def save(model: Boosted, spark: SparkSession, path: str) -> None:
    """One line of JSON, in any file system that Spark writes."""
    spark.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.text(path)


def load(spark: SparkSession, path: str) -> Boosted:
    return Boosted.from_json(spark.read.text(path, wholetext=False).first()[0])


def quality_of(model: Boosted, features: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """A quality function for ``tablesift.plans.corpus.cleaned``: from cells to table_id and score."""
    return lambda cells: features(cells).select("table_id", model.score().alias("score"))

"""Mutual information of numeric columns by nearest neighbours.

For two columns the distance of two rows is the larger one of their differences, each by its
column's standard deviation, in billionths, so that differences of decimals that should be equal are.  With n rows, a row's radius is the distance of its k-th neighbour, and n_x
and n_y count the other rows that are nearer than that in one column alone.  The estimate is
psi(n) + psi(k) - mean(psi(n_x + 1) + psi(n_y + 1)), not below 0; as psi of whole numbers are harmonic
numbers less a constant, H(n - 1) + H(k - 1) - mean(H(n_x) + H(n_y)) in nats.

At most ``rows`` rows of a table count, those of the smallest digests of their keys, so a table is a
matrix of bounded height; all pairs of all tables' columns are one job, in which a wide table is
dealt to several tasks, some pairs each.

Defined results: a row with a null or NaN in either column doesn't count for the pair; rows at
equal distance are all as near as the k-th, and none of them counts as nearer; a column without spread is
not scaled; with k rows or fewer the farthest other row is the neighbour; fewer than two rows give null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesift.functions.kinds import NUMERIC, named

NEIGHBOURS = 3
MAX_ROWS = 512
#: Distances are whole numbers of these parts of a standard deviation.
UNITS = 1e9
#: Pairs of columns that a task takes at a time.
PAIRS = 2048


def _harmonic(n: int) -> np.ndarray:
    """H(0) to H(n)."""
    return np.append(0.0, np.cumsum(1.0 / np.arange(1, n + 1)))


def estimate(x: np.ndarray, y: np.ndarray, k: int = NEIGHBOURS) -> tuple[int, float | None]:
    """Rows that count, and the estimate."""
    there = ~(np.isnan(x) | np.isnan(y))
    x, y = x[there], y[there]
    n = len(x)
    if n < 2:
        return n, None
    k = min(k, n - 1)
    apart = [np.floor(np.abs(v[:, None] - v) / (v.std() or 1.0) * UNITS + 0.5) for v in (x, y)]
    # A row is its own nearest one, at distance 0.
    radius = np.partition(np.maximum(*apart), k, axis=1)[:, k, None]
    h = _harmonic(n)
    # Among the nearer ones is the row itself, unless its radius is 0.
    nearer = [np.maximum((a < radius).sum(1) - 1, 0) for a in apart]
    return n, max(0.0, float(h[n - 1] + h[k - 1] - (h[nearer[0]] + h[nearer[1]]).mean()))


def _of_block(own: pd.DataFrame, block: int, k: int, pairs: int) -> pd.DataFrame:
    own = own.sort_values("digest")
    matrix = np.array(own["xs"].tolist(), float).reshape(len(own), -1)
    names = own["names"].iloc[0]
    one, two = np.triu_indices(matrix.shape[1], 1)
    some = slice(block * pairs, (block + 1) * pairs)
    made = [(names[i], names[j], *estimate(matrix[:, i], matrix[:, j], k)) for i, j in zip(one[some].tolist(), two[some].tolist())]
    return pd.DataFrame(made, columns=["a", "b", "n", "mutual_information"]).assign(table_id=own["table_id"].iloc[0])


def _informed(sampled: DataFrame, k: int, pairs: int) -> DataFrame:
    """From table_id, digest, names and xs of some rows of each table."""
    m = F.size("names")
    blocks = F.ceil(m * (m - 1) / 2 / pairs).cast("int")
    dealt = sampled.filter(m > 1).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    schema = "a string, b string, n long, mutual_information double, table_id string"
    return dealt.groupBy("table_id", "block").applyInPandas(lambda key, own: _of_block(own, int(key[1]), k, pairs), schema).select("table_id", "a", "b", "n", "mutual_information")


def _sampled(rows: DataFrame, key: Column, count: int, seed: int) -> DataFrame:
    """Of each table ``count`` rows, by digest; Spark keeps no more than that of a table in a task before its shuffle."""
    rows = rows.withColumn("digest", F.md5(F.concat_ws(":", "table_id", key.cast("string"), F.lit(str(seed)))))
    place = F.row_number().over(Window.partitionBy("table_id").orderBy("digest"))
    return rows.withColumn("place", place).filter(F.col("place") <= count).select("table_id", "digest", "names", "xs")


def neighbour_information(df: DataFrame, names: list[str], key: Column, table: Column | None = None, k: int = NEIGHBOURS, rows: int = MAX_ROWS, seed: int = 0, pairs: int = PAIRS) -> DataFrame:
    """table_id, a, b, n and mutual_information of every pair of the columns ``names``.

    ``table`` says of which table a row is, if there are several; ``key`` tells the rows of a table apart.
    """
    table = F.lit("") if table is None else table.cast("string")
    own = df.select(table.alias("table_id"), key.cast("string").alias("key"), F.array(*[F.lit(n) for n in names]).alias("names"), F.array(*[named(n).cast("double") for n in names]).alias("xs"))
    return _informed(_sampled(own, F.col("key"), rows, seed), k, pairs)


def neighbour_information_of_tables(cells: DataFrame, k: int = NEIGHBOURS, rows: int = MAX_ROWS, seed: int = 0, pairs: int = PAIRS) -> DataFrame:
    """The same for every table of a corpus, from its cells; ``a`` and ``b`` are names of columns."""
    numbers = cells.filter(F.col("kind") == NUMERIC).select("table_id", "row_idx", F.struct("col_idx", "col_name", F.col("value").try_cast("double").alias("x")).alias("cell"))
    # A row has as many cells as its table has columns.
    own = numbers.groupBy("table_id", "row_idx").agg(F.array_sort(F.collect_list("cell")).alias("cells"))
    own = own.select("table_id", "row_idx", F.col("cells.col_name").alias("names"), F.col("cells.x").alias("xs"))
    return _informed(_sampled(own, F.col("row_idx"), rows, seed), k, pairs)

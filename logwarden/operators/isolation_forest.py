"""Isolation Forest (Liu, Ting, Zhou 2008): grown and applied by Spark tasks.

The forest is bounded by its settings, never by the data: each tree sees at most
``sample_rows`` rows, and every draw is a hash of the seed, the tree and the row or node, so
the model is the same on any partitioning and any engine.
Trees grow in parallel, one group per tree; scoring is an Arrow-batched function over the
feature columns alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logwarden import fixed_values as V
from logwarden.operators.durable import durable
from logwarden.operators.sampling import hash_sample

EULER_GAMMA = 0.5772156649
NODE_SCHEMA = "tree int, node int, feature int, threshold double, path double"


def expected_path(rows: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of ``rows`` rows."""
    m = np.asarray(rows, dtype=float)
    deep = np.maximum(m, 3.0)
    estimate = 2.0 * (np.log(deep - 1.0) + EULER_GAMMA) - 2.0 * (deep - 1.0) / deep
    return np.where(m > 2, estimate, np.where(m == 2, 1.0, 0.0))


def draw(*parts: object) -> float:
    """A number in [0, 1) from the first 32 bits of a hash."""
    return int(hashlib.md5("-".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2**32


def _grow(points: np.ndarray, depth: int, seed: int, tree: int) -> list[tuple]:
    """Nodes (id, feature, threshold, path); children of node i are 2i+1 and 2i+2."""
    nodes, pending = [], [(0, points, 0)]
    while pending:
        node, rows, level = pending.pop()
        spread = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
        if level >= depth or len(spread) == 0:
            nodes.append((node, -1, 0.0, level + float(expected_path(len(rows)))))
            continue
        feature = int(spread[int(draw(seed, tree, node, "feature") * len(spread))])
        low, high = rows[:, feature].min(), rows[:, feature].max()
        threshold = float(low + draw(seed, tree, node, "threshold") * (high - low))
        left = rows[:, feature] <= threshold
        if left.all():  # the draw rounded up to the maximum
            threshold = float(low)
            left = rows[:, feature] <= threshold
        nodes.append((node, feature, threshold, 0.0))
        pending += [(2 * node + 1, rows[left], level + 1), (2 * node + 2, rows[~left], level + 1)]
    return nodes


def _tree_samples(df: DataFrame, columns: Sequence[str], trees: int, psi: int, seed: int, total: int) -> DataFrame:
    """(tree, row_id, columns): each tree draws its rows from one pool of ``trees * psi`` rows.

    The pool is the rows of smallest key hash, all rows of a smaller table. One rule at every size.
    """
    pool = durable(hash_sample(df.select("row_id", *columns), trees * psi, seed, total), "pool")
    slots = df.sparkSession.sparkContext.defaultParallelism
    drawn = pool.repartition(slots, "row_id").withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    drawn = drawn.withColumn("_draw", F.md5(F.concat_ws("-", F.lit(seed), "tree", "row_id")))
    order = W.partitionBy("tree").orderBy("_draw", "row_id")
    return drawn.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= psi).drop("_draw", "_place")


def fit_forest(
    df: DataFrame,
    columns: Sequence[str] = V.FEATURE_COLUMNS,
    trees: int = V.FOREST_TREES,
    sample_rows: int = V.FOREST_SAMPLE_ROWS,
    seed: int = V.FOREST_SEED,
    total: int | None = None,
) -> tuple[DataFrame, int]:
    """Node table of the forest and the number of rows a full tree sample holds."""
    columns = list(columns)
    total = df.count() if total is None else total
    psi = max(min(sample_rows, total), 1)
    depth = int(np.ceil(np.log2(max(psi, 2))))

    def grow_tree(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        points = rows[columns].to_numpy(dtype=float)
        nodes = pd.DataFrame(_grow(points, depth, seed, tree), columns=["node", "feature", "threshold", "path"])
        nodes.insert(0, "tree", tree)
        return nodes

    samples = _tree_samples(df, columns, trees, psi, seed, total)
    return samples.groupBy("tree").applyInPandas(grow_tree, NODE_SCHEMA), psi


def forest_anomaly(
    nodes: DataFrame, psi: int, columns: Sequence[str] = V.FEATURE_COLUMNS
) -> Column:
    """The anomaly in (0, 1] of a row: 2^(-mean path / expected path), larger is worse.

    The node table is collected and broadcast: trees * (2 * sample_rows - 1) rows at most.
    """
    table = nodes.toPandas().sort_values(["tree", "node"])
    tree_ids = sorted(table["tree"].unique())
    width = int(table["node"].max()) + 1
    depth = int(np.ceil(np.log2(width + 1)))
    shape = (len(tree_ids), width)
    feature, threshold, path = np.full(shape, -1, np.int16), np.zeros(shape), np.zeros(shape)
    place = (table["tree"].map({t: i for i, t in enumerate(tree_ids)}).to_numpy(), table["node"].to_numpy())
    feature[place], threshold[place], path[place] = (
        table["feature"].to_numpy(), table["threshold"].to_numpy(), table["path"].to_numpy())
    model = nodes.sparkSession.sparkContext.broadcast((feature, threshold, path))
    scale = max(float(expected_path(psi)), 1e-12)

    def anomaly(batch: pd.DataFrame) -> pd.Series:
        feature, threshold, path = model.value
        points = batch.to_numpy(dtype=float)
        rows = np.arange(len(points))
        total = np.zeros(len(points))
        for f, t, p in zip(feature, threshold, path):
            node = np.zeros(len(points), dtype=np.int64)
            for _ in range(depth):
                split = f[node]
                goes_right = points[rows, split] > t[node]
                node = np.where(split >= 0, 2 * node + 1 + goes_right, node)
            total += p[node]
        return pd.Series(np.exp2(-total / (len(feature) * scale)))

    score = F.pandas_udf(anomaly, "double")
    return score(F.struct(*columns))

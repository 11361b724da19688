"""A tree of cells over points of any number, built and searched by Spark jobs, level by level.

A cell with more than ``leaf_rows`` points is split among pivots drawn from its own points, at
most ``fan`` of them, each point going to the nearest. Splitting goes on until every cell is small
or holds copies of one point only, so leaves keep their size however many points there are, and
the number of levels grows with the logarithm. Each cell has a pivot, a radius and a range in
every column; a search goes down only into cells that reach into its bound.

Cells are rows of a table. The first levels, up to ``top_cells`` cells, are broadcast; below them
searches and cells meet by grouping on the parent cell, in parts of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logwarden.operators.durable import durable

LEAF_ROWS = 256
FAN = 64
TOP_CELLS = 4096
#: Rows of one cell that one task handles at a time.
PART_ROWS = 16384
# Cells of one distance block; bounds a task's memory whatever the batch size is.
_BLOCK_CELLS = 2_000_000


def distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances, each as a sum of squared differences."""
    squared = np.zeros((len(points), len(others)))
    for column in range(others.shape[1]):
        squared += (points[:, column, None] - others[None, :, column]) ** 2
    return np.sqrt(squared)


def blocks(rows: int, width: int) -> list[slice]:
    step = max(_BLOCK_CELLS // max(width, 1), 1)
    return [slice(start, start + step) for start in range(0, rows, step)]


@dataclass
class PivotTree:
    """Located points (row_id, columns, cell) and the cells of each level below the root.

    A level has cell, parent, center, radius, low, high, rows and leaf. Children of a cell are
    numbered ``cell * fan + 1`` and on; the root is 0.
    """

    points: DataFrame
    levels: list[DataFrame]
    columns: list[str]


def _parts(rows: Column, size: int) -> Column:
    return F.greatest(F.ceil(rows / size), F.lit(1)).cast("long")


def _part_of(parts: Column) -> Column:
    return F.pmod(F.xxhash64("row_id", F.lit(7)), parts)


def _every(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))


def build_tree(
    points: DataFrame, columns: Sequence[str], least: int, leaf_rows: int = LEAF_ROWS, fan: int = FAN,
    part_rows: int = PART_ROWS,
) -> PivotTree:
    """Cells of at least ``least`` points each, unless there are fewer in all.

    A cell with fewer points is given up and its points go to the nearest other pivot beside it.
    """
    columns = list(columns)
    target = max(leaf_rows, 4 * least)
    open_ = points.select("row_id", *columns).withColumn("cell", F.lit(0).cast("long"))
    whole = open_.agg(F.count(F.lit(1)).alias("rows"), F.array(*map(F.min, columns)).alias("low"),
                      F.array(*map(F.max, columns)).alias("high")).first()
    if whole["rows"] <= target or whole["low"] == whole["high"]:
        return PivotTree(open_, [], columns)
    split = points.sparkSession.createDataFrame([(0, whole["rows"])], "cell long, rows long")
    located, levels = None, []
    while True:
        # Few split cells are broadcast by their size; where they are many, none holds many of the rows.
        pivots = durable(_pivots(open_, split, columns, target, fan, len(levels)), "tree-pivots")
        placed = durable(_assigned(open_, split, pivots, columns, part_rows), "tree-cells")
        small = durable(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < least).join(
            pivots.select("cell", "parent"), "cell"), "tree-small")
        if not small.isEmpty():
            moved = placed.drop("gap").join(small.select("cell", "parent"), "cell").drop("cell").select(
                "row_id", *columns, F.col("parent").alias("cell"))
            few = moved.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"))
            pivots = pivots.join(small.select("cell"), "cell", "left_anti")
            placed = durable(placed.join(small.select("cell"), "cell", "left_anti").unionByName(
                _assigned(moved, few, pivots, columns, part_rows)), "tree-cells")
        level = placed.groupBy("cell").agg(
            F.count(F.lit(1)).alias("rows"), F.max("gap").alias("radius"),
            F.array(*map(F.min, columns)).cast("array<double>").alias("low"),
            F.array(*map(F.max, columns)).cast("array<double>").alias("high")).join(pivots, "cell")
        level = durable(level.select(
            "cell", "parent", "center", "radius", "low", "high", "rows",
            ((F.col("rows") <= target) | (F.col("low") == F.col("high"))).alias("leaf")), "tree-level")
        levels.append(level)
        placed = placed.drop("gap")
        split = level.where("not leaf").select("cell", "rows")
        last = split.isEmpty()
        leaves = placed if last else placed.join(level.where("leaf").select("cell"), "cell", "left_semi")
        leaves = leaves.select("row_id", *columns, "cell")
        located = leaves if located is None else located.unionByName(leaves)
        if last:
            return PivotTree(located, levels, columns)
        open_ = placed.join(split.select("cell"), "cell", "left_semi").select("row_id", *columns, "cell")


def _pivots(open_: DataFrame, split: DataFrame, columns: list[str], target: int, fan: int, depth: int) -> DataFrame:
    """(cell, parent, center): the pivots of each cell to be split, drawn by key hash, as its children.

    About four times as many candidates as needed pass a filter on the hash, so that a cell's
    pivots are picked from a few hundred rows whatever its size.
    """
    wanted = F.greatest(F.least(F.lit(fan), F.ceil(F.col("rows") / target)), F.lit(2)).cast("int")
    span = 1 << 31
    likely = open_.join(split.withColumn("wanted", wanted), "cell").withColumn(
        "drawn", F.pmod(F.xxhash64("row_id", F.lit(depth)), F.lit(span))).where(
        F.col("drawn") * F.col("rows") <= F.lit(4.0 * span) * (F.col("wanted") + 4))
    number = F.row_number().over(W.partitionBy("cell").orderBy("drawn", "row_id"))
    return likely.withColumn("number", number).where("number <= wanted").select(
        (F.col("cell") * fan + F.col("number")).alias("cell"), F.col("cell").alias("parent"),
        F.array(*[F.col(c).cast("double") for c in columns]).alias("center"))


def _assigned(open_: DataFrame, split: DataFrame, pivots: DataFrame, columns: list[str], part_rows: int) -> DataFrame:
    """The rows with the child cell of the nearest pivot and the distance from it."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in open_.schema)

    def closest(rows: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        around = around.sort_values("child")
        centers, points = np.vstack(around["center"]), rows[columns].to_numpy(dtype=float)
        nearest, gap = np.empty(len(points), np.int64), np.empty(len(points))
        for block in blocks(len(points), len(centers)):
            far = distances(points[block], centers)
            nearest[block], gap[block] = far.argmin(axis=1), far.min(axis=1)
        return rows[["row_id", *columns]].assign(cell=around["child"].to_numpy()[nearest], gap=gap)

    sized = split.select("cell", _parts(F.col("rows"), part_rows).alias("parts"))
    dealt = open_.join(sized, "cell").withColumn("part", _part_of(F.col("parts"))).drop("parts")
    copies = pivots.select(F.col("cell").alias("child"), F.col("parent").alias("cell"), "center").join(sized, "cell")
    copies = copies.withColumn("part", _every(F.col("parts"))).drop("parts")
    return dealt.groupBy("cell", "part").cogroup(copies.groupBy("cell", "part")).applyInPandas(
        closest, schema + ", gap double")


def reaches(points: np.ndarray, bound: np.ndarray, cells: Cells, group: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For pairs of a point and a cell, by position: the cell can hold a point within the bound.

    ``group`` numbers the pairs of one point with the children of one cell, in order. Besides the
    cell's radius and ranges, its points are nearer to its pivot than to any other of these
    children: they lie beyond the middle between the pivot and the one nearest to the point.
    """
    away, outside, middle = np.zeros(len(at)), np.zeros(len(at)), np.zeros(len(at))
    for column in range(points.shape[1]):
        values = points[:, column]
        away += (values - cells.center[at, column]) ** 2
        outside += np.maximum(np.maximum(cells.low[at, column] - values, values - cells.high[at, column]), 0.0) ** 2
    near = (np.sqrt(away) - cells.radius[at] <= bound + 1e-9) & (np.sqrt(outside) <= bound)
    first = np.flatnonzero(np.diff(group, prepend=-1))
    least = np.repeat(np.minimum.reduceat(away, first), np.diff(np.append(first, len(at)))) if len(at) else away
    hit = np.flatnonzero(away == least)
    hit = hit[np.flatnonzero(np.diff(group[hit], prepend=-1))]
    nearest = np.repeat(at[hit], np.diff(np.append(first, len(at)))) if len(at) else at
    for column in range(points.shape[1]):
        middle += (cells.center[at, column] - cells.center[nearest, column]) ** 2
    # what rounding can do to the difference of two squares; equal pivots say nothing
    error = 1e-12 * (away + least)
    return near & ~(away - least - error > 2 * np.sqrt(middle) * bound)


class Cells:
    """The cells of one level, sorted by number, so that children of a cell lie together."""

    def __init__(self, frame: pd.DataFrame):
        frame = frame.sort_values("cell")
        self.cell, self.parent = frame["cell"].to_numpy(np.int64), frame["parent"].to_numpy(np.int64)
        self.center, self.low, self.high = (np.vstack(frame[c]).astype(float) for c in ("center", "low", "high"))
        self.radius, self.leaf = frame["radius"].to_numpy(float), frame["leaf"].to_numpy(bool)

    def children(self, parents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each parent its children: which parent, and the child's place here."""
        first, last = np.searchsorted(self.parent, parents, "left"), np.searchsorted(self.parent, parents, "right")
        many = last - first
        owner = np.repeat(np.arange(len(parents)), many)
        return owner, np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())


def descend(points: np.ndarray, bound: np.ndarray, levels: Sequence[Cells]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which point, which cell, whether it is a leaf: leaves within reach, and cells of the last level to go on from."""
    out = []
    for block in blocks(len(points), FAN * 4):
        own = np.arange(len(points))[block]
        cell = np.zeros(len(own), np.int64)
        for number, level in enumerate(levels):
            parent, at = level.children(cell)
            own = own[parent]
            near = reaches(points[own], bound[own], level, parent, at)
            own, at = own[near], at[near]
            done = level.leaf[at] if number < len(levels) - 1 else np.ones(len(at), bool)
            out.append((own[done], level.cell[at[done]], level.leaf[at[done]]))
            own, cell = own[~done], level.cell[at[~done]]
    return tuple(np.concatenate(x) for x in zip(*out))


def visited_cells(
    tree: PivotTree, queries: DataFrame, top_cells: int = TOP_CELLS, part_rows: int = PART_ROWS
) -> DataFrame:
    """(row_id, columns, bound, cell): every leaf that can hold a point within the bound of a query."""
    columns, kept = tree.columns, ["row_id", *tree.columns, "bound"]
    found = queries.select(*kept)
    if not tree.levels:
        return found.withColumn("cell", F.lit(0).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema) + ", cell long, leaf boolean"
    top, deep, held = [], list(tree.levels), 0
    while deep and (not top or held + (size := deep[0].count()) <= top_cells):
        held = held + size if top else deep[0].count()
        top.append(Cells(deep.pop(0).toPandas()))
    shared = tree.points.sparkSession.sparkContext.broadcast(top)

    def below(rows: pd.DataFrame, levels: Sequence[Cells]) -> pd.DataFrame:
        own, cell, leaf = descend(rows[columns].to_numpy(dtype=float), rows["bound"].to_numpy(dtype=float), levels)
        return rows[kept].iloc[own].assign(cell=cell, leaf=leaf)

    def from_root(batches):
        for rows in batches:
            if len(rows):
                yield below(rows, shared.value)

    visits = found.mapInPandas(from_root, schema)
    leaves = None
    for level in deep:
        visits = durable(visits, "tree-visits")
        here = visits.where("leaf").drop("leaf")
        leaves = here if leaves is None else leaves.unionByName(here)
        going = visits.where("not leaf").drop("leaf")
        sized = going.groupBy("cell").agg(_parts(F.count(F.lit(1)), part_rows).alias("parts"))
        dealt = going.join(sized, "cell").withColumn("part", _part_of(F.col("parts"))).drop("parts")
        children = level.withColumnRenamed("cell", "child").withColumnRenamed("parent", "cell").join(sized, "cell").withColumn(
            "part", _every(F.col("parts"))).drop("parts")

        def meet(rows: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
            if rows.empty:
                return pd.DataFrame({c: [] for c in [*kept, "cell", "leaf"]})
            cells = Cells(around.rename(columns={"cell": "parent", "child": "cell"}).assign(parent=0))
            return below(rows, [cells])

        visits = dealt.groupBy("cell", "part").cogroup(children.groupBy("cell", "part")).applyInPandas(meet, schema)
    visits = visits.drop("leaf")
    return visits if leaves is None else leaves.unionByName(visits)

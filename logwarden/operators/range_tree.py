"""A tree of cells over points of any number, built and searched by Spark jobs, level by level.

A cell with more than about ``leaf_rows`` points is cut into up to ``fan`` cells, by halving a sample of
its points again and again across its widest column; then its points are dealt among them. This
goes on until every cell is small or holds copies of one point only. Leaves keep their size
however many points there are, and the number of levels grows with the logarithm. Every cell
knows the range of its points in each column; a search goes down only into cells within its bound.

Cells are rows of a table. The first levels, up to ``top_cells`` cells, are broadcast; below them
searches and cells meet by grouping on the parent cell, in parts of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logwarden.operators.durable import durable

LEAF_ROWS = 256
FAN = 64
TOP_CELLS = 4096
#: Points of a sample for each cell that is made of it; rows of one cell that one task handles at a time.
SAMPLED, PART_ROWS = 16, 16384
#: A cut that leaves a share of one in so many on either side is as good as any.
FAIR_SHARE = 8
#: Samples halve unevenly: cells up to so many times ``leaf_rows`` are not cut again.
UNEVEN = 3
#: So many cells at most are cut by cuts that every task has; the rows of more meet their cuts by grouping.
HELD_CUTS = 4096
#: Cells are numbered by their path in a long; at this depth whatever is left stays one cell.
DEPTH = 9
# Cells of one distance block; bounds a task's memory whatever the batch size is.
_BLOCK_CELLS = 2_000_000


def blocks(rows: int, width: int) -> list[slice]:
    step = max(_BLOCK_CELLS // max(width, 1), 1)
    return [slice(start, start + step) for start in range(0, rows, step)]


@dataclass
class RangeTree:
    """Points (row_id, columns, cell, parent, alone) and the cells of each level below the root.

    ``alone`` marks points of a cell that is large although a leaf. A level has cell, parent, low,
    high, rows and leaf. The children of a cell are numbered ``cell * fan + 1`` and on; the root is 0,
    which holds ``rows`` points.
    """

    points: DataFrame
    levels: list[DataFrame]
    columns: list[str]
    rows: int
    fan: int
    leaf_rows: int


def parts_of(rows: Column, size: int) -> Column:
    return F.greatest(F.ceil(rows / size), F.lit(1)).cast("long")


def part_of(parts: Column, by: str = "row_id") -> Column:
    return F.pmod(F.xxhash64(by, F.lit(7)), parts)


def every_part(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))


def _ranges(columns: list[str]) -> list[Column]:
    return [F.array(*[f(F.col(c)) for c in columns]).cast("array<double>").alias(name)
            for name, f in (("low", F.min), ("high", F.max))]


def build_tree(
    points: DataFrame, columns: Sequence[str], leaf_rows: int = LEAF_ROWS, fan: int = FAN, part_rows: int = PART_ROWS
) -> RangeTree:
    """Cells of about ``leaf_rows`` points, UNEVEN times that at most; ``fan`` is a power of two."""
    columns, most = list(columns), UNEVEN * leaf_rows
    open_ = points.select("row_id", *columns).withColumn("cell", F.lit(0).cast("long"))
    whole = open_.agg(F.count(F.lit(1)).alias("rows"), *_ranges(columns)).first()
    if whole["rows"] <= most or whole["low"] == whole["high"]:
        big = F.lit(whole["rows"] > most)
        return RangeTree(open_.withColumns({"parent": F.lit(-1).cast("long"), "alone": big}), [], columns, whole["rows"], fan, leaf_rows)
    # All points are in the root, so there is no key to join by; unless its row is broadcast, every task pairs
    # it with the points anew.
    split = F.broadcast(points.sparkSession.createDataFrame(
        [(0, whole["rows"], whole["low"], whole["high"])], "cell long, rows long, low array<double>, high array<double>"))
    located, levels = None, []
    while True:
        # Few split cells are broadcast by their size; where they are many, none holds many of the rows.
        cuts = _cuts(open_, split, columns, leaf_rows, fan, len(levels))
        placed = durable(_dealt(open_, split, cuts, columns, fan, part_rows), "tree-cells")
        level = placed.groupBy("cell", "parent").agg(F.count(F.lit(1)).alias("rows"), *_ranges(columns))
        alone = (F.col("low") == F.col("high")) | F.lit(len(levels) + 1 >= DEPTH)
        level = durable(level.withColumn("alone", alone & (F.col("rows") > most)).withColumn(
            "leaf", F.col("alone") | (F.col("rows") <= most)), "tree-level")
        levels.append(level)
        leaves = placed.join(level.where("leaf").select("cell", "alone"), "cell").select(
            "row_id", *columns, "cell", "parent", "alone")
        located = leaves if located is None else located.unionByName(leaves)
        split = level.where("not leaf").select("cell", "rows", "low", "high")
        if split.isEmpty():
            return RangeTree(located, levels, columns, whole["rows"], fan, leaf_rows)
        open_ = placed.join(split.select("cell"), "cell", "left_semi").select("row_id", *columns, "cell")


def halved(sample: np.ndarray, low: np.ndarray, high: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns and cuts of a balanced tree over a sample, each node's children at 2i + 1 and 2i + 2.

    Values up to the cut go left. A node whose sample is all one point is cut in the middle of the
    known range at the top, so that some points surely part there; lower down it stays whole (-1).
    """
    column, cut = np.full(cells - 1, -1, np.int32), np.zeros(cells - 1)
    held = {0: sample}
    for node in range(cells - 1):
        rows = held.pop(node, None)
        if rows is None or not len(rows) or (rows.min(axis=0) == rows.max(axis=0)).all():
            if node:
                continue
            column[0] = int(np.argmax(high - low))
            cut[0] = low[column[0]] + (high[column[0]] - low[column[0]]) / 2
            if not cut[0] < high[column[0]]:
                cut[0] = low[column[0]]
            continue
        # up to the median or up to the value before it, whichever halves better; of the columns
        # that leave a fair share on either side the widest one
        ordered = np.sort(rows, axis=0)
        middle = ordered[(len(rows) - 1) // 2]
        upto, before = (rows <= middle).sum(axis=0), (rows < middle).sum(axis=0)
        lower = np.minimum(upto, len(rows) - upto) < np.minimum(before, len(rows) - before)
        share = np.where(lower, np.minimum(before, len(rows) - before), np.minimum(upto, len(rows) - upto))
        fair = np.minimum(share, len(rows) / FAIR_SHARE)
        c = int(np.lexsort((ordered[-1] - ordered[0], fair))[-1])
        column[node] = c
        cut[node] = ordered[before[c] - 1, c] if lower[c] else middle[c]
        left = rows[:, c] <= cut[node]
        held[2 * node + 1], held[2 * node + 2] = rows[left], rows[~left]
    return column, cut


def _cuts(open_: DataFrame, split: DataFrame, columns: list[str], leaf_rows: int, fan: int, depth: int) -> DataFrame:
    """(cell, dims, cuts) of each cell to be split, from a sample by key hash.

    A filter on the hash lets about twice as many rows through as the sample takes, so that no
    task sees more than a few thousand, whatever the size of a cell.
    """
    # cells of ``fan`` leaves first, then their leaves: a row finds most of its neighbours below one parent
    goal = F.when(F.col("rows") > UNEVEN * fan * leaf_rows, fan * leaf_rows).otherwise(leaf_rows)
    parts = F.least(F.lit(fan), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("rows") / goal)))).cast("int")
    span = 1 << 31
    likely = open_.join(split.withColumn("parts", F.greatest(parts, F.lit(2))), "cell").withColumn(
        "drawn", F.pmod(F.xxhash64("row_id", F.lit(depth)), F.lit(span))).where(
        F.col("drawn") * F.col("rows") <= F.lit(2.0 * span) * (F.col("parts") * SAMPLED + 32))
    number = F.row_number().over(W.partitionBy("cell").orderBy("drawn", "row_id"))
    taken = likely.withColumn("number", number).where(F.col("number") <= F.col("parts") * SAMPLED)

    def cut(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[0]
        points = rows.sort_values("number")[columns].to_numpy(dtype=float)
        dims, cuts = halved(points, np.asarray(first["low"]), np.asarray(first["high"]), int(first["parts"]))
        return pd.DataFrame({"cell": [key[0]], "dims": [dims], "cuts": [cuts]})

    return taken.groupBy("cell").applyInPandas(cut, "cell long, dims array<int>, cuts array<double>")


def _by_cell(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The cuts of some cells as arrays: cells in order, how many nodes each has, columns and cuts of the nodes."""
    frame = frame.sort_values("cell")
    nodes = np.array([len(d) for d in frame["dims"]], np.int64)
    shape = (len(frame), max(int(nodes.max(initial=1)), 1))
    dims, cuts = np.full(shape, -1, np.int32), np.zeros(shape)
    for i, (own_dims, own_cuts) in enumerate(zip(frame["dims"], frame["cuts"])):
        dims[i, :len(own_dims)], cuts[i, :len(own_cuts)] = own_dims, own_cuts
    return frame["cell"].to_numpy(np.int64), nodes, dims, cuts


def led(points: np.ndarray, cell: np.ndarray, fan: int, by_cell: tuple) -> np.ndarray:
    """The child of its cell that the cuts lead each point to."""
    cells, nodes, dims, cuts = by_cell
    own = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
    if (cells[own] != cell).any():
        raise ValueError("A cell without cuts")
    nodes, node, rows = nodes[own], np.zeros(len(cell), np.int64), np.arange(len(cell))
    while (going := node < nodes).any():
        at = np.where(going, node, 0)
        column = dims[own, at]
        right = (column >= 0) & (points[rows, np.maximum(column, 0)] > cuts[own, at])
        node = np.where(going, 2 * node + 1 + right, node)
    return cell * fan + 1 + node - nodes


def _dealt(open_: DataFrame, split: DataFrame, cuts: DataFrame, columns: list[str], fan: int, part_rows: int) -> DataFrame:
    """The rows with the child cell that the cuts lead to."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in open_.schema) + ", parent long"
    if split.count() <= HELD_CUTS:
        held = open_.sparkSession.sparkContext.broadcast(_by_cell(cuts.toPandas()))

        def follow_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                if len(rows):
                    points = np.column_stack([rows[c].to_numpy(zero_copy_only=False).astype(float) for c in columns])
                    cell = led(points, rows["cell"].to_numpy(), fan, held.value)
                    yield pa.RecordBatch.from_arrays(
                        [rows["row_id"], *[rows[c] for c in columns], pa.array(cell), rows["cell"]],
                        names=["row_id", *columns, "cell", "parent"])

        return open_.mapInArrow(follow_all, schema)

    def follow(rows: pd.DataFrame, by: pd.DataFrame) -> pd.DataFrame:
        parent = rows["cell"].to_numpy()
        cell = led(rows[columns].to_numpy(dtype=float), parent, fan, _by_cell(by.head(1)))
        return rows[["row_id", *columns]].assign(cell=cell, parent=parent)

    sized = split.select("cell", parts_of(F.col("rows"), part_rows).alias("parts"))
    dealt = open_.join(sized, "cell").withColumn("part", part_of(F.col("parts"))).drop("parts")
    copies = cuts.join(sized, "cell").withColumn("part", every_part(F.col("parts"))).drop("parts")
    return dealt.groupBy("cell", "part").cogroup(copies.groupBy("cell", "part")).applyInPandas(follow, schema)


class Cells:
    """The cells of one level, ordered so that children of a cell lie together."""

    def __init__(self, frame: pd.DataFrame):
        frame = frame.sort_values(["parent", "cell"])
        self.cell, self.parent = frame["cell"].to_numpy(np.int64), frame["parent"].to_numpy(np.int64)
        self.low, self.high = (np.vstack(frame[c]).astype(float) for c in ("low", "high"))
        self.leaf = frame["leaf"].to_numpy(bool)

    def children(self, parents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each parent its children: which parent, and the child's place here."""
        first, last = np.searchsorted(self.parent, parents, "left"), np.searchsorted(self.parent, parents, "right")
        many = last - first
        owner = np.repeat(np.arange(len(parents)), many)
        return owner, np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())

    def distance(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How far each point is from the ranges of the cell at its place, at least."""
        outside = np.zeros(len(at))
        for column in range(points.shape[1]):
            values = points[:, column]
            outside += np.maximum(np.maximum(self.low[at, column] - values, values - self.high[at, column]), 0.0) ** 2
        return np.sqrt(outside)


def descend(points: np.ndarray, bound: np.ndarray, levels: Sequence[Cells]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which point, which cell, whether it is a leaf: leaves within reach, and cells of the last level to go on from."""
    out = []
    for block in blocks(len(points), FAN * 8):
        own = np.arange(len(points))[block]
        cell = np.zeros(len(own), np.int64)
        for number, level in enumerate(levels):
            parent, at = level.children(cell)
            own = own[parent]
            near = level.distance(points[own], at) <= bound[own]
            own, at = own[near], at[near]
            done = level.leaf[at] if number < len(levels) - 1 else np.ones(len(at), bool)
            out.append((own[done], level.cell[at[done]], level.leaf[at[done]]))
            own, cell = own[~done], level.cell[at[~done]]
    return tuple(np.concatenate(x) for x in zip(*out))


def visited_cells(
    tree: RangeTree, queries: DataFrame, top_cells: int = TOP_CELLS, part_rows: int = PART_ROWS
) -> DataFrame:
    """(row_id, columns, bound, cell): every leaf that can hold a point within the bound of a query."""
    columns, kept = tree.columns, ["row_id", *tree.columns, "bound"]
    found = queries.select(*kept)
    if not tree.levels:
        return found.withColumn("cell", F.lit(0).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema) + ", cell long, leaf boolean"
    sizes = [level.count() for level in tree.levels]
    wide = max(1, sum(total <= top_cells for total in np.cumsum(sizes)))  # the first level has ``fan`` cells at most
    shared = tree.points.sparkSession.sparkContext.broadcast(
        [Cells(level.select("cell", "parent", "low", "high", "leaf").toPandas()) for level in tree.levels[:wide]])

    def below(rows: pd.DataFrame, levels: Sequence[Cells]) -> pd.DataFrame:
        own, cell, leaf = descend(rows[columns].to_numpy(dtype=float), rows["bound"].to_numpy(dtype=float), levels)
        return rows[kept].iloc[own].assign(cell=cell, leaf=leaf)

    def from_root(batches):
        for rows in batches:
            if len(rows):
                yield below(rows, shared.value)

    def meet(rows: pd.DataFrame, around: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return pd.DataFrame({c: [] for c in [*kept, "cell", "leaf"]})
        return below(rows, [Cells(around.rename(columns={"cell": "parent", "child": "cell"}).assign(parent=0))])

    visits, leaves = found.mapInPandas(from_root, schema), None
    for level in tree.levels[wide:]:
        visits = durable(visits, "tree-visits")
        here = visits.where("leaf").drop("leaf")
        leaves = here if leaves is None else leaves.unionByName(here)
        going = visits.where("not leaf").drop("leaf")
        sized = durable(going.groupBy("cell").agg(parts_of(F.count(F.lit(1)), part_rows).alias("parts")), "tree-parts")
        dealt = going.join(sized, "cell").withColumn("part", part_of(F.col("parts"))).drop("parts")
        children = level.select(F.col("cell").alias("child"), F.col("parent").alias("cell"), "low", "high", "leaf")
        children = children.join(sized, "cell").withColumn("part", every_part(F.col("parts"))).drop("parts")
        visits = dealt.groupBy("cell", "part").cogroup(children.groupBy("cell", "part")).applyInPandas(meet, schema)
    visits = visits.drop("leaf")
    return visits if leaves is None else leaves.unionByName(visits)

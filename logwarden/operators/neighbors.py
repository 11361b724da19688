"""Exact k nearest neighbours of every row, without a broadcast that grows or a cross join.

Rows are dealt to the cells of a range tree. The cells below one parent form a group of some ten
thousand rows, which one task holds. The search has three steps, each with one task per group.

1. A row's k-th distance within its own group bounds how far its true neighbours can be; the
   other groups that reach into that distance are noted. Most rows have none.
2. Rows go to the groups they noted, in parts of bounded size, and return only what lies within
   their bound, at most k rows each.
3. In their own group what came back is merged with the neighbours found there in the first step.

Within a task each cell is compared with all rows that it reaches, whichever cells they are of, so the
work is a matrix product a cell and no row is compared with cells that only others reach. Lists stay with their group: whoever works on them
next (``lof``) finds most neighbours of a row in the same task, and fetches only the *outer* ones.

Of many copies of one point only the first k + 1 by key can be anybody's neighbour, so
the others are not matched at all; see ``first_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logwarden.operators.durable import durable
from logwarden.operators.range_tree import (
    FAN, LEAF_ROWS, PART_ROWS, TOP_CELLS, UNEVEN, RangeTree, blocks, build_tree, every_part, part_of, parts_of, visited_cells)

QUERY_ROWS = 32768
CANDIDATE_ROWS = PART_ROWS
#: Neighbouring cells of a group whose range is given to every task as one.
RANGE_CELLS = 8
#: So many ranges at most are given to every task; of more, the search goes down the tree.
SHARED_RANGES = 16 * TOP_CELLS
#: Cells nearest to its own that a cell looks into for its first bound.
PROBED = 6
#: Rows found within loose bounds that a task holds before it keeps the k nearest of each point.
FOUND_ROWS = 2_000_000
#: Queries of other groups that look together at the cells any of them reaches.
CLUSTER_ROWS = 256
#: Rows of a cell that look together for the groups they reach.
REACH_ROWS = 64
#: Answers of other groups to the rows of one group that one task merges at a time.
ANSWER_ROWS = 65536
#: Singles do where they are off by this share of the squared distances in question at most.
BLUR = 0.05
# Covers the rounding of distances.
_SLACK = 1e-6


def _copies(columns: Sequence[str]) -> W:
    """Copies of a point by key. The hash goes first because rows sort by it alone, where columns of few values tie."""
    return W.partitionBy(F.xxhash64(*columns), *columns).orderBy("row_id")


def first_copies(df: DataFrame, columns: Sequence[str], copies: int) -> DataFrame:
    """The first ``copies`` rows, by key, of each distinct point.

    Spark cuts to that many per task before the shuffle, so a point that makes up a third
    of all rows costs no more than any other.
    """
    return (df.select("row_id", *columns).withColumn("_copy", F.row_number().over(_copies(columns)))
            .filter(F.col("_copy") <= copies).drop("_copy"))


class Block:
    """Rows of one group in the order of their keys, by cell, with the range of each cell."""

    def __init__(self, points: np.ndarray, cell: np.ndarray):
        if not np.isfinite(points).all():
            raise ValueError("Coordinates must be present and finite")
        self.points = points
        order = np.argsort(cell, kind="stable")
        begins = np.flatnonzero(np.r_[True, np.diff(cell[order]) != 0]) if len(order) else np.zeros(0, np.int64)
        self.members = np.split(order, begins[1:]) if len(order) else []
        if len(order):
            self.low, self.high = (f.reduceat(points[order], begins, axis=0) for f in (np.minimum, np.maximum))
        self.size = np.array([len(m) for m in self.members], np.int64)

    def rows(self, cells: np.ndarray) -> np.ndarray:
        """Places of the rows of some cells, in the order of keys."""
        return np.sort(np.concatenate([self.members[c] for c in cells]))


def outside(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How far each point is from each range, at least."""
    squared = np.zeros((len(points), len(low)))
    for column in range(points.shape[1]):
        values = points[:, column, None]
        squared += np.maximum(np.maximum(low[:, column] - values, values - high[:, column]), 0.0) ** 2
    return np.sqrt(squared)


def _between(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """How far a range is from each of some others, at least."""
    return np.sqrt((np.maximum(np.maximum(lows - high, low - highs), 0.0) ** 2).sum(axis=1))


def _reached(block: Block, points: np.ndarray, bound: np.ndarray, together: Sequence[np.ndarray]) -> np.ndarray:
    """(cell, point): whether the cell of the block reaches into the point's bound; ``together`` are the points in
    sets that lie together."""
    reach = np.zeros((len(block.members), len(points)), bool)
    for rows in together:
        held, limit = points[rows], bound[rows] + _SLACK
        some = np.flatnonzero(_between(held.min(axis=0), held.max(axis=0), block.low, block.high) <= limit.max())
        for part in blocks(len(rows), len(some)):
            near = outside(held[part], block.low[some], block.high[some]) <= limit[part, None]
            reach[some[:, None], rows[part]] = near.T
    return reach


class Centred:
    """Reference rows around their middle, for squared distances by matrix products of known error."""

    def __init__(self, reference: np.ndarray):
        self.middle = reference.mean(axis=0)
        held = reference - self.middle
        size = (held**2).sum(axis=1)
        self.largest, self.factors = size.max(), np.vstack([-2.0 * held.T, size])
        self.singles = None

    def _error(self, size: np.ndarray, single: bool) -> np.ndarray:
        if single:  # twice the bound for a sum of that many products
            return (len(self.factors) + 7) * 2.0**-23 * (size + 2.0 * self.largest)
        return 1e-13 * (size + self.largest)

    def fits_single(self, points: np.ndarray, squared: np.ndarray) -> bool:
        """Whether singles neither overflow nor blur distances of this size; they take half the time."""
        size = ((points - self.middle) ** 2).sum(axis=1).max()
        return size + self.largest < 1e30 and self._error(size, True) <= BLUR * np.median(squared)

    def single(self, points: np.ndarray, squared: np.ndarray) -> np.ndarray:
        """The same for each point and squared distance."""
        size = ((points - self.middle) ** 2).sum(axis=1)
        return (size + self.largest < 1e30) & (self._error(size, True) <= BLUR * squared)

    def squared(self, points: np.ndarray, single: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Squared distances less the points' sizes, these sizes, and what the former may be off by."""
        rows = points - self.middle
        size = (rows**2).sum(axis=1)
        rows, factors = np.column_stack([rows, np.ones(len(rows))]), self.factors
        if single:
            if self.singles is None:
                self.singles = self.factors.astype(np.float32)
            rows, factors = rows.astype(np.float32), self.singles
        return rows @ factors, size, self._error(size, single)


def kth_at_most(points: np.ndarray, own: np.ndarray, held: Centred, k: int) -> np.ndarray:
    """For each point a distance within which k of the reference rows other than its own surely lie, and hardly more."""
    for single in (held.fits_single(points, np.inf), False):
        squared, size, error = held.squared(points, single)
        squared[np.arange(len(points)), own] = np.inf
        kth = np.partition(squared, k - 1, axis=1)[:, k - 1] + size
        if not single or held.fits_single(points, kth):
            return np.sqrt(np.maximum(kth + error, 0.0)) + 2e-9


def within(
    points: np.ndarray, own: np.ndarray, bound: np.ndarray, block: Block, k: int, together: Sequence[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which point, place in the block, distance) of the rows within each point's bound, the k nearest at most.

    ``own`` is a point's own place in the block, or -1. They come by point, then by (distance, place). Each cell is
    compared with just the points that it reaches. Squared distances come from a matrix product with a known error
    (``Centred``), which is enough to find the few rows in question; those are measured exactly.
    """
    reach, bound = _reached(block, points, bound, together), bound.copy()
    found, fresh = [], 0
    for members, near in zip(block.members, reach):
        near = np.flatnonzero(near)
        if not len(near):
            continue
        held = Centred(block.points[members])
        single = held.single(points[near], bound[near] ** 2)
        for asked, use in ((near[single], True), (near[~single], False)):
            for part in blocks(len(asked), len(members)):
                asking = asked[part]
                squared, size, error = held.squared(points[asking], use)
                limit = ((bound[asking] + 2e-9) ** 2 + error - size).astype(squared.dtype)
                limit = np.nextafter(limit, limit.dtype.type(np.inf))
                at = np.flatnonzero((squared <= limit[:, None]).ravel())
                row = at // len(members)
                found.append(_measured(points, own, bound, block, asking[row], members[at - row * len(members)]))
                fresh += len(found[-1][0])
                if fresh > FOUND_ROWS:
                    # a loose bound lets very many rows in; with the k nearest of them it is no longer loose
                    found, fresh = [_nearest_of(*map(np.concatenate, zip(*found)), k)], 0
                    row, _, distance = found[0]
                    full = np.flatnonzero(row[k - 1:] == row[: max(len(row) - k + 1, 0)])
                    bound[row[full]] = np.minimum(bound[row[full]], distance[full + k - 1])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return _nearest_of(*map(np.concatenate, zip(*found)), k)


def distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Distance of each point from the other at its place, by columns in order, to nine places."""
    apart = (points - others) ** 2
    exact = np.zeros(len(apart))
    for column in range(apart.shape[1]):
        exact += apart[:, column]
    return np.round(np.sqrt(exact), 9)


def _measured(points, own, bound, block: Block, row: np.ndarray, place: np.ndarray):
    """The pairs of a point and a row of the block that lie within the point's bound, with their distance."""
    distance = distances(points[row], block.points[place])
    kept = (distance <= bound[row]) & (place != own[row])
    return row[kept], place[kept], distance[kept]


def _nearest_of(row: np.ndarray, key: np.ndarray, distance: np.ndarray, k: int):
    """The first k of each row by (distance, key)."""
    order = _stable(key)
    order = order[np.argsort(distance[order], kind="stable")]
    order = order[_stable(row[order])]
    row, key, distance = row[order], key[order], distance[order]
    begins = np.flatnonzero(np.r_[True, np.diff(row) != 0]) if len(row) else np.zeros(0, np.int64)
    rank = np.arange(len(row)) - np.repeat(begins, np.diff(np.r_[begins, len(row)]))
    return row[rank < k], key[rank < k], distance[rank < k]


def _stable(numbers: np.ndarray) -> np.ndarray:
    """The order of some numbers, equal ones as they come. Places in a block mostly fit 16 bits, which sort in linear time."""
    if len(numbers) and numbers.min() >= 0 and numbers.max() < 2**16:
        numbers = numbers.astype(np.uint16)
    return np.argsort(numbers, kind="stable")


def nearest_within(block: Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which row, place, distance) of the k nearest others of each row of the block, of all others if there are fewer."""
    bound = np.full(len(block.points), np.inf)
    for c, members in enumerate(block.members if len(bound) > k else []):
        points = block.points[members]
        near = np.argsort(_between(block.low[c], block.high[c], block.low, block.high), kind="stable")
        near = np.r_[c, near[near != c]]
        looked = max(PROBED + 1, int(np.searchsorted(np.cumsum(block.size[near]), k, "right")) + 1)
        place = block.rows(near[:looked])
        held = Centred(block.points[place])
        for part in blocks(len(members), len(place)):
            bound[members[part]] = kth_at_most(points[part], np.searchsorted(place, members[part]), held, k)
    return within(block.points, np.arange(len(bound)), bound, block, k, block.members)


def _kth(distance: np.ndarray, rows: int, k: int) -> np.ndarray:
    """The last of each row's k distances; infinite if there are fewer."""
    return distance.reshape(-1, k)[:, -1] if rows > k else np.full(rows, np.inf)


def kth_distances(block: Block, k: int) -> np.ndarray:
    """Each row's k-th distance among the others of the block; infinite if there are fewer."""
    return _kth(nearest_within(block, k)[2], len(block.points), k)


def first_bounds(points: np.ndarray, cell: np.ndarray, k: int) -> np.ndarray:
    """For each point the distance within which k others of these points lie; infinite if there are too few."""
    return kth_distances(Block(points, cell), k)


def _simple_schema(df: DataFrame, *columns: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*columns).schema)


def _matrix(table: pa.Table, columns: Sequence[str]) -> np.ndarray:
    return np.column_stack([table[c].to_numpy().astype(float) for c in columns]) if len(table) else np.zeros((0, len(columns)))


def _by_key(table: pa.Table) -> pa.Table:
    """In the order of the keys, which must differ."""
    table = table.sort_by("row_id").combine_chunks()
    keys = table["row_id"]
    if len(keys) and len(keys.unique()) != len(keys):
        raise ValueError("Row keys must be unique")
    return table


def _lists(values, rows: np.ndarray, count: int) -> pa.ListArray:
    """Values as one list per row; ``rows`` says whose each is and ascends."""
    offsets = np.searchsorted(rows, np.arange(count + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def grouped(tree: RangeTree) -> DataFrame:
    """The points with their group: the leaves below one cell, or one leaf that is large by itself.

    A cell that was cut into leaves at once is a group with all that lies below it: where some of those
    leaves came out too large and were cut again, they are no groups of their own. A group of a few
    hundred rows would bound its rows so badly that they reach most of the others.
    """
    homes = _homes(tree)
    points = tree.points if homes is None else tree.points.join(homes.withColumnRenamed("cell", "parent"), "parent", "left")
    home = F.col("parent") if homes is None else F.coalesce("home", "parent")
    group = F.when(F.col("alone"), F.col("cell")).otherwise(-1 - home)
    return points.withColumn("group", group).drop("home")


def _homes(tree: RangeTree) -> DataFrame | None:
    """(cell, home) of the cut cells that belong to the group of a cell above them."""
    most = UNEVEN * tree.fan * tree.leaf_rows
    above = tree.points.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("home"), F.lit(tree.rows <= most).alias("whole"))
    found = []
    for level in tree.levels[:-1]:  # the last level has leaves only
        cut = level.where("not leaf").select("cell", F.col("parent").alias("up"), (F.col("rows") <= most).alias("whole"))
        up = above.select(F.col("cell").alias("up"), F.when(F.col("whole"), F.col("home")).alias("home"))
        above = cut.join(up, "up").select("cell", F.coalesce("home", "cell").alias("home"), "whole")
        found.append(above.where("home <> cell").select("cell", "home"))
    return durable(reduce(DataFrame.unionByName, found), "homes") if found else None


def _ranges(tree: RangeTree) -> DataFrame:
    """(group, beside, low, high): ranges of neighbouring cells of a group. Children are numbered in the
    order of the cuts, so consecutive ones lie together; where some are no leaves, the others need not."""
    points, beside = grouped(tree), F.floor((F.col("cell") - 1) / RANGE_CELLS)
    mixed = [level.where("not leaf").select("parent").distinct().withColumn("mixed", F.lit(True)) for level in tree.levels]
    if mixed:
        points = points.join(reduce(DataFrame.unionByName, mixed), "parent", "left")
        beside = F.when(F.col("mixed"), F.col("cell")).otherwise(beside)
    ends = [F.array(*[f(F.col(c)) for c in tree.columns]).cast("array<double>").alias(n)
            for n, f in (("low", F.min), ("high", F.max))]
    return points.groupBy("group", beside.alias("beside")).agg(*ends)


def own_bounds(tree: RangeTree, k: int) -> DataFrame:
    """The points with a distance within which k other points surely lie.

    Leaves of one parent are looked at together, at most ``fan`` of bounded size. Where they hold
    too few points, the bound is infinite, and the search visits every cell.
    """
    points = grouped(tree)
    tasks = points.select("group").distinct().count()
    return _bounded(points, tree.columns, k, None, tasks).withColumn("bound", F.col("kth") + _SLACK).drop("kth", "near")


def _dealt(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """One task for about each group: left to itself Spark joins small groups to tasks by their bytes, but it is
    comparisons that take the time, and a few long tasks leave cores idle."""
    return df.repartition(max(tasks, 1), *keys)


def _bounded(points: DataFrame, columns: list[str], k: int, shared, tasks: int) -> DataFrame:
    """The points with their ``kth`` distance within the group and the ``near`` ones, by their place in the order of the
    group's keys; with the groups' ranges also which other groups the distance reaches."""
    kept = ["row_id", *columns, "cell", "group"]
    schema = _simple_schema(points, *kept) + ", kth double, near array<int>" + (", reach array<long>" if shared else "")

    def bounded(rows: pa.Table) -> pa.Table:
        rows = _by_key(rows.select(kept))
        block = Block(_matrix(rows, columns), rows["cell"].to_numpy())
        row, place, distance = nearest_within(block, k)
        kth = _kth(distance, len(rows), k)
        near = _lists(pa.array(place.astype(np.int32)), row, len(rows))
        out = rows.append_column("kth", pa.array(kth)).append_column("near", near)
        if shared is None:
            return out
        name, low, high = shared.value
        here, whose, reached = rows["group"][0].as_py(), [], []
        for c, members in enumerate(block.members):
            # in the order of their bounds, so that a few far-reaching rows do not make all look far
            members = members[np.argsort(kth[members])]
            limit = kth[members] + _SLACK
            away = _between(block.low[c], block.high[c], low, high)
            for step in np.array_split(np.arange(len(members)), -(-len(members) // REACH_ROWS)):
                some = np.flatnonzero((away <= limit[step[-1]]) & (name != here))
                for part in blocks(len(step), len(some)):
                    asking = step[part]
                    row, at = np.nonzero(outside(block.points[members[asking]], low[some], high[some]) <= limit[asking, None])
                    # ranges of one group are neighbours in ``some``, so what repeats comes in a row
                    target = name[some[at]]
                    new = np.r_[True, (np.diff(row) != 0) | (np.diff(target) != 0)][: len(row)]
                    whose.append(members[asking][row[new]])
                    reached.append(target[new])
        whose, reached = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (whose, reached))
        order = np.argsort(whose, kind="stable")
        return out.append_column("reach", _lists(pa.array(reached[order]), whose[order], len(out)))

    return _dealt(points.select(kept), tasks, "group").groupBy("group").applyInArrow(bounded, schema)


def _with_reach(tree: RangeTree, k: int, top_cells: int, query_rows: int) -> DataFrame:
    """Points with group, ``kth`` and ``reach``, written."""
    points, columns = grouped(tree), tree.columns
    groups = durable(_ranges(tree), "groups")
    tasks = groups.select("group").distinct().count()
    if groups.count() <= top_cells:
        held = groups.orderBy("group", "beside").toPandas()
        low, high = (np.vstack(held[c]).astype(float) for c in ("low", "high"))
        shared = points.sparkSession.sparkContext.broadcast((held["group"].to_numpy(np.int64), low, high))
        return durable(_bounded(points, columns, k, shared, tasks), "bounded")
    # too many groups for every task: the search goes down the tree
    bounded = durable(_bounded(points, columns, k, None, tasks), "bounds")
    visits = visited_cells(tree, bounded.withColumn("bound", F.col("kth") + _SLACK), top_cells, query_rows)
    of_cell = points.groupBy("cell").agg(F.first("group").alias("target"))
    reach = (visits.select("row_id", "cell").join(of_cell, "cell").groupBy("row_id")
             .agg(F.collect_set("target").alias("reach")))
    return durable(bounded.join(reach, "row_id", "left").withColumn(
        "reach", F.array_except(F.coalesce("reach", F.array().cast("array<long>")), F.array("group"))), "bounded")


def _from_outside(bounded: DataFrame, columns: list[str], k: int, query_rows: int) -> DataFrame:
    """(home, row_id, ids, distances): what each row finds within its bound in each other group it reaches."""
    visits = bounded.where(F.size("reach") > 0).select(
        "row_id", *columns, "kth", "cell", F.col("group").alias("home"), F.explode("reach").alias("group"))
    sized = durable(visits.groupBy("group").agg(parts_of(F.count(F.lit(1)), query_rows).alias("parts")), "parts")
    # rows of one cell ask in one part, because those that lie together look at the same cells
    asking = visits.join(F.broadcast(sized), "group").withColumn("part", part_of(F.col("parts"), "cell")).drop("parts", "cell")
    # under new names, because both sides of the cogroup come from one table
    candidates = bounded.select(*[F.col(c).alias(c) for c in ["row_id", *columns, "cell", "group"]])
    asked = (candidates.join(F.broadcast(sized), "group")
             .withColumn("part", every_part(F.col("parts"))).drop("parts"))
    key = bounded.schema["row_id"].dataType.simpleString()

    def match(queries: pa.Table, rows: pa.Table) -> pa.Table:
        rows, queries = _by_key(rows), queries.sort_by("home").combine_chunks()
        block = Block(_matrix(rows, columns), rows["cell"].to_numpy())
        points, bound = _matrix(queries, columns), queries["kth"].to_numpy()
        row, place, distance = within(points, np.full(len(points), -1), bound, block, k, clusters(points, CLUSTER_ROWS))
        some, many = np.unique(row, return_inverse=True)
        ids = rows["row_id"].combine_chunks().take(pa.array(place))
        return pa.table({
            "home": queries["home"].take(pa.array(some)), "row_id": queries["row_id"].take(pa.array(some)),
            "ids": _lists(ids, many, len(some)), "distances": _lists(pa.array(distance), many, len(some))})

    tasks = sized.agg(F.sum("parts")).first()[0] or 0
    asking, asked = (_dealt(side, tasks, "group", "part").groupBy("group", "part") for side in (asking, asked))
    return asking.cogroup(asked).applyInArrow(
        match, f"home long, row_id {key}, ids array<{key}>, distances array<double>")


def _best_answers(foreign: DataFrame, bounded: DataFrame, k: int, answer_rows: int) -> DataFrame:
    """The answers of other groups, cut to the k nearest of each row where a group gets very many of them.

    Points that nothing prunes ask every group, so what a group gets back grows with all rows. It is
    merged in parts of bounded size first; what the group's own task holds is then k a row.
    """
    got = bounded.groupBy("group").agg(F.sum(F.size("reach")).alias("answers"))
    if got.where(F.col("answers") > answer_rows).isEmpty():
        return foreign
    sized = durable(got.select(F.col("group").alias("home"), parts_of(F.col("answers"), answer_rows).alias("parts")), "answer-parts")

    def best(rows: pa.Table) -> pa.Table:
        keys = rows["row_id"].combine_chunks()
        some, ids = keys.unique(), pa.compute.list_flatten(rows["ids"]).combine_chunks()
        owner = pa.compute.index_in(keys, value_set=some).to_numpy()
        row = np.repeat(owner, pa.compute.list_value_length(rows["ids"]).to_numpy())
        back = pa.compute.sort_indices(ids).to_numpy()
        order = np.empty(len(ids), np.int64)
        order[back] = np.arange(len(ids))
        row, rank, distance = _nearest_of(row, order, pa.compute.list_flatten(rows["distances"]).to_numpy(), k)
        return pa.table({
            "home": rows["home"].slice(0, 1).take(pa.array(np.zeros(len(some), np.int64))), "row_id": some,
            "ids": _lists(ids.take(pa.array(back[rank])), row, len(some)), "distances": _lists(pa.array(distance), row, len(some))})

    parted = foreign.join(F.broadcast(sized), "home").withColumn("part", part_of(F.col("parts"))).drop("parts")
    return parted.groupBy("home", "part").applyInArrow(best, _simple_schema(foreign, *foreign.columns))


def clusters(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Places of the points in sets of at most ``size`` that lie together."""
    pending, done = [np.arange(len(points))], []
    while pending:
        rows = pending.pop()
        if len(rows) <= size:
            done += [rows] if len(rows) else []
            continue
        own = points[rows]
        order = rows[np.argpartition(own[:, np.argmax(own.max(axis=0) - own.min(axis=0))], len(rows) // 2)]
        pending += [order[: len(rows) // 2], order[len(rows) // 2:]]
    return done


def neighbor_lists(
    df: DataFrame, columns: Sequence[str], k: int, leaf_rows: int = LEAF_ROWS, fan: int = FAN,
    top_cells: int = SHARED_RANGES, query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS,
    answer_rows: int = ANSWER_ROWS,
) -> DataFrame:
    """(row_id, group, ids, distances, outer) of each row, written: its k nearest others, by (distance, key).

    ``outer`` are those of the neighbours that lie in another group. No point may occur more than
    k + 1 times (``first_copies``).
    """
    columns = list(columns)
    key = df.schema["row_id"].dataType.simpleString()
    tree = build_tree(df, columns, leaf_rows, fan, candidate_rows)
    bounded = _with_reach(tree, k, top_cells, query_rows)
    foreign = _best_answers(_from_outside(bounded, columns, k, query_rows), bounded, k, answer_rows)

    def merged(rows: pa.Table, others: pa.Table) -> pa.Table:
        rows = _by_key(rows)
        keys, points = rows["row_id"].combine_chunks(), _matrix(rows, columns)
        row = np.repeat(np.arange(len(keys)), pa.compute.list_value_length(rows["near"]).to_numpy())
        place = pa.compute.list_flatten(rows["near"]).to_numpy().astype(np.int64)
        distance, every = distances(points[row], points[place]), keys
        if len(others):
            # places of outer neighbours follow those of the group's own rows
            ids = pa.compute.list_flatten(others["ids"]).combine_chunks()
            every = pa.concat_arrays([keys, ids.cast(keys.type)])
            order = np.empty(len(every), np.int64)
            back = pa.compute.sort_indices(every).to_numpy().astype(np.int64)
            order[back] = np.arange(len(every))
            owner = pa.compute.index_in(others["row_id"], value_set=keys).to_numpy()
            asked = np.zeros(len(keys), bool)
            asked[owner] = True
            asked = asked[row]
            new, rank, apart = _nearest_of(
                np.r_[row[asked], np.repeat(owner, pa.compute.list_value_length(others["ids"]).to_numpy())],
                np.r_[order[place[asked]], order[len(keys):]],
                np.r_[distance[asked], pa.compute.list_flatten(others["distances"]).to_numpy()], k)
            row, place, distance = np.r_[row[~asked], new], np.r_[place[~asked], back[rank]], np.r_[distance[~asked], apart]
            order = np.argsort(row, kind="stable")
            row, place, distance = row[order], place[order], distance[order]
        out = place >= len(keys)
        return pa.table({
            "row_id": keys, "group": rows["group"], "ids": _lists(every.take(pa.array(place)), row, len(keys)),
            "distances": _lists(pa.array(distance), row, len(keys)),
            "outer": _lists(every.take(pa.array(place[out])), row[out], len(keys))})

    tasks = bounded.select("group").distinct().count()
    own = _dealt(bounded.select("row_id", *columns, "near", "group"), tasks, "group").groupBy("group")
    others = _dealt(foreign.withColumnRenamed("home", "group"), tasks, "group").groupBy("group")
    found = own.cogroup(others).applyInArrow(
        merged, f"row_id {key}, group long, ids array<{key}>, distances array<double>, outer array<{key}>")
    return durable(found, "neighbors")


def nearest_neighbors(
    df: DataFrame,
    columns: Sequence[str],
    k: int,
    leaf_rows: int = LEAF_ROWS,
    fan: int = FAN,
    top_cells: int = SHARED_RANGES,
    query_rows: int = QUERY_ROWS,
    candidate_rows: int = CANDIDATE_ROWS,
) -> DataFrame:
    """(row_id, neighbor_id, distance, rank): k other rows each, by (distance, key)."""
    columns, spark = list(columns), df.sparkSession
    k = min(k, df.count() - 1)
    key = df.schema["row_id"].dataType.simpleString()
    if k < 1:
        return spark.createDataFrame([], f"row_id {key}, neighbor_id {key}, distance double, rank int")
    copy = F.row_number().over(_copies(columns))
    numbered = df.select("row_id", *columns).withColumn("_copy", copy)
    lists = neighbor_lists(
        durable(first_copies(df, columns, k + 1), "points"), columns, k, leaf_rows, fan, top_cells, query_rows, candidate_rows)
    lists = lists.select("row_id", "ids", "distances")
    # A further copy has the neighbours of the last copy that is searched. Written, because in one plan with the
    # hash of all columns each column that is renamed doubles what the optimizer infers about that hash.
    beyond = durable(numbered.where(F.col("_copy") > k), "copies")
    further = beyond.where(F.col("_copy") > k + 1).drop("_copy")
    last = beyond.where(F.col("_copy") == k + 1).drop("_copy").withColumnsRenamed(
        {"row_id": "_last", **{c: f"_{c}" for c in columns}})
    same = [F.col(c) == F.col(f"_{c}") for c in columns]
    copies = further.join(last, same).select(F.col("row_id").alias("_copy"), F.col("_last").alias("row_id")).join(
        lists, "row_id").select(F.col("_copy").alias("row_id"), "ids", "distances")
    pairs = lists.unionByName(copies).select(
        "row_id", F.posexplode(F.arrays_zip("ids", "distances")).alias("_rank", "_near"))
    return pairs.select("row_id", F.col("_near.ids").alias("neighbor_id"), F.col("_near.distances").alias("distance"),
                        (F.col("_rank") + 1).alias("rank"))

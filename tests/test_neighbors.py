"""The distributed neighbour join and the exact factor against brute force."""

import numpy as np
import pandas as pd
import pytest

from logwarden.operators import neighbors, range_tree
from logwarden.operators.durable import durable
from logwarden.operators.lof import exact_lof
from logwarden.operators.neighbors import (
    _best_answers, _from_outside, _with_reach, first_bounds, first_copies, grouped, nearest_neighbors, neighbor_lists, own_bounds)
from logwarden.operators.range_tree import UNEVEN, build_tree, visited_cells
from logwarden.plans.catalog import _ready
from logwarden.plans.pipeline import model_inputs
from tests.test_detectors import brute_lof


def clustered(seed: int, copies: int) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    points = np.vstack([
        rng.normal(size=(90, 3)), rng.normal(loc=40, scale=0.1, size=(60, 3)), rng.integers(0, 3, size=(60, 3)),
        np.full((copies, 3), 7.0)])
    return pd.DataFrame(points, columns=["a", "b", "c"]).assign(row_id=rng.permutation(len(points)))


@pytest.mark.parametrize("options", [
    {}, {"leaf_rows": 33, "fan": 8}, {"leaf_rows": 8, "fan": 2, "top_cells": 1},
    {"leaf_rows": 5, "fan": 4, "top_cells": 6, "query_rows": 5, "candidate_rows": 9}])
def test_neighbors_are_exact(spark, options):
    rows, k = clustered(1, 10), 7
    frame = spark.createDataFrame(rows)
    found = nearest_neighbors(frame, ["a", "b", "c"], k, **options).toPandas()
    by_id = rows.sort_values("row_id")[["a", "b", "c"]].to_numpy()
    for row_id, own in found.groupby("row_id"):
        distance = np.round(np.sqrt(((by_id - by_id[row_id]) ** 2).sum(axis=1)), 9)
        expected = sorted((d, i) for i, d in enumerate(distance) if i != row_id)[:k]
        got = own.sort_values("rank")
        assert list(zip(got.distance, got.neighbor_id)) == expected
    assert found.row_id.nunique() == len(rows)


def test_few_rows(spark):
    two = spark.createDataFrame([(1, 0.0), (2, 3.0)], "row_id long, a double")
    assert {(r.row_id, r.neighbor_id, r.distance) for r in nearest_neighbors(two, ["a"], 5).collect()} == {
        (1, 2, 3.0), (2, 1, 3.0)}
    assert nearest_neighbors(two.limit(1), ["a"], 5).count() == 0
    assert exact_lof(two.limit(1), ["a"]).first().lof_score == -1.0


def test_exact_factor_with_many_copies(spark):
    rows = clustered(2, 100)
    frame = spark.createDataFrame(rows)
    assert first_copies(frame, ["a", "b", "c"], 21).count() < len(rows)
    got = exact_lof(frame, ["a", "b", "c"]).toPandas().sort_values("row_id").lof_score.to_numpy()
    assert got == pytest.approx(brute_lof(rows.sort_values("row_id")[["a", "b", "c"]].to_numpy(), 20))


def test_copies_of_points_with_many_columns(spark):
    rng = np.random.default_rng(3)
    points, k = np.vstack([rng.normal(size=(6, 40)), np.full((9, 40), 2.0)]), 4
    names = [f"x{i}" for i in range(40)]
    rows = spark.createDataFrame(pd.DataFrame(points, columns=names).assign(row_id=range(15)))
    found = nearest_neighbors(rows, names, k)
    # renamed columns under a hash of them all double what the optimizer infers, each one anew
    assert "xxhash64" not in found._jdf.queryExecution().analyzed().toString()
    got = found.toPandas().sort_values(["row_id", "rank"]).groupby("row_id").neighbor_id.apply(list)
    for own in range(15):
        distance = np.round(np.sqrt(((points - points[own]) ** 2).sum(axis=1)), 9)
        expected = sorted((d, i) for i, d in enumerate(distance) if i != own)[:k]
        assert got[own] == [i for _, i in expected]


def visits_per_row(spark, sf):
    scaled, names = model_inputs(_ready(spark, f"/root/testdata/{sf}"))
    points = durable(first_copies(scaled, names, 21), "points")
    tree = build_tree(points, names)
    return visited_cells(tree, own_bounds(tree, 20)).count() / points.count(), sum(l.where("leaf").count() for l in tree.levels)


def test_visits_stay_the_same_as_rows_grow(spark):
    (few, cells), (many, more_cells) = (visits_per_row(spark, sf) for sf in ("sf0.01", "sf0.1"))
    assert more_cells > 4 * cells  # cells keep their size and grow in number
    assert 1 <= few and many < 1.35 * few and many < 0.1 * more_cells


def test_cells_cover_their_points(spark):
    rows = clustered(3, 60)
    tree = build_tree(spark.createDataFrame(rows), ["a", "b", "c"], leaf_rows=10, fan=4)
    cells = pd.concat([l.toPandas() for l in tree.levels]).set_index("cell")
    points = tree.points.toPandas()
    assert sorted(points.row_id) == sorted(rows.row_id) and len(tree.levels) >= 2
    for cell, own in points.groupby("cell"):
        values, leaf = own[["a", "b", "c"]].to_numpy(), cells.loc[cell]
        assert leaf.leaf and len(own) == leaf["rows"]
        assert len(own) <= 30 or (leaf.alone and (values == values[0]).all())
        while cell:  # every cell above holds the points too
            assert (values >= cells.loc[cell].low).all() and (values <= cells.loc[cell].high).all()
            cell = cells.loc[cell].parent


def test_one_point_apart_from_many_copies(spark):
    rows = pd.DataFrame({"row_id": range(3000), "a": 1.0, "b": 2.0})
    rows.loc[1234, "a"] = 5.0
    found = nearest_neighbors(spark.createDataFrame(rows), ["a", "b"], 3, leaf_rows=16, candidate_rows=500).toPandas()
    far = found[found.row_id == 1234].sort_values("rank")
    assert far.neighbor_id.tolist() == [0, 1, 2] and (far.distance == 4.0).all()
    assert len(found) == 9000 and (found[found.row_id != 1234].distance == 0).all()


def test_first_bounds_hold_k_points():
    rng = np.random.default_rng(4)
    points, cell = rng.normal(size=(300, 4)).round(1), rng.integers(0, 12, 300)
    cell[:3] = 50  # a cell with fewer than k points
    bound = first_bounds(points, cell, 7)
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    np.fill_diagonal(distance, np.inf)
    assert (bound >= np.sort(distance, axis=1)[:, 6] - 1e-8).all() and np.isfinite(bound).all()
    assert np.isinf(first_bounds(points[:5], cell[:5], 7)).all()


def test_rows_are_sent_to_groups_not_to_cells(spark):
    rng = np.random.default_rng(5)
    names = [f"x{i}" for i in range(12)]
    frame = spark.createDataFrame(pd.DataFrame(rng.normal(size=(3000, 12)), columns=names).assign(row_id=range(3000)))
    tree = build_tree(frame, names, leaf_rows=16, fan=16)
    bounded = _with_reach(tree, 5, 4096, 1000).toPandas()
    sent, groups = bounded.reach.map(len).sum(), bounded.group.nunique()
    assert groups > 4 and 0 < sent <= 3000 * (groups - 1)
    assert 4 * sent < visited_cells(tree, own_bounds(tree, 5)).count()
    assert all(own not in reach and len(set(reach)) == len(reach) for own, reach in zip(bounded.group, bounded.reach))


def test_lists_name_the_neighbours_of_other_groups(spark):
    rows = clustered(6, 5)
    lists = neighbor_lists(spark.createDataFrame(rows), ["a", "b", "c"], 7, leaf_rows=8, fan=4).toPandas()
    group = lists.set_index("row_id").group
    assert lists.outer.map(len).sum() > 0
    for row in lists.itertuples():
        assert [i for i in row.ids if group[i] != row.group] == list(row.outer) and len(row.ids) == 7


@pytest.mark.parametrize("bad", [float("nan"), float("inf")])
def test_missing_coordinates_are_named(spark, bad):
    rows = spark.createDataFrame([(i, float(i)) for i in range(9)] + [(9, bad)], "row_id long, a double")
    with pytest.raises(Exception, match="present and finite"):
        nearest_neighbors(rows, ["a"], 2).collect()


def test_leaves_cut_again_stay_in_the_group_of_the_cell_above(spark):
    rng = np.random.default_rng(8)
    rows = pd.DataFrame(rng.normal(size=(1500, 2)), columns=["a", "b"]).assign(row_id=range(1500))
    leaf_rows, fan = 64, 8  # eight cells of 188 rows, of which those over 192 are cut again
    tree = build_tree(spark.createDataFrame(rows), ["a", "b"], leaf_rows, fan)
    points = grouped(tree).toPandas()
    assert 1500 <= UNEVEN * leaf_rows * fan and points.parent.nunique() > 1
    assert points["group"].nunique() == 1


def test_answers_of_many_groups_are_cut_before_they_meet(spark):
    """Points that nothing prunes ask every group; the answers are merged in parts, one row for each of them."""
    columns, k = [f"x{i}" for i in range(12)], 5
    rng = np.random.default_rng(3)
    frame = spark.createDataFrame(pd.DataFrame(rng.normal(size=(400, 12)), columns=columns).assign(row_id=np.arange(400)))
    tree = build_tree(frame, columns, leaf_rows=8, fan=4)
    bounded = _with_reach(tree, k, 4096, 64)
    foreign = durable(_from_outside(bounded, columns, k, 64), "foreign")
    cut = _best_answers(foreign, bounded, k, 50).toPandas()
    whole = foreign.toPandas()
    assert len(whole) > 2 * len(cut) and cut.row_id.is_unique and set(cut.row_id) == set(whole.row_id)
    assert cut.ids.map(len).max() <= k and set(zip(cut.home, cut.row_id)) == set(zip(whole.home, whole.row_id))
    by_row = [{r.row_id: (r.ids, r.distances, r.outer) for r in neighbor_lists(
        frame, columns, k, leaf_rows=8, fan=4, answer_rows=rows).collect()} for rows in (50, 10**6)]
    assert by_row[0] == by_row[1] and len(by_row[0]) == 400


def plans_of(monkeypatch, module) -> dict[str, list[str]]:
    """Plans of what the module writes, by label."""
    plans = {}

    def kept(df, label):
        plans.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return durable(df, label)

    monkeypatch.setattr(module, "durable", kept)
    return plans


def test_root_is_not_paired_with_the_points_by_every_task(spark, monkeypatch):
    plans = plans_of(monkeypatch, range_tree)
    build_tree(spark.createDataFrame(clustered(4, 30)), ["a", "b", "c"], leaf_rows=10, fan=4)
    assert plans["tree-cells"] and not any("CartesianProduct" in plan for plan in plans["tree-cells"])


def test_groups_are_not_joined_to_tasks_by_their_bytes(spark, monkeypatch):
    plans = plans_of(monkeypatch, neighbors)
    neighbor_lists(spark.createDataFrame(clustered(5, 5)), ["a", "b", "c"], 4, leaf_rows=8, fan=2)
    assert "REPARTITION_BY_NUM" in plans["bounded"][0] and plans["neighbors"][0].count("REPARTITION_BY_NUM") >= 2


@pytest.mark.parametrize("scale, shift", [(1.0, 0.0), (1e-3, 50.0), (1e6, 1e9), (1e25, 0.0)])
def test_distances_are_exact_whatever_the_singles_blur(scale, shift):
    rng, k = np.random.default_rng(6), 5
    near, far = rng.normal(size=(80, 3)), rng.normal(loc=300, size=(20, 3))
    points = np.vstack([near, far, np.full((6, 3), 7.0)]) * scale + shift
    apart = np.round(np.sqrt(((points[:, None] - points) ** 2).sum(axis=2)), 9)
    np.fill_diagonal(apart, np.inf)
    assert np.array_equal(first_bounds(points, np.arange(len(points)) // 20, k), np.sort(apart, axis=1)[:, k - 1])


def test_singles_bound_the_kth_distance(monkeypatch):
    """The bound holds in singles as in doubles, and is hardly above the distance."""
    points, k = np.random.default_rng(7).normal(size=(300, 10)), 20
    held, own = neighbors.Centred(points), np.arange(len(points))
    assert held.squared(points, True)[0].dtype == np.float32
    apart = np.sqrt(((points[:, None] - points) ** 2).sum(axis=2))
    np.fill_diagonal(apart, np.inf)
    kth = np.sort(apart, axis=1)[:, k - 1]
    for blur in (neighbors.BLUR, 0.0):
        monkeypatch.setattr(neighbors, "BLUR", blur)
        bound = neighbors.kth_at_most(points, own, held, k)
        assert (bound >= kth).all() and (bound <= kth * 1.01).all()


def test_zeros_of_either_sign_are_copies(spark):
    rows = spark.createDataFrame([(i, 0.0 if i % 2 else -0.0, 1.0) for i in range(8)], "row_id long, a double, b double")
    assert [r.row_id for r in first_copies(rows, ["a", "b"], 3).orderBy("row_id").collect()] == [0, 1, 2]


def test_a_cell_is_compared_with_the_rows_that_reach_it_alone(monkeypatch):
    """Rows of a cell that reach far to different sides do not look at each other's cells."""
    rng, compared = np.random.default_rng(9), []
    points = np.vstack([rng.normal(size=(1900, 6)), rng.normal(scale=4.0, size=(100, 6))])
    cell = np.zeros(2000, np.int64)
    for number, rows in enumerate(neighbors.clusters(points, 64)):
        cell[rows] = number
    squared = neighbors.Centred.squared
    monkeypatch.setattr(neighbors.Centred, "squared", lambda self, asking, single: (
        compared.append(len(asking) * (self.factors.shape[1])), squared(self, asking, single))[1])
    bound = first_bounds(points, cell, 10)
    apart = np.round(np.sqrt(((points[:, None] - points) ** 2).sum(axis=2)), 9)
    np.fill_diagonal(apart, np.inf)
    assert np.array_equal(bound, np.sort(apart, axis=1)[:, 9])
    assert sum(compared) < 0.9 * 2000 * 2000


def test_loose_bounds_are_cut_on_the_way(monkeypatch):
    """Very many rows within a bound are cut to the k nearest before more are looked at, with ties by key."""
    monkeypatch.setattr(neighbors, "FOUND_ROWS", 500)
    points, k = np.random.default_rng(10).integers(0, 4, size=(400, 3)).astype(float), 6
    block, own = neighbors.Block(points, np.arange(400) // 30), np.arange(400)
    apart = np.round(np.sqrt(((points[:, None] - points) ** 2).sum(axis=2)), 9)
    np.fill_diagonal(apart, np.inf)
    for bound in (np.full(400, np.inf), np.full(400, 3.0)):
        row, place, distance = neighbors.within(points, own, bound, block, k, block.members)
        for i in range(400):
            nearest = np.lexsort((own, apart[i]))[:k]
            nearest = nearest[apart[i][nearest] <= bound[i]]
            assert place[row == i].tolist() == nearest.tolist() and (distance[row == i] == apart[i][nearest]).all()


def test_rows_follow_cuts_that_every_task_has(spark, monkeypatch):
    """The rows of few cells are not exchanged to meet their cuts; the tree is the one that grouping gives."""
    frame, trees = spark.createDataFrame(clustered(11, 40)), []
    for held in (range_tree.HELD_CUTS, 0):
        monkeypatch.setattr(range_tree, "HELD_CUTS", held)
        with monkeypatch.context() as patch:
            plans = plans_of(patch, range_tree)
            tree = build_tree(frame, ["a", "b", "c"], leaf_rows=10, fan=4)
        assert all(("CoGroup" in plan) == (held == 0) for plan in plans["tree-cells"])
        trees.append(sorted(map(tuple, tree.points.select("row_id", "a", "b", "c", "cell", "parent", "alone").collect())))
        assert len(tree.levels) >= 2
    assert trees[0] == trees[1] and len(trees[0]) == len(clustered(11, 40))

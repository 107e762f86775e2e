"""Bounded rounds and center tables give what plain comparison gives, with less work or memory."""

import random

import numpy as np
import pytest

from fairtally.functions.batches import nearest_in_batch
from fairtally.operators import bounds, center_table
from fairtally.operators.kmeans import lloyd_round
from fairtally.operators.nearest import with_nearest


def clustered(rng, n, k, d, spread=1.0):
    centers = rng.normal(0, 10, (k, d))
    return centers[rng.integers(0, k, n)] + rng.normal(0, spread, (n, d)), centers


@pytest.mark.parametrize("most", [3, 400])
@pytest.mark.parametrize("d, spread", [(2, 3.0), (16, 1.0), (1, 0.0)])
def test_bounds_stay_true_and_assignments_equal(d, spread, most, monkeypatch):
    monkeypatch.setattr(bounds.Neighbourhood.of, "__defaults__", (most,))
    rng = np.random.default_rng(d)
    x, centers = clustered(rng, 500, 40, d, spread)
    x = np.round(x, 1)  # ties
    before = np.round(centers + rng.normal(0, 2, centers.shape), 1)
    own, upper, lower, _ = bounds.first_bounds(x.T, before)
    for turn in range(6):
        after = before + rng.normal(0, 2.0 / (turn + 1), before.shape) * (rng.random((len(before), 1)) < 0.7)
        after = np.round(after, 1)
        moved = np.sqrt(((after - before) ** 2).sum(axis=1))
        own, upper, lower, computed = bounds.next_bounds(x.T, own, upper, lower, moved, bounds.Neighbourhood.of(after))
        index, dist = nearest_in_batch(np.ascontiguousarray(x.T), after)
        assert (own == index).all()
        others = np.sqrt(bounds.exact(x.T, after))
        others[np.arange(len(x)), own] = np.inf
        assert (upper >= np.sqrt(dist) * (1 - 1e-8) - 1e-9).all() and (lower <= others.min(axis=1) * (1 + 1e-8) + 1e-9).all()
        before = after


def test_most_distances_are_skipped(spark):
    rng = np.random.default_rng(4)
    x, centers = clustered(rng, 6000, 1000, 64)
    start = x[rng.choice(len(x), 1000, replace=False)]  # some groups get no center, others several
    df = spark.createDataFrame([(p.tolist(),) for p in x], "features array<double>").repartition(4)
    run = bounds.bounded_kmeans(df, start, 5, tol=0.0)
    assert len(run.computed) > 4
    assert sum(run.computed) < run.full * len(run.computed) / 3
    want, _ = nearest_in_batch(np.ascontiguousarray(x.T), run.centers)
    got = {tuple(r.features): r.cluster_id for r in run.state.collect()}
    assert all(got[tuple(p)] == c for p, c in zip(x.tolist(), want))


def test_same_rounds_as_without_bounds(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([([rng.gauss(0, 5), rng.gauss(0, 5)],) for _ in range(800)], "features array<double>").persist()
    centers = np.array([[rng.gauss(0, 5), rng.gauss(0, 5)] for _ in range(25)])
    run = bounds.bounded_kmeans(df, centers, 4, tol=0.0)
    for _ in range(4):
        centers = lloyd_round(df, centers)
    assert np.allclose(run.centers, centers, atol=1e-9)
    assert bounds.bounded_kmeans(df, centers[:1], 3).centers.shape == (1, 2)
    empty = bounds.bounded_kmeans(df.limit(0), centers, 2)
    assert (empty.centers == centers).all() and empty.full == 0


@pytest.mark.parametrize("block, size", [(7, 50), (4096, 65_536)])
def test_center_table_equals_centers_in_the_plan(spark, block, size):
    rng = random.Random(block)
    points = [(i, [float(rng.randint(0, 30)), float(rng.randint(0, 30))], "x") for i in range(700)]
    centers = [[float(rng.randint(0, 30)), float(rng.randint(0, 30))] for _ in range(90)]  # ties and equal centers
    df = spark.createDataFrame(points, "id int, features array<double>, cluster string").repartition(3)
    table = spark.createDataFrame([(i, c) for i, c in enumerate(centers)], "cluster_id int, center array<double>").repartition(4)
    got = center_table.nearest_in_table(df, table, 2, block=block, size=size)
    want = with_nearest(df, centers)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_many_centers_without_a_center_in_the_plan(spark):
    table = spark.range(100_000).selectExpr("id * 3 AS cluster_id", "array(double(id), double(-id)) AS center")
    df = spark.range(50).selectExpr("array(double(id * 1999) + 0.25, double(-id * 1999)) AS features")
    found = center_table.nearest_in_table(df, table, 2)
    assert {r.cluster_id for r in found.collect()} == {3 * 1999 * i for i in range(50)}
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 2000


def test_center_table_refuses(spark):
    df = spark.createDataFrame([([1.0, None],)], "features array<double>")
    one = spark.createDataFrame([(0, [1.0, 2.0])], "cluster_id int, center array<double>")
    with pytest.raises(Exception, match="wrong dimension"):
        center_table.nearest_in_table(df, one, 2).collect()
    with pytest.raises(ValueError, match="no centers"):
        center_table.nearest_in_table(df, one.limit(0), 2)


@pytest.mark.parametrize("d, grid", [(2, True), (2, False), (3, False), (40, False)])
def test_points_skip_far_blocks_of_centers(d, grid, monkeypatch):
    rng = np.random.default_rng(d)
    x, centers = rng.uniform(0, 50, (d, 4000)), rng.uniform(0, 50, (3000, d))
    if grid:
        x, centers = np.round(x), np.round(centers)  # ties and equal centers
    ids, tiles = rng.permutation(3000) * 3, center_table._tiles(centers.T, 64)
    assert sorted(np.concatenate(tiles)) == list(range(3000)) and max(map(len, tiles)) <= 64
    low, high = (np.stack([f(centers[t], axis=0) for t in tiles], axis=1) for f in (np.min, np.max))
    pairs, nearer = [], center_table._nearer
    monkeypatch.setattr(center_table, "_nearer", lambda x, ids, *rest: (pairs.append(x.shape[1] * len(ids)), nearer(x, ids, *rest)))
    index, dist = center_table._search(x, low, high, lambda wanted: [(i, ids[tiles[i]], centers[tiles[i]]) for i in np.flatnonzero(wanted)])
    by = np.argsort(ids)
    want, want_dist = nearest_in_batch(x, centers[by])
    assert (index == ids[by][want]).all() and (dist == want_dist).all()
    assert d > 3 or sum(pairs) < 4000 * 3000 / 4


def test_center_blocks_that_several_tasks_write(spark, monkeypatch):
    monkeypatch.setattr(center_table, "PART_VALUES", 100)
    rng = np.random.default_rng(8)
    x, centers = rng.normal(0, 5, (500, 2)), np.round(rng.normal(0, 5, (400, 2)), 1)
    df = spark.createDataFrame([(p.tolist(),) for p in x], "features array<double>")
    table = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centers)], "cluster_id int, center array<double>")
    got = {tuple(r.features): (r.cluster_id, r.dist) for r in center_table.nearest_in_table(df, table, 2, block=7).collect()}
    want = nearest_in_batch(np.ascontiguousarray(x.T), centers)
    assert got == {tuple(p): (i, v) for p, i, v in zip(x.tolist(), *map(list, want))}


def test_malformed_centers_are_refused(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "features array<double>")
    for bad in ((1, [1.0]), (1, [1.0, None]), (1, [1.0, float("nan")]), (1, None), (None, [0.0, 0.0])):
        table = spark.createDataFrame([(0, [1.0, 2.0]), bad], "cluster_id int, center array<double>")
        with pytest.raises(Exception, match="wrong dimension|without an id"):
            center_table.nearest_in_table(df, table, 2).collect()

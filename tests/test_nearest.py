from __future__ import annotations

import random

import numpy as np
import pytest

from fairtally import with_nearest
from fairtally.operators import nearest as module
from fairtally.operators.nearest import _nearest_arrow, _nearest_columns
from helpers import nearest, points_frame

PATHS = {"columns": _nearest_columns, "arrow": _nearest_arrow}


@pytest.mark.parametrize("path", PATHS)
def test_ties_and_duplicates_go_to_the_lowest_index(spark, path):
    points = points_frame(spark, [((0, 0), "A"), ((1, 1), "B"), ((5, 5), "A")])
    centers = np.array([[1.0, 0.0], [0.0, 1.0], [1.0, 0.0], [5.0, 5.0], [5.0, 5.0]])
    got = PATHS[path](points, centers, "features", "cluster_id", "dist").collect()
    assert [(r.cluster_id, r.dist) for r in got] == [(0, 1.0), (0, 1.0), (3, 0.0)]


@pytest.mark.parametrize("k, d", [(1, 1), (1, 3), (3, 2), (7, 2), (5, 3)])
def test_both_paths_equal_brute_force(spark, k, d):
    rng = random.Random(k * 10 + d)
    rows = [(tuple(rng.uniform(-50, 50) for _ in range(d)), rng.choice("AB")) for _ in range(200)]
    centers = np.array([[rng.uniform(-50, 50) for _ in range(d)] for _ in range(k)])
    want = [nearest(x, centers) for x, _ in rows]
    for path in PATHS.values():
        got = path(points_frame(spark, rows), centers, "features", "cluster_id", "dist").collect()
        assert [r.cluster_id for r in got] == [i for i, _ in want]
        assert [r.dist for r in got] == pytest.approx([v for _, v in want], rel=1e-12)


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("bad", [[1.0], [1.0, 2.0, 3.0], [1.0, None], [float("nan"), 0.0], [float("inf"), 0.0], None])
def test_bad_points_fail(spark, path, bad):
    points = spark.createDataFrame([([0.0, 0.0],), (bad,)], "features array<double>")
    with pytest.raises(Exception, match="point of wrong dimension"):
        PATHS[path](points, np.array([[0.0, 0.0], [1.0, 1.0]]), "features", "cluster_id", "dist").collect()


def test_bad_centers_fail(spark):
    points = points_frame(spark, [((0, 0), "A")])
    for centers in ([], [[]], [[float("nan"), 0.0]], [[1.0, 2.0], [1.0]]):
        with pytest.raises(ValueError):
            with_nearest(points, centers)


@pytest.mark.parametrize("k", [3, 40])
def test_filter_on_the_result_computes_distances_once(spark, k):
    centers = [[float(i), float(i)] for i in range(k)]
    points = points_frame(spark, [((i, 0), "A") for i in range(5)])
    near = with_nearest(points, centers).where("cluster_id = 1")
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert module.unrolls(np.array(centers)) == (k == 3)
    assert plan.count("least(") + plan.count("nearest(") == 1
    assert near.count() == len([i for i in range(5) if nearest((i, 0), centers)[0] == 1])


def test_float_features_and_own_names(spark):
    points = spark.createDataFrame([(7, [0.5, 2.0])], "id int, v array<float>")
    got = with_nearest(points, [[0.0, 0.0], [1.0, 2.0]], "v", "who", "far").first()
    assert (got.id, got.who, got.far) == (7, 1, 0.25)

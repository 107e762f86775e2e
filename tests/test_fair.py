from __future__ import annotations

import random
import warnings

import numpy as np
import pytest

from fairtally import align_groups, fair_kmeans, fair_objective, fair_step, group_fractions, group_stats, initial_centers, kmeans, standard_objective
from fairtally.functions.arrays import group_index
from fairtally.operators import groups as module
from helpers import fair_round, points_frame
from pyspark.sql import functions as F

CENTERS = [[2.0, 2.0], [8.0, 3.0], [5.0, 9.0]]


def rows(n=400, seed=5):
    rng = random.Random(seed)
    return [((rng.gauss(5, 3), rng.gauss(5, 3)), rng.choice(["A", "A", "A", "B", "P"])) for _ in range(n)]


def test_one_round_equals_brute_force(spark):
    data = rows()
    step = fair_step(points_frame(spark, data), CENTERS)
    centers, gamma, fa, fb, x = fair_round(data, CENTERS)
    assert step.gamma == gamma
    assert (step.f_a, step.f_b) == pytest.approx((fa, fb))
    assert step.x == pytest.approx(np.array(x))
    assert step.centers == pytest.approx(np.array(centers))


def test_rounds_equal_brute_force_and_cache_is_released(spark):
    data = rows(seed=6)
    points = points_frame(spark, data)
    want = CENTERS
    for _ in range(4):
        want = fair_round(data, want)[0]
    for cache in (True, False):
        assert fair_kmeans(points, 3, 4, init=CENTERS, cache=cache) == pytest.approx(np.array(want))
    assert not points.select("features", "grp").is_cached
    assert fair_kmeans(points, 3, 0, init=CENTERS) == pytest.approx(np.array(CENTERS))


def test_cluster_without_group_b(spark):
    """Fixed values of a case worked out by hand."""
    data = [((0, 0), "A"), ((2, 0), "A"), ((4, 0), "B"), ((100, 0), "A"), ((102, 0), "A")]
    step = fair_step(points_frame(spark, data), [[1.0, 0.0], [101.0, 0.0]])
    assert step.gamma == 0.6591796875
    assert step.alpha.tolist() == [0.5, 0.5] and step.beta.tolist() == [1.0, 0.0] and step.ell.tolist() == [3.0, 0.0]
    assert step.x == pytest.approx([1.5251274581, 0.0])
    assert step.centers == pytest.approx(np.array([[2.5251274581, 0.0], [101.0, 0.0]]))


def test_empty_cluster_keeps_its_center(spark):
    data = [((0, 0), "A"), ((1, 0), "B")]
    step = fair_step(points_frame(spark, data), [[0.0, 0.0], [500.0, 500.0]])
    assert step.centers[1].tolist() == [500.0, 500.0]


def test_group_must_not_be_empty(spark):
    with pytest.raises(ValueError, match="group B"):
        fair_step(points_frame(spark, [((0, 0), "A")]), CENTERS)


@pytest.mark.parametrize("shift", [0.0, 2.5e6])
def test_statistics_paths_agree(spark, shift):
    data = [((x[0] + shift, x[1] - shift), g) for x, g in rows()]
    centers = np.array(CENTERS) + np.array([shift, -shift])
    labelled = points_frame(spark, data).repartition(3).select(
        "features", group_index(F.col("grp"), ("A", "B")).alias("g")
    ).where("g is not null")
    one = {(r.cluster_id, r.g): r for r in module._stats_columns(labelled, centers).collect()}
    two = {(r.cluster_id, r.g): r for r in module._stats_arrow(labelled, centers, 2).collect()}
    assert one.keys() == two.keys()
    for key, r in one.items():
        assert r.n == two[key].n
        assert r.mean == pytest.approx(two[key].mean, rel=1e-12)
        assert r.ss == pytest.approx(two[key].ss, rel=1e-6)


def test_fractions_sum_to_one(spark):
    shares = group_fractions(align_groups(group_stats(points_frame(spark, rows()), CENTERS))).collect()
    assert sum(r.alpha for r in shares) == pytest.approx(1) and sum(r.beta for r in shares) == pytest.approx(1)


def test_kmeans_improves_on_its_start(spark):
    points = points_frame(spark, rows())
    start, end = initial_centers(points, 4, seed=3), kmeans(points, 4, 10, seed=3)
    cost = [standard_objective(points, c).first()[0] for c in (start, end)]
    assert len(start) == len(end) == 4 and cost[1] <= cost[0] + 1e-9
    assert kmeans(points, 1, 5)[0] == pytest.approx(np.mean([x for x, _ in rows()], axis=0))


def test_fewer_centers_than_asked_for(spark):
    points = points_frame(spark, [((1, 1), "A"), ((1, 1), "B"), ((1, 1), "A")])
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        centers = fair_kmeans(points, 4, 2)
    assert 1 <= len(centers) < 4
    assert any("fewer points" in str(w.message) for w in caught)


def test_fair_centers_beat_standard_ones_on_unfair_data(spark):
    from fairtally import synth_points

    points = synth_points(spark, 2000, 4, seed=1)
    standard = kmeans(points, 4, 10, seed=1)
    fair = fair_kmeans(points, 4, 10, init=standard)
    phi = [fair_objective(points, c).first().phi for c in (standard, fair)]
    assert phi[1] < phi[0]

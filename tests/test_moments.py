"""Scatter and means of both routes, with centers near and far, and the published numbers of the round."""

from __future__ import annotations

import time

import numpy as np
import pytest

from fairtally.functions.batches import add_moments, merged_moments
from fairtally.functions.centers import centers_frame
from fairtally.operators import fair, groups, kmeans, nearest
from fairtally.plans.inputs import CENTERS, line_points


def test_merging_equals_the_whole():
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 1.0, (3, 900))
    slot = rng.integers(0, 4, 900)
    n, mean, ss = np.zeros(5, np.int64), np.zeros((5, 3)), np.zeros(5)
    for part in np.array_split(np.arange(900), 7):
        add_moments(n, mean, ss, slot[part], x[:, part])
    for s in range(4):
        own = x[:, slot == s]
        assert n[s] == own.shape[1]
        assert mean[s] == pytest.approx(own.mean(axis=1), rel=1e-14)
        assert ss[s] == pytest.approx(((own - own.mean(axis=1)[:, None]) ** 2).sum(), rel=1e-9)
    assert (n[4], ss[4]) == (0, 0)
    a, b = ((k, x[:, :k].mean(axis=1), ((x[:, :k] - x[:, :k].mean(axis=1)[:, None]) ** 2).sum()) for k in (5, 1))
    assert merged_moments(a, b)[0] == 6


@pytest.mark.parametrize("far", [0.0, 1e6, 1e8, 1e10])
def test_both_routes_agree_however_far_the_center(spark, monkeypatch, far):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 5, (600, 2))
    rows = [([float(a), float(b)], "AB"[i % 2]) for i, (a, b) in enumerate(x)]
    points = spark.createDataFrame(rows, "features array<double>, grp string").repartition(5)
    centers = [(far, 0.0), (-2e10, 7.0)]
    by_columns = {(r.cluster_id, r.g): (r.n, *r.mean, r.ss) for r in groups.group_stats(points, centers).collect()}
    monkeypatch.setattr(nearest, "UNROLL_MAX_TERMS", 0)
    by_arrow = {(r.cluster_id, r.g): (r.n, *r.mean, r.ss) for r in groups.group_stats(points, centers).collect()}
    assert by_columns.keys() == by_arrow.keys()
    for key, value in by_columns.items():
        assert by_arrow[key] == pytest.approx(value, rel=1e-9)


def test_many_centers_make_no_large_plan(spark):
    centers = np.random.default_rng(3).normal(size=(1000, 64))
    start = time.perf_counter()
    frame = centers_frame(spark, centers)
    assert time.perf_counter() - start < 1.0
    assert frame.where("cluster_id = 999").first().center == centers[999].tolist()


def test_one_cluster(spark):
    points = spark.createDataFrame([([float(i)],) for i in range(10)], "features array<double>")
    starts = {kmeans.initial_centers(points, 1, seed)[0, 0] for seed in range(8)}
    assert len(starts) > 1 and starts <= {float(i) for i in range(10)}
    assert kmeans.kmeans(points, 1, 5).tolist() == [[4.5]]


def test_lloyd_rounds_from_given_centers(spark):
    points = spark.createDataFrame([([float(v)],) for v in (0, 1, 2, 10, 11, 12)], "features array<double>")
    assert kmeans.kmeans(points, 3, 9, init=[[1.5], [2.5], [500.0]]).tolist() == [[1.0], [11.0], [500.0]]


def test_published_numbers_of_fair_rounds(spark):
    points = line_points(spark, "/root/testdata/sf0.01")
    step = fair.fair_step(points, CENTERS)
    assert step.gamma == 0.0009765625
    assert (step.f_a, step.f_b) == pytest.approx((285.658465270, 288.475126844), abs=1e-6)
    want = [(12.514404, 18.522283), (38.129089, 24.010962), (15.438218, 63.272461), (34.118018, 84.452349)]
    assert step.centers.tolist() == pytest.approx(np.array(want), abs=1e-5)
    third = fair.fair_kmeans(points, 4, 3, init=CENTERS, cache=False)
    want = [(13.373194, 19.754029), (38.668178, 27.324390), (18.335134, 60.649768), (29.104172, 88.346755)]
    assert third.tolist() == pytest.approx(np.array(want), abs=1e-5)

from __future__ import annotations

import os
import random

import pytest

from fairtally import cluster_group_sizes, compare_centers, fair_objective, standard_objective
from fairtally.operators.objectives import clustering_report
from helpers import nearest, points_frame

CENTERS = [[0.0, 0.0], [10.0, 10.0], [99.0, 99.0]]


def rows(n=300, seed=3):
    rng = random.Random(seed)
    return [((rng.uniform(0, 12), rng.uniform(0, 12)), rng.choice(["A", "A", "B", "P"])) for _ in range(n)]


def group_mean(data, centers, suffix):
    dists = [nearest(x, centers)[1] for x, g in data if g.endswith(suffix)]
    return sum(dists) / len(dists)


def test_objectives_and_sizes(spark):
    data = rows()
    points = points_frame(spark, data)
    assert standard_objective(points, CENTERS).first()[0] == pytest.approx(group_mean(data, CENTERS, ""))
    a, b = (group_mean(data, CENTERS, g) for g in "AB")
    got = fair_objective(points, CENTERS).first()
    assert (got.phi, got.delta_a, got.delta_b) == pytest.approx((max(a, b), a, b))
    sizes = {r.cluster_id: (r.na, r.nb) for r in cluster_group_sizes(points, CENTERS).collect()}
    for i in range(3):
        mine = [g for x, g in data if nearest(x, CENTERS)[0] == i]
        assert sizes[i] == (mine.count("A"), mine.count("B"))
    assert sizes[2] == (0, 0)


def test_duplicate_center_gets_no_points(spark):
    sizes = cluster_group_sizes(points_frame(spark, [((0, 0), "A")] * 3), [[0.0, 0.0], [0.0, 0.0]]).collect()
    assert sorted(map(tuple, sizes)) == [(0, 3, 0), (1, 0, 0)]


def test_report_is_consistent(spark):
    data = rows()
    points = points_frame(spark, data)
    totals, per_center = clustering_report(points, CENTERS)
    row = totals.first()
    assert (row.n, row.na, row.nb) == (len(data), sum(g == "A" for _, g in data), sum(g == "B" for _, g in data))
    assert row.delta == pytest.approx(standard_objective(points, CENTERS).first()[0])
    assert row.phi == pytest.approx(fair_objective(points, CENTERS).first().phi)
    assert [(r.i, r.center) for r in per_center.collect()] == list(enumerate(CENTERS))


def test_compare_centers(spark):
    points = points_frame(spark, rows())
    other = [[3.0, 3.0], [9.0, 2.0]]
    got = compare_centers(points, CENTERS, other).first()
    assert got.phi_standard == pytest.approx(fair_objective(points, CENTERS).first().phi)
    assert got.phi_fair == pytest.approx(fair_objective(points, other).first().phi)


def test_more_than_two_groups(spark):
    points = points_frame(spark, [((1,), "A"), ((2,), "B"), ((5,), "C")])
    assert fair_objective(points, [[0.0]], groups=("A", "B", "C")).first().phi == 25.0


def test_empty_group_or_input_fails(spark):
    points = points_frame(spark, [((0, 0), "A")])
    with pytest.raises(Exception, match="no points in group B"):
        fair_objective(points, CENTERS).collect()
    with pytest.raises(Exception, match="no points"):
        standard_objective(points.limit(0), CENTERS).collect()


# Two published outcomes on a labelled point file of 1012 lines.
GOLDEN = [
    (
        [(40.750721, -73.980436), (40.724214, -74.193689), (40.779300, -73.428700), (40.663394, -73.786612)],
        (0.002035, 0.002653),
        [(749, 209), (22, 14), (1, 1), (10, 6)],
    ),
    (
        [(40.749035, -73.984431), (40.873440, -74.192170), (40.693363, -74.178147), (40.746095, -73.830627)],
        (0.001909, 0.002407),
        [(725, 192), (7, 3), (19, 11), (31, 24)],
    ),
]


@pytest.mark.skipif("LABELLED_POINTS_CSV" not in os.environ, reason="LABELLED_POINTS_CSV names no point file")
@pytest.mark.parametrize("centers, objectives, sizes", GOLDEN)
def test_golden_outcomes(spark, centers, objectives, sizes):
    from fairtally import fair_kmeans, read_points

    points = read_points(spark, os.environ["LABELLED_POINTS_CSV"], dim=2, partitions=2)
    totals, lines = clustering_report(points, centers)
    row = totals.first()
    assert (row.n, row.na, row.nb) == (1012, 782, 230)
    assert (round(row.delta, 6), round(row.phi, 6)) == objectives
    assert [(r.na, r.nb) for r in lines.collect()] == sizes
    if centers is GOLDEN[0][0]:
        moved = fair_kmeans(points, 4, 10, init=centers)
        assert moved[0] == pytest.approx((40.735974, -73.986421), abs=1e-6)
        assert fair_objective(points, moved).first().phi == pytest.approx(0.0022757434, abs=1e-9)


def test_text_report_reads_the_points_once(spark, tmp_path):
    from fairtally.operators.reports import clustering_lines

    data = rows()
    points_frame(spark, data).write.parquet(str(tmp_path / "points"))
    report = clustering_lines(spark.read.parquet(str(tmp_path / "points")), CENTERS)
    lines = [r.line for r in report.collect()]
    assert lines[0].startswith(f"N = {len(data)}, NA = ") and lines[1].startswith("Delta(U,C) = ")
    assert lines[5] == "i = 2, center = (99.000000,99.000000), NA2 = 0, NB2 = 0"
    assert "FileScan" not in report._jdf.queryExecution().executedPlan().toString()

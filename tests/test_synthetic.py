from __future__ import annotations

import pytest

import numpy as np
from fairtally import synth_points
from fairtally.sources.synthetic import cluster_sizes
from pyspark.sql import functions as F


@pytest.mark.parametrize(
    "n, k, a, b",
    [(1000, 4, 225, 25), (1003, 4, 225, 25), (10, 4, 1, 1), (25, 1, 22, 3), (55, 1, 49, 6), (3, 5, 0, 1)],
)
def test_sizes(spark, n, k, a, b):
    assert cluster_sizes(n, k) == (a, b)
    rows = synth_points(spark, n, k).groupBy("cluster_id", "grp").count().collect()
    assert sorted((r.cluster_id, r.grp, r["count"]) for r in rows) == sorted(
        (i, g, m) for i in range(k) for g, m in (("A", a), ("B", b)) if m
    )


def test_places(spark):
    points = synth_points(spark, 5000, 5, seed=2)
    x, y = F.get("features", F.lit(0)), F.get("features", F.lit(1))
    got = {
        (r.cluster_id, r.grp): r
        for r in points.groupBy("cluster_id", "grp").agg(F.avg(x).alias("x"), F.avg(y).alias("y"), F.stddev(x).alias("s")).collect()
    }
    for i, (sx, sy) in enumerate([(1, 1), (1, -1), (-1, -1), (-1, 1), (1, 1)]):
        base = 1000 + 25000 * i
        for g, reach in (("A", base), ("B", base + 1050)):
            row = got[i, g]
            assert (row.x, row.y) == pytest.approx((sx * reach, sy * reach), abs=3)
            assert 3 < row.s < 7
    again = synth_points(spark, 5000, 5, seed=2)
    assert points.exceptAll(again).isEmpty() and not points.exceptAll(synth_points(spark, 5000, 5, seed=3)).isEmpty()


def test_noise_is_a_function_of_the_row(spark):
    few, many = (sorted(map(str, synth_points(spark, 2000, 4, seed=3, partitions=p).collect())) for p in (1, 7))
    assert few == many
    other = sorted(map(str, synth_points(spark, 2000, 4, seed=4, partitions=7).collect()))
    assert not set(few) & set(other)


def test_axes_and_seeds_are_uncorrelated(spark):
    def noise(seed):
        rows = synth_points(spark, 4000, 1, seed=seed, partitions=4).where("grp = 'A'").collect()
        xy = np.array([r.features for r in rows])
        return xy - xy.mean(axis=0)

    one, two = noise(1), noise(2)
    for shift in (0, 1, 900, 1000, 1001):
        assert abs(np.corrcoef(one[shift:, 0], one[: len(one) - shift, 1])[0, 1]) < 0.06
        assert abs(np.corrcoef(one[shift:, 0], two[: len(two) - shift, 1])[0, 1]) < 0.06
    assert one.std(axis=0) == pytest.approx([5, 5], rel=0.05)

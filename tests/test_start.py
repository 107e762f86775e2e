"""The k-means|| start: picks, independence of partitions, and the quality of what comes out."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fairtally.operators import start
from fairtally.operators.kmeans import kmeans
from fairtally.storage import held

SCHEMA = "id bigint, features array<double>"


def blobs(n, k, seed, d=2):
    rng = random.Random(seed)
    return [(i, [100.0 * (i % k) * (j == 0) + rng.gauss(0, 1) for j in range(d)]) for i in range(n)]


def lucky(key, seed, turn):
    return int(hashlib.md5(f"{key}:{seed}:{turn}".encode()).hexdigest()[:13], 16) / 16**13


def test_picks_by_hand(spark):
    rows = blobs(300, 5, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    keyed = df.select(F.col("id").cast("string").alias("key"), F.col("features").alias("x"), F.lit(1).cast("bigint").alias("w"))
    center = np.array([rows[7][1]])
    ranked = sorted(
        (lucky(i, 9, 4) / sum((a - b) ** 2 for a, b in zip(x, rows[7][1])), str(i)) for i, x in rows if x != rows[7][1]
    )
    assert [r["key"] for r in start.cost_picks(keyed, center, 12, 9, 4).collect()] == [k for _, k in ranked[:12]]


@pytest.mark.parametrize("ids", [["id"], None])
def test_same_start_under_any_partitioning(spark, ids):
    rows = blobs(400, 6, 3, d=3)
    found = []
    for n, order in ((1, 1), (7, -1), (13, 1)):
        df = spark.createDataFrame(rows[::order], SCHEMA).repartition(n)
        found.append(start.start_centers(df, 6, seed=5, ids=ids))
    assert all(np.array_equal(f, found[0]) for f in found)
    assert not np.array_equal(found[0], start.start_centers(spark.createDataFrame(rows, SCHEMA), 6, seed=6, ids=ids))


def test_one_center_in_each_separate_group(spark):
    df = spark.createDataFrame(blobs(700, 7, 2), SCHEMA).persist()
    hits = sum(sorted(np.round(start.start_centers(df, 7, seed=s, ids=["id"])[:, 0] / 100).tolist()) == list(range(7)) for s in range(10))
    assert hits == 10


def test_copies_of_a_far_point_are_found(spark):
    """Most of the cost is one point many times: by weight it is picked though its share per copy is small."""
    rows = [(i, [float(i % 50), 0.0]) for i in range(200)] + [(i, [1e6, 0.0]) for i in range(200, 1200)]
    centers = start.start_centers(spark.createDataFrame(rows, SCHEMA), 2, seed=1)
    assert 1e6 in centers[:, 0]


def test_cost_is_near_the_best(spark):
    rng = random.Random(8)
    x = np.array([[rng.gauss(0, 10), rng.gauss(0, 10)] for _ in range(600)])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(x)], SCHEMA)
    cost = lambda c: ((x[:, None] - c[None]) ** 2).sum(axis=2).min(axis=1).sum()
    best = min(cost(start.reduce_weighted(x, np.ones(len(x)), 12, s)) for s in range(3))
    assert cost(kmeans(df, 12, 20, seed=3, ids=["id"])) < 1.15 * best


def test_few_points(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0]), (3, [4.0])], SCHEMA)
    with pytest.warns(UserWarning, match="only 2 of 5"):
        assert sorted(start.start_centers(df, 5).ravel()) == [1.0, 4.0]
    assert len(start.start_centers(df, 1)) == 1
    with pytest.raises(ValueError, match="no points"):
        start.start_centers(df.where("id > 9"), 2)
    with pytest.raises(ValueError):
        start.start_centers(df, 0)


def test_held_rows_are_spread_and_let_go(spark):
    df = spark.range(100, numPartitions=1)
    with held(df) as rows:
        assert rows.is_cached and rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and rows.count() == 100
    assert not rows.is_cached and not df.is_cached
    with held(df, cache=False) as rows:
        assert rows is df

"""Positions and running sums against plain Python over the sorted rows."""

import random

import pytest
from pyspark.sql import functions as F

from fairtally.operators.ordering import numbered, prefix_reaching, running_sums

SCHEMA = "k int, v bigint, place string"


def some_rows(n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(n)]), rng.choice([None, 0, 1, 5, 9]), str(i)) for i in range(n)]


@pytest.mark.parametrize("blocks", [1, 3, 16])
def test_positions(spark, blocks):
    rows = some_rows(300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = numbered(df, F.asc_nulls_first("k"), F.col("place"), place="at", blocks=blocks).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    assert [tuple(r)[:3] for r in sorted(found, key=lambda r: r["at"])] == want
    assert sorted(r["at"] for r in found) == list(range(300))


@pytest.mark.parametrize("blocks", [1, 4])
def test_running_sums_with_nulls(spark, blocks):
    rows = [(i, v, "") for i, (_, v, _) in enumerate(some_rows(200, 2))]
    rows[0] = (0, None, "")
    df = spark.createDataFrame(rows, SCHEMA).drop("place")
    found = running_sums(df, {"s": F.col("v"), "n": F.lit(1)}, F.col("k"), blocks=blocks).orderBy("place").collect()
    total = None
    for i, r in enumerate(found):
        v = rows[i][1]
        total = total if v is None else (total or 0) + v
        assert (r["k"], r["place"], r["s"], r["n"]) == (i, i, total, i + 1)


def test_equal_keys_fill_several_blocks(spark):
    df = spark.range(4000).select(F.lit(7).alias("k"), F.lit(1).alias("v"))
    found = running_sums(df, {"s": F.col("v")}, F.col("k"), blocks=8)
    assert sorted(r["s"] for r in found.collect()) == list(range(1, 4001))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_no_window_over_all_rows(spark):
    df = spark.range(100).withColumn("v", F.col("id"))
    plan = running_sums(df, {"s": F.col("v")}, F.col("id"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "windowspecdefinition(__block" in plan


@pytest.mark.parametrize("threshold", [1, 10, 57, 10_000])
def test_prefix(spark, threshold):
    rng = random.Random(threshold)
    rows = [(i, rng.choice([None, 0, 3, 8])) for i in range(150)]
    df = spark.createDataFrame(rows, "k int, v bigint").repartition(4)
    found = prefix_reaching(df, F.col("v"), threshold, F.col("k"), blocks=5).orderBy("place").collect()
    total, want = 0, []
    for k, v in rows:
        if total >= threshold:
            break
        total += v or 0
        want.append((k, v, k, total))
    assert [tuple(r) for r in found] == want


def test_prefix_refuses(spark):
    df = spark.createDataFrame([(1, -1)], "k int, v bigint")
    with pytest.raises(ValueError):
        prefix_reaching(df, F.col("v"), 0, F.col("k"))
    with pytest.raises(Exception, match="negative weight"):
        prefix_reaching(df, F.col("v"), 5, F.col("k")).collect()


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA).drop("place")
    assert numbered(df, F.col("k")).collect() == []
    assert running_sums(df, {"s": F.col("v")}, F.col("k")).columns == ["k", "v", "place", "s"]
    assert prefix_reaching(df, F.col("v"), 3, F.col("k")).collect() == []

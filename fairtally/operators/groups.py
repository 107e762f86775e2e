"""Statistics of two groups of points inside each cluster."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairtally.functions.arrays import group_index, sqdist
from fairtally.functions.batches import add_moments, coordinates, merged_moments, nearest_in_batch
from fairtally.functions.centers import as_centers
from fairtally.operators.nearest import python_columns, unrolls, with_nearest
from fairtally.operators.objectives import TWO_GROUPS, Centers

# Groups of the first of two rounds that merge the rows of all tasks.
MERGE_PARTS = 64


def group_stats(
    points: DataFrame,
    centers: Centers,
    groups: tuple[str, ...] = TWO_GROUPS,
    features: str = "features",
    grp: str = "grp",
) -> DataFrame:
    """(cluster_id, g, n, mean, ss) per nearest center and group, in one pass.

    ``mean`` is the centroid of the group inside the cluster and ``ss`` the sum of squared
    distances to it. Every task sends at most one partial row per cluster and group, so
    a cluster that holds most of the points is no hot key.
    """
    table = as_centers(centers)
    g = group_index(F.col(grp), groups).alias("g")
    labelled = points.select(F.col(features).cast("array<double>").alias("features"), g).where(
        F.col("g").isNotNull()
    )
    return _stats_columns(labelled, table) if unrolls(table) else _stats_arrow(labelled, table, len(groups))


def _stats_columns(labelled: DataFrame, centers: np.ndarray) -> DataFrame:
    d = centers.shape[1]
    near = with_nearest(labelled, centers)
    coords = [F.get("features", F.lit(j)) for j in range(d)]
    # Central moments merge without the cancellation of sum(x^2) - n mean^2.
    parts = near.groupBy("cluster_id", "g").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(x).alias(f"m{j}") for j, x in enumerate(coords)],
        *[F.var_pop(x).alias(f"v{j}") for j, x in enumerate(coords)],
    )
    spread = F.col("v0")
    for j in range(1, d):
        spread = spread + F.col(f"v{j}")
    return parts.select(
        "cluster_id",
        "g",
        "n",
        F.array(*[F.col(f"m{j}") for j in range(d)]).alias("mean"),
        (F.col("n") * spread).alias("ss"),
    )


def _merge_moments(rows: pa.Table) -> pa.Table:
    """One row for all partial rows (n, mean, ss) of a cluster and group, merged pairwise."""
    parts = list(zip(rows.column("n").to_pylist(), map(np.array, rows.column("mean").to_pylist()), rows.column("ss").to_pylist()))
    while len(parts) > 1:
        merged = [merged_moments(x, y) for x, y in zip(parts[::2], parts[1::2])]
        parts = merged + parts[len(merged) * 2 :]
    n, mean, ss = parts[0]
    return pa.table(
        {
            "cluster_id": rows.column("cluster_id")[:1],
            "g": rows.column("g")[:1],
            "n": pa.array([n], pa.int64()),
            "mean": pa.array([mean], pa.list_(pa.float64())),
            "ss": pa.array([ss], pa.float64()),
        }
    )


def _stats_arrow(labelled: DataFrame, centers: np.ndarray, n_groups: int) -> DataFrame:
    k, d = centers.shape

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per task: count, mean and scatter around the task's own mean, one row per cluster and group."""
        slots = k * n_groups
        n = np.zeros(slots, dtype=np.int64)
        mean = np.zeros((slots, d))
        ss = np.zeros(slots)
        for batch in batches:
            x = coordinates(batch.columns[1:], d)
            index, _ = nearest_in_batch(x, centers)
            slot = index.astype(np.intp) * n_groups + batch.column(0).to_numpy(zero_copy_only=False)
            add_moments(n, mean, ss, slot, x)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((used // n_groups).astype(np.int32)),
                pa.array((used % n_groups).astype(np.int32)),
                pa.array(n[used]),
                pa.array(list(mean[used]), type=pa.list_(pa.float64())),
                pa.array(ss[used]),
            ],
            names=["cluster_id", "g", "n", "mean", "ss"],
        )

    sent = labelled.select("g", *[c.alias(f"x{j}") for j, c in enumerate(python_columns("features", d))])
    schema = "cluster_id int, g int, n bigint, mean array<double>, ss double"
    rows = sent.mapInArrow(partials, schema)
    # One row per task, cluster and group: two rounds keep a group small with very many tasks.
    some = rows.withColumn("part", F.spark_partition_id() % F.lit(MERGE_PARTS)).groupBy("cluster_id", "g", "part")
    return some.applyInArrow(_merge_moments, schema).groupBy("cluster_id", "g").applyInArrow(_merge_moments, schema)


def align_groups(stats: DataFrame) -> DataFrame:
    """(cluster_id, n_a, n_b, mean_a, mean_b, ss_a, ss_b, ell): both groups side by side.

    A group without points in a cluster takes the centroid of the other one, which makes
    the distance ``ell`` of the two centroids zero.
    """

    def pick(name: str, g: int):
        return F.max(F.when(F.col("g") == g, F.col(name)))

    wide = stats.groupBy("cluster_id").agg(
        *[
            pick(name, g).alias(f"{name}_{side}")
            for name in ("n", "mean", "ss")
            for g, side in enumerate(("a", "b"))
        ]
    )
    filled = wide.select(
        "cluster_id",
        F.coalesce("n_a", F.lit(0)).cast("bigint").alias("n_a"),
        F.coalesce("n_b", F.lit(0)).cast("bigint").alias("n_b"),
        F.coalesce("mean_a", "mean_b").alias("mean_a"),
        F.coalesce("mean_b", "mean_a").alias("mean_b"),
        F.coalesce("ss_a", F.lit(0.0)).alias("ss_a"),
        F.coalesce("ss_b", F.lit(0.0)).alias("ss_b"),
    )
    return filled.withColumn("ell", F.sqrt(sqdist(F.col("mean_a"), F.col("mean_b"))))


def group_fractions(aligned: DataFrame) -> DataFrame:
    """(cluster_id, alpha, beta): the share of each group that a cluster holds."""
    # One row per non-empty cluster, so the totals over all of them fit one task.
    rows = aligned.agg(
        F.sum("n_a").alias("a"),
        F.sum("n_b").alias("b"),
        F.collect_list(F.struct("cluster_id", "n_a", "n_b")).alias("rows"),
    )
    return rows.select("a", "b", F.explode("rows").alias("r")).select(
        F.col("r.cluster_id").alias("cluster_id"),
        (F.col("r.n_a") / F.col("a")).alias("alpha"),
        (F.col("r.n_b") / F.col("b")).alias("beta"),
    )


def fixed_terms(aligned: DataFrame) -> DataFrame:
    """One row: the part of each group's objective that moving the centers cannot change."""
    return aligned.agg(
        (F.sum("ss_a") / F.sum("n_a")).alias("fixed_a"),
        (F.sum("ss_b") / F.sum("n_b")).alias("fixed_b"),
    )

"""Counts, objectives and cluster sizes at given centers."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairtally.functions.arrays import group_index
from fairtally.functions.centers import centers_frame
from fairtally.operators.nearest import with_nearest

Centers = Sequence[Sequence[float]] | np.ndarray
TWO_GROUPS = ("A", "B")


def group_counts(points: DataFrame, groups: tuple[str, ...] = TWO_GROUPS, grp: str = "grp") -> DataFrame:
    """One row: n over all points and n<group> per group, in one pass."""
    g = group_index(F.col(grp), groups)
    return points.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(g == i).alias(f"n{name.lower()}") for i, name in enumerate(groups)],
    )


def point_dimensions(points: DataFrame, features: str = "features") -> DataFrame:
    """One row: smallest and largest point dimension."""
    size = F.size(features)
    return points.agg(F.min(size).alias("min_dim"), F.max(size).alias("max_dim"))


def _mean_or_fail(total: Column, count: Column, what: str) -> Column:
    return F.when(count > 0, total / count).otherwise(F.raise_error(F.lit(f"no points in {what}")).cast("double"))


def _largest(values: list[Column]) -> Column:
    return F.greatest(*values) if len(values) > 1 else values[0]


def standard_objective(points: DataFrame, centers: Centers, features: str = "features") -> DataFrame:
    """One row: delta, the mean squared distance to the nearest center."""
    near = with_nearest(points.select(features), centers, features)
    return near.agg(_mean_or_fail(F.sum("dist"), F.count(F.lit(1)), "the input").alias("delta"))


def fair_objective(
    points: DataFrame,
    centers: Centers,
    groups: tuple[str, ...] = TWO_GROUPS,
    features: str = "features",
    grp: str = "grp",
) -> DataFrame:
    """One row: phi, the largest group mean, and delta_<group> for every group.

    One pass for all groups; an empty group is an error.
    """
    g = group_index(F.col(grp), groups).alias("g")
    near = with_nearest(points.select(features, g).where(F.col("g").isNotNull()), centers, features)
    sums = near.agg(
        *[F.sum(F.when(F.col("g") == i, F.col("dist"))).alias(f"s{i}") for i in range(len(groups))],
        *[F.count_if(F.col("g") == i).alias(f"n{i}") for i in range(len(groups))],
    )
    deltas = sums.select(
        *[
            _mean_or_fail(F.col(f"s{i}"), F.col(f"n{i}"), f"group {name}").alias(f"delta_{name.lower()}")
            for i, name in enumerate(groups)
        ]
    )
    return deltas.select(_largest([F.col(c) for c in deltas.columns]).alias("phi"), *deltas.columns)


def cluster_summary(
    points: DataFrame,
    centers: Centers,
    groups: tuple[str, ...] = TWO_GROUPS,
    features: str = "features",
    grp: str = "grp",
) -> DataFrame:
    """(cluster_id, g, n, dist): at most K * (groups + 1) rows that give every report number."""
    g = group_index(F.col(grp), groups).alias("g")
    near = with_nearest(points.select(features, g), centers, features)
    return near.groupBy("cluster_id", "g").agg(F.count(F.lit(1)).alias("n"), F.sum("dist").alias("dist"))


def _sizes(counts: DataFrame, centers: Centers, groups: tuple[str, ...]) -> DataFrame:
    """(cluster_id, n<group>...) of (cluster_id, g, n), with a row for every center."""
    # One zero row per center instead of a join with the centers.
    zeros = counts.sparkSession.range(0, len(centers), 1, 1).select(
        F.col("id").cast("int").alias("cluster_id"), F.lit(None).cast("int").alias("g"), F.lit(0).cast("bigint").alias("n")
    )
    return (
        counts.select("cluster_id", "g", "n")
        .unionByName(zeros)
        .groupBy("cluster_id")
        .agg(
            *[
                F.coalesce(F.sum(F.when(F.col("g") == i, F.col("n"))), F.lit(0)).alias(f"n{name.lower()}")
                for i, name in enumerate(groups)
            ]
        )
    )


def cluster_group_sizes(
    points: DataFrame,
    centers: Centers,
    groups: tuple[str, ...] = TWO_GROUPS,
    features: str = "features",
    grp: str = "grp",
) -> DataFrame:
    """(cluster_id, n<group>...), zero for a center without points of the group."""
    g = group_index(F.col(grp), groups).alias("g")
    near = with_nearest(points.select(features, g).where(F.col("g").isNotNull()), centers, features)
    counted = near.groupBy("cluster_id", "g").agg(F.count(F.lit(1)).alias("n"))
    return _sizes(counted, centers, groups)


def report_of(
    summary: DataFrame, centers: Centers, groups: tuple[str, ...] = TWO_GROUPS
) -> tuple[DataFrame, DataFrame]:
    """(totals, per center) of a ``cluster_summary``: one row n, n<group>, delta, phi; and
    i, center, n<group>."""

    def group_sum(column: str, i: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("g") == i, F.col(column))), F.lit(0))

    names = [f"n{name.lower()}" for name in groups]
    sums = summary.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.sum("dist").alias("dist"),
        *[group_sum("n", i).alias(c) for i, c in enumerate(names)],
        *[group_sum("dist", i).alias(f"s{i}") for i in range(len(groups))],
    )
    deltas = [_mean_or_fail(F.col(f"s{i}"), F.col(c), f"group {groups[i]}") for i, c in enumerate(names)]
    totals = sums.select(
        "n",
        *names,
        _mean_or_fail(F.col("dist"), F.col("n"), "the input").alias("delta"),
        _largest(deltas).alias("phi"),
    )
    # K rows on either side.
    placed = _sizes(summary, centers, groups).join(centers_frame(summary.sparkSession, centers), "cluster_id")
    lines = placed.select(F.col("cluster_id").alias("i"), "center", *names).orderBy("i")
    return totals, lines


def clustering_report(
    points: DataFrame,
    centers: Centers,
    groups: tuple[str, ...] = TWO_GROUPS,
    features: str = "features",
    grp: str = "grp",
) -> tuple[DataFrame, DataFrame]:
    """``report_of`` the points. Fetches the summary, at most K * (groups + 1) rows, so that
    both frames together read the points once."""
    summary = cluster_summary(points, centers, groups, features, grp)
    fetched = points.sparkSession.createDataFrame(summary.collect(), summary.schema)
    return report_of(fetched, centers, groups)


def compare_centers(
    points: DataFrame,
    standard: Centers,
    fair: Centers,
    groups: tuple[str, ...] = TWO_GROUPS,
    features: str = "features",
    grp: str = "grp",
) -> DataFrame:
    """One row: phi_standard and phi_fair, both from one pass over the points.

    Center sets are compared by objective only; their indices need not correspond.
    """
    g = group_index(F.col(grp), groups).alias("g")
    near = points.select(features, g).where(F.col("g").isNotNull())
    near = with_nearest(near, standard, features, "__cs", "ds")
    near = with_nearest(near, fair, features, "__cf", "df")
    sums = near.agg(
        *[F.count_if(F.col("g") == i).alias(f"n{i}") for i in range(len(groups))],
        *[F.sum(F.when(F.col("g") == i, F.col("ds"))).alias(f"ds{i}") for i in range(len(groups))],
        *[F.sum(F.when(F.col("g") == i, F.col("df"))).alias(f"df{i}") for i in range(len(groups))],
    )

    def phi(kind: str) -> Column:
        return _largest(
            [
                _mean_or_fail(F.col(f"{kind}{i}"), F.col(f"n{i}"), f"group {name}")
                for i, name in enumerate(groups)
            ]
        )

    return sums.select(phi("ds").alias("phi_standard"), phi("df").alias("phi_fair"))

"""Array and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sqdist(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two ``array<double>`` columns of one size."""
    return F.when(
        F.size(a) == F.size(b),
        F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, t: s + t),
    ).otherwise(F.raise_error(F.lit("points of different dimension")).cast("double"))


def middle(values: list[Column]) -> Column:
    """Median of a fixed list of bigint columns; an even list rounds the half upwards."""
    ordered = F.sort_array(F.array(*values))
    mid = len(values) // 2
    if len(values) % 2:
        return F.get(ordered, F.lit(mid))
    # Arithmetic shift: floor((lo + hi + 1) / 2), exact for negative sums too.
    return F.shiftright(F.get(ordered, F.lit(mid - 1)) + F.get(ordered, F.lit(mid)) + F.lit(1), 1)


def group_index(grp: Column, groups: tuple[str, ...]) -> Column:
    """Position of the group whose name ends the label, null for labels of no group."""
    for g in groups:
        if any(o != g and o.endswith(g) for o in groups) or groups.count(g) > 1:
            raise ValueError(f"group names overlap: {groups}")
    index = F.when(F.endswith(grp, F.lit(groups[0])), F.lit(0))
    for i, g in enumerate(groups[1:], start=1):
        index = index.when(F.endswith(grp, F.lit(g)), F.lit(i))
    return index

"""The results as text lines for people to read, six decimals for every objective."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairtally.operators.objectives import TWO_GROUPS, Centers, clustering_report
from fairtally.operators.sketch import Sketch, heavy_hitters, sketch_report

# The wording of the lines is a fixed output format.


def _lines(row: DataFrame, lines: list[Column]) -> DataFrame:
    """One row with numbers to numbered text lines."""
    numbered = F.array(*[F.struct(F.lit(i).alias("line_no"), t.alias("line")) for i, t in enumerate(lines)])
    return row.select(F.inline(numbered))


def clustering_lines(
    points: DataFrame, centers: Centers, groups: tuple[str, ...] = TWO_GROUPS, features: str = "features", grp: str = "grp"
) -> DataFrame:
    """(line_no, line): counts, both objectives, and one line per center."""
    totals, per_center = clustering_report(points, centers, groups, features, grp)
    counts = ["N = %d"] + [f"N{g} = %d" for g in groups]
    head = _lines(
        totals,
        [
            F.format_string(", ".join(counts), "n", *[f"n{g.lower()}" for g in groups]),
            F.format_string("Delta(U,C) = %.6f", "delta"),
            F.format_string(f"Phi({','.join(groups)},C) = %.6f", "phi"),
        ],
    )
    place = F.concat_ws(",", F.transform("center", lambda v: F.format_string("%.6f", v)))
    sizes = [F.format_string(f"N{g}%d = %d", "i", f"n{g.lower()}") for g in groups]
    text = F.concat_ws(", ", F.format_string("i = %d", "i"), F.concat(F.lit("center = ("), place, F.lit(")")), *sizes)
    body = per_center.select((F.col("i") + 3).alias("line_no"), text.alias("line"))
    return head.unionByName(body).orderBy("line_no")


def stream_lines(freq: DataFrame, sketch: Sketch, k: int, list_items: bool = True) -> DataFrame:
    """(line_no, line): length, distinct items, heavy hitters and errors, then every heavy
    hitter by item unless ``list_items`` is off."""
    head = _lines(
        sketch_report(freq, sketch, k),
        [
            F.format_string("Number of processed items = %d", "n"),
            F.format_string("Number of distinct items = %d", "n_distinct"),
            F.format_string("Number of Top-K heavy hitters = %d", "n_topk"),
            F.format_string("Avg Relative Error for Top-K Heavy Hitters with CM = %.6f", "err_cm"),
            F.format_string("Avg Relative Error for Top-K Heavy Hitters with CS = %.6f", "err_cs"),
        ],
    ).select("line_no", F.lit(None).cast("bigint").alias("item"), "line")
    if not list_items:
        return head.orderBy("line_no").drop("item")
    text = F.format_string("Item %d True Frequency = %d Estimated Frequency with CM = %d", "item", "cnt", "cm_est")
    body = heavy_hitters(freq, sketch, k).select(F.lit(5).alias("line_no"), "item", text.alias("line"))
    return head.unionByName(body).orderBy("line_no", "item").drop("item")

"""Count-Min and Count sketches as tables of cells.

A sketch is a DataFrame (r, c, cm, cs) with at most depth * width rows: ``cm`` counts the
items that fall into a cell, ``cs`` sums their signs. Both are linear, so sketches of parts
add up to the sketch of the whole and can be built from item counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairtally.functions.arrays import middle
from fairtally.functions.hashing import HashFamily
from fairtally.operators.frequency import required_item, top_k_with_ties


@dataclass(frozen=True)
class Sketch:
    cells: DataFrame
    hashes: HashFamily

    def merge(self, *others: Sketch) -> Sketch:
        return merge_sketches(self, *others)


def sketch_cells(items: DataFrame, hashes: HashFamily, item: str = "item", weight: str | None = None) -> DataFrame:
    """(r, c, cm, cs) of a batch or streaming DataFrame; empty cells are left out."""
    keep = [required_item(item).alias("item")] + ([F.col(weight).alias("w")] if weight else [])
    base = items.select(*keep)
    probes = F.inline(hashes.probes(F.col("item")))
    if weight is None:
        rows = base.select(probes)
        return rows.groupBy("r", "c").agg(F.count(F.lit(1)).alias("cm"), F.sum("sign").alias("cs"))
    rows = base.select("w", probes)
    return rows.groupBy("r", "c").agg(
        F.sum("w").alias("cm"), F.sum(F.col("w") * F.col("sign")).alias("cs")
    )


def build_sketch(items: DataFrame, hashes: HashFamily, item: str = "item", weight: str | None = None) -> Sketch:
    """Sketch of raw items, or of distinct items with their counts in ``weight``."""
    return Sketch(sketch_cells(items, hashes, item, weight), hashes)


def add_cells(cells: DataFrame) -> DataFrame:
    return cells.groupBy("r", "c").agg(F.sum("cm").alias("cm"), F.sum("cs").alias("cs"))


def merge_sketches(*sketches: Sketch) -> Sketch:
    """Cell-wise sum; all sketches must share shape and coefficients."""
    if not sketches:
        raise ValueError("nothing to merge")
    if any(s.hashes != sketches[0].hashes for s in sketches):
        raise ValueError("sketches of different shape or hash functions cannot be merged")
    cells = sketches[0].cells.select("r", "c", "cm", "cs")
    for s in sketches[1:]:
        cells = cells.unionByName(s.cells.select("r", "c", "cm", "cs"))
    return Sketch(add_cells(cells), sketches[0].hashes)


def with_estimates(items: DataFrame, sketch: Sketch, item: str = "item") -> DataFrame:
    """Add cm_est, the smallest cell of the item, and cs_est, the median of its signed cells.

    One join of the items' cells with the sketch, whose form Spark picks from the real sizes. All
    columns of the items are group keys: counts stay in the plan, so that items and sketch made
    from the same counts share their one shuffle. Equal rows come back as often as they came.
    """
    depth, columns = sketch.hashes.depth, items.columns
    probes = items.select(*[F.col(c).alias(f"__{c}") for c in columns], F.inline(sketch.hashes.probes(F.col(item))))
    hit = probes.join(sketch.cells.select("r", "c", "cm", "cs"), ["r", "c"], "left")
    signed = F.col("sign") * F.coalesce("cs", F.lit(0))
    per_row = hit.groupBy(*[f"__{c}" for c in columns]).agg(
        F.min(F.coalesce("cm", F.lit(0))).alias("cm_est"),
        *[F.max(F.when(F.col("r") == i, signed)).alias(f"__s{i}") for i in range(depth)],
        F.count(F.lit(1)).alias("__n"),
    )
    copies = F.explode(F.sequence(F.lit(1), (F.col("__n") / depth).cast("int")))
    return per_row.select(
        *[F.col(f"__{c}").alias(c) for c in columns],
        "cm_est",
        middle([F.col(f"__s{i}") for i in range(depth)]).alias("cs_est"),
        copies.alias("__copy"),
    ).drop("__copy")


def estimate_cm(items: DataFrame, sketch: Sketch, item: str = "item") -> DataFrame:
    """(item, est) with the Count-Min estimate, never below the true count."""
    return with_estimates(items, sketch, item).select(F.col(item).alias("item"), F.col("cm_est").alias("est"))


def estimate_cs(items: DataFrame, sketch: Sketch, item: str = "item") -> DataFrame:
    """(item, est) with the Count sketch estimate."""
    return with_estimates(items, sketch, item).select(F.col(item).alias("item"), F.col("cs_est").alias("est"))


def heavy_hitters(freq: DataFrame, sketch: Sketch, k: int) -> DataFrame:
    """(item, cnt, cm_est, cs_est) of the true top-k with ties."""
    return with_estimates(top_k_with_ties(freq, k), sketch)


def _error(estimate: str) -> Column:
    return F.avg(F.abs(F.col("cnt") - F.col(estimate)) / F.col("cnt"))


def topk_error(freq: DataFrame, sketch: Sketch, k: int) -> DataFrame:
    """One row: mean relative error of both estimates over the true top-k."""
    return heavy_hitters(freq, sketch, k).agg(
        _error("cm_est").alias("err_cm"), _error("cs_est").alias("err_cs")
    )


def sketch_report(freq: DataFrame, sketch: Sketch, k: int) -> DataFrame:
    """One row: n, n_distinct, n_topk, err_cm, err_cs."""
    top = heavy_hitters(freq, sketch, k).agg(
        F.struct(
            F.count(F.lit(1)).alias("n_topk"), _error("cm_est").alias("err_cm"), _error("cs_est").alias("err_cs")
        ).alias("top")
    )
    whole = freq.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("n_distinct"))
    return whole.select("n", "n_distinct", top.scalar().alias("top")).select("n", "n_distinct", "top.*")

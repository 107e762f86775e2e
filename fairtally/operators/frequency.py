"""Exact item frequencies and heavy hitters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def required_item(name: str) -> Column:
    """The item as bigint; a missing item is an error."""
    return F.coalesce(
        F.col(name).cast("bigint"), F.raise_error(F.lit("missing item")).cast("bigint")
    )


def item_frequencies(items: DataFrame, item: str = "item") -> DataFrame:
    """(item, cnt). Works on batch and streaming DataFrames."""
    return items.select(required_item(item).alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("cnt"))


def merge_frequencies(*parts: DataFrame) -> DataFrame:
    """(item, cnt) summed over any number of (item, cnt) tables."""
    if not parts:
        raise ValueError("nothing to merge")
    merged = parts[0].select("item", "cnt")
    for part in parts[1:]:
        merged = merged.unionByName(part.select("item", "cnt"))
    return merged.groupBy("item").agg(F.sum("cnt").alias("cnt"))


def top_k_with_ties(freq: DataFrame, k: int) -> DataFrame:
    """Rows of (item, cnt) whose count is at least the k-th largest count.

    The k-th largest count comes from a per-task top-k, not from a sort of all items;
    fewer than k items are all returned.
    """
    if k < 1:
        raise ValueError("k must be positive")
    kth = freq.select("cnt").orderBy(F.desc("cnt")).limit(k).agg(F.min("cnt").alias("kth"))
    return freq.where(F.col("cnt") >= kth.scalar())

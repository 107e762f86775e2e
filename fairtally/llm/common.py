"""What several operators share: written tables, word splitting, connected components."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairtally.storage import scratch_dir

# Tasks get these functions with the query, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written once below ``spark.checkpoint.dir`` and read back: lineage ends here."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that later lambdas may read element by element.

    The one-row generator keeps Spark from merging this projection into later ones, where the
    array would be computed again for each element.
    """
    one = F.explode_outer(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))).alias("_one")
    return df.select("*", one).select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_one.{n}").alias(n) for n in columns])


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def remainder(column: str, n: int) -> Column:
    """crc32 of the value as text, modulo n; a null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def batched(function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]):
    """A mapInArrow function out of one that turns a batch into batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return run


def slices(batch: pa.RecordBatch, column: str, most_bytes: int, most_rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most_bytes`` of a text column each, at least one row and at most ``most_rows``."""
    start = used = 0
    for i, value in enumerate(batch.column(column)):
        size = len(value.as_buffer()) if value.is_valid else 0
        if i > start and (used + size > most_bytes or i - start == most_rows):
            yield batch.slice(start, i - start)
            start, used = i, 0
        used += size
    if start < batch.num_rows:
        yield batch.slice(start)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame | None:
    """(node, component): the smallest node reachable from every node of an edge ``(a, b)``; None without edges.

    Alternating large-star and small-star rounds over the edge table: every round is two
    partially aggregated minima and two joins that Spark may split where a node has very many
    neighbours; the table of each round is written, so no lineage grows and nothing but two
    numbers reaches the driver. Null ends and loops are left out.
    """
    ends = edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    now = stored(ends.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), label)
    before, state = None, _state(now)
    if not state[0]:
        return None
    while state != before:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = stored(small.union(least.select("hi", F.col("m").alias("lo"))).distinct(), label)
        before, state = state, _state(now)
    # Now every node but the smallest of its component has one edge, to the smallest.
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(now.select("lo", "lo").distinct())

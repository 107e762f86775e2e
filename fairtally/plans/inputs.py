"""The given tables as points, items and documents, and the parameters of the queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairtally.functions.hashing import HashFamily

CENTERS = ((10.0, 15.0), (40.0, 20.0), (15.0, 60.0), (42.0, 80.0))
GRID = tuple((float(x), float(y)) for x in (5, 15, 25, 35, 45) for y in (8, 24, 40, 56, 72, 88))
HASHES = HashFamily(width=16, a=(17, 101, 2003), b=(5, 42, 1234), sign_a=(3, 7, 11), sign_b=(1, 0, 5))
EVEN_HASHES = HashFamily(
    width=64, a=(17, 101, 2003, 911), b=(5, 42, 1234, 77), sign_a=(3, 7, 11, 13), sign_b=(1, 0, 5, 2)
)
TOP_K = 5
STREAM_CHUNKS = 4
VECTOR_CENTERS = 4
LINE_KEYS = ("l_orderkey", "l_linenumber")
START_SEED, START_PICKS = 1, 40
# Line numbers of lineitem.
SEPARATE_GROUPS = 7
SYNTH_SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_points(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """lineitem: quantity and price in thousands; open lines are group B, all others A."""
    return table(spark, sf_dir, "lineitem").select(
        *keys,
        F.array(F.col("l_quantity"), F.col("l_extendedprice") / 1000).alias("features"),
        F.when(F.col("l_linestatus") == "F", "A").otherwise("B").alias("grp"),
    )


def separate_points(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """lineitem: line numbers far apart, so the best clusters are known: the rows of each line number."""
    return table(spark, sf_dir, "lineitem").select(
        *keys,
        F.array(F.col("l_linenumber") * 1000 + F.col("l_quantity"), F.col("l_extendedprice") / 1000).alias("features"),
        F.when(F.col("l_linestatus") == "F", "A").otherwise("B").alias("grp"),
    )


def order_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders: one coordinate; pending orders (P) are in neither group."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.array("o_totalprice").alias("features"),
        F.when(status == "F", "A").when(status == "O", "B").otherwise(status).alias("grp"),
    )


def vector_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("embedding").cast("array<double>").alias("features"),
        F.when(F.col("label") < 8, "A").otherwise("B").alias("grp"),
    )


def vector_centers(spark: SparkSession, sf_dir: str) -> np.ndarray:
    """The vectors with the lowest ids serve as centers; all vectors are assigned to them."""
    rows = (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
        .orderBy("vec_id")
        .limit(VECTOR_CENTERS)
        .collect()
    )
    return np.array([r.v for r in rows])


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("item"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("text")

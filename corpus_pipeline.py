"""The corpus pipeline: the stages that turn ``documents`` into packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fairtally.llm import stages
from fairtally.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES: list[tuple[str, Stage]] = [
    ("language_id", stages.language_id),
    ("quality_rules", stages.quality_rules),
    ("minhash_near_dedup", stages.minhash_near_dedup),
    ("mixing", stages.mixing),
    ("best_fit_packing", stages.best_fit_packing),
]

#: Centroids, expectation-maximisation, MinHash and packing have no SQL form: tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs

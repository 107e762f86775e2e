"""The stages of the corpus pipeline: each applies one operator to all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairtally.llm import langid, minhash, packing, quality
from fairtally.llm import mixing as mixture


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, with ``lang`` as predicted; rejected ones go."""
    found = langid.identify(docs, langid.fit(docs), keep_row=True)
    known = found.where((F.col("lang_pred") != langid.UNKNOWN) & ~F.col("rejected"))
    return known.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"row.{c}").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are good text with a probability of at least one half."""
    judged = quality.judge_quality(docs, keep_row=True)
    return judged.where("kept").select(*[F.col(f"row.{c}").alias(c) for c in docs.columns])


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates on shingles of five words, similarity 0.8 or more."""
    return minhash.drop_duplicates(docs, shingle=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen for the mixture, repeated once for each epoch that takes them."""
    return mixture.mixed_documents(docs, mixture.default_tree(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the chosen documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs)

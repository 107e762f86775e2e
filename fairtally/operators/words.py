"""Word counts."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairtally.functions.text import fields, utf16_length

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Distinct words that a task holds before it sends its counts on and starts anew.
LOCAL_WORDS = 500_000


def words(docs: DataFrame, column: str = "value") -> DataFrame:
    """One row per word occurrence; words are separated by single blanks."""
    return docs.select(F.explode(fields(F.col(column), " ")).alias("word"))


def _counts_of(counted: Counter) -> pa.RecordBatch:
    return pa.record_batch({"word": pa.array(counted.keys(), pa.string()), "cnt": pa.array(counted.values(), pa.int64())})


def _local_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counted: Counter = Counter()
    for batch in batches:
        values, counts = pc.value_counts(batch.column("word")).flatten()
        counted.update(dict(zip(values.to_pylist(), counts.to_pylist())))
        if len(counted) >= LOCAL_WORDS:
            yield _counts_of(counted)
            counted.clear()
    if counted:
        yield _counts_of(counted)


def partition_counts(docs: DataFrame, column: str = "value") -> DataFrame:
    """(word, cnt) per partition, without any shuffle: each task counts the words of its own documents.

    A word has one row per partition, or a few where a partition holds very many distinct words.
    """
    return words(docs, column).mapInArrow(_local_counts, "word string, cnt bigint")


def word_counts(
    docs: DataFrame, column: str = "value", salt: int | None = None, by_partition: bool = False
) -> DataFrame:
    """(word, cnt).

    By default one aggregate: every task counts its own words before the shuffle, so a
    frequent word sends one row per task. ``salt`` spreads these rows of one word over that
    many first-round groups; a second round adds them up. The salt is the task's partition number,
    which stays the same when a lost task runs again; a random salt would not. ``by_partition``
    counts each partition on its own first (``partition_counts``) and adds those counts up.
    """
    if salt is not None and by_partition:
        raise ValueError("choose salt or by_partition")
    if by_partition:
        return partition_counts(docs, column).groupBy("word").agg(F.sum("cnt").alias("cnt"))
    rows = words(docs, column)
    if salt is not None:
        if salt < 1:
            raise ValueError("salt must be positive")
        rows = rows.withColumn("salt", F.spark_partition_id() % F.lit(salt))
    else:
        return rows.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    partial = rows.groupBy("word", "salt").agg(F.count(F.lit(1)).alias("cnt"))
    return partial.groupBy("word").agg(F.sum("cnt").alias("cnt"))


def document_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("n_docs"))


def distinct_words(docs: DataFrame, column: str = "value") -> DataFrame:
    """One row: number of distinct words."""
    return words(docs, column).distinct().agg(F.count(F.lit(1)).alias("n_words"))


def average_word_length(docs: DataFrame, column: str = "value") -> DataFrame:
    """One row: mean length of the distinct words, each counted once, in UTF-16 units."""
    return words(docs, column).distinct().agg(
        (F.sum(utf16_length(F.col("word"))) / F.count(F.lit(1))).alias("avg_len")
    )

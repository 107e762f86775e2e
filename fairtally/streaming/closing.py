"""Stop counting at a number of items inside the stream's own state.

Every task counts the items of its part of a micro-batch; the counts pass one keyed state that knows how
many items came before and whether it is closed. A micro-batch is accepted as a whole while fewer than
``threshold`` items came before it, what comes later is never written. The state is part of the
checkpoint, so a restart or a rerun of a batch decides the same.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from fairtally.operators.frequency import merge_frequencies
from fairtally.streaming.running import FREQ_SCHEMA, state_on_disk
from fairtally.streaming.tables import DEFAULT_TRIGGER, read_batches, write_batch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Distinct items that a task holds before it sends their counts on.
LOCAL_ITEMS = 500_000


def _rows(counted: Counter) -> pa.RecordBatch:
    return pa.record_batch({"item": pa.array(counted.keys(), pa.int64()), "cnt": pa.array(counted.values(), pa.int64())})


def _task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counted: Counter = Counter()
    for batch in batches:
        values, counts = pc.value_counts(batch.column("item")).flatten()
        counted.update(dict(zip(values.to_pylist(), counts.to_pylist())))
        if len(counted) >= LOCAL_ITEMS:
            yield _rows(counted)
            counted.clear()
    if counted:
        yield _rows(counted)


class UntilThreshold(StatefulProcessor):
    """Passes on the counts of whole micro-batches until enough items came, then nothing."""

    def __init__(self, threshold: int):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.arrived = handle.getValueState("arrived", "n bigint")
        self.closed = handle.getValueState("closed", "closed boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.closed.exists():
            return
        total = self.arrived.get()[0] if self.arrived.exists() else 0
        for row in rows:
            total += row["cnt"]
            yield Row(item=row["item"], cnt=row["cnt"])
        self.arrived.update((total,))
        if total >= self.threshold:
            self.closed.update((True,))


def start_until(items: DataFrame, threshold: int, table: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write the counts of the accepted micro-batches of a stream of (item).

    One task sees the tasks' counts of a batch, never the items: a row per distinct item and task. Null
    items are counted as one more item. The query runs on after the threshold, writing nothing.
    """
    if threshold < 1:
        raise ValueError("threshold must be positive")
    partial = items.select(F.col("item").cast("bigint").alias("item")).mapInArrow(_task_counts, FREQ_SCHEMA)
    accepted = (
        partial.withColumn("every", F.lit(0))
        .groupBy("every")
        .transformWithState(UntilThreshold(threshold), FREQ_SCHEMA, outputMode="Append", timeMode="None")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        merged = merge_frequencies(batch)
        if not merged.isEmpty():
            write_batch(merged, table, batch_id)

    with state_on_disk(items.sparkSession):
        return (
            accepted.writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or DEFAULT_TRIGGER))
            .foreachBatch(write)
            .start()
        )


def read_until(spark: SparkSession, table: str) -> DataFrame:
    """(item, cnt) over all accepted micro-batches."""
    return merge_frequencies(read_batches(spark, table, FREQ_SCHEMA))

"""Running frequencies and sketches kept in the state store."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from fairtally.functions.hashing import HashFamily
from fairtally.operators.frequency import item_frequencies
from fairtally.operators.registers import BITS, item_registers
from fairtally.operators.sketch import Sketch, sketch_cells
from fairtally.streaming.tables import DEFAULT_TRIGGER, compact, read_latest, write_batch

FREQ_SCHEMA = "item bigint, cnt bigint"
CELL_SCHEMA = "r int, c int, cm bigint, cs bigint"
FREQ_COLUMNS = (["item"], ["cnt"])
CELL_COLUMNS = (["r", "c"], ["cm", "cs"])
REGISTER_SCHEMA = "register int, rank int"
REGISTER_COLUMNS = (["register"], ["rank"])


STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_starting = threading.RLock()
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep large state on local disk instead of on the heap.

    A query copies the session settings when it starts, and a restarted one keeps those of
    its checkpoint, so the setting is put back right away; a lock keeps two starts apart. A
    provider that the user chose stays.
    """
    with _starting:
        yield from _with_provider(spark)


def _with_provider(spark: SparkSession) -> Iterator[None]:
    old = spark.conf.get(STATE_PROVIDER)
    chosen = "HDFSBackedStateStoreProvider" not in old
    if not chosen:
        spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if not chosen:
            spark.conf.set(STATE_PROVIDER, old)


def _start(running: DataFrame, table: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    # Update mode: a batch writes the keys it changed, not the whole state.
    return (
        running.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(lambda rows, batch_id: write_batch(rows, table, batch_id))
        .start()
    )


def start_frequencies(items: DataFrame, table: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Count a stream of items; the state grows with the number of distinct items."""
    with state_on_disk(items.sparkSession):
        return _start(item_frequencies(items), table, checkpoint, trigger or DEFAULT_TRIGGER)


def read_frequencies(spark: SparkSession, table: str) -> DataFrame:
    return read_latest(spark, table, FREQ_SCHEMA, *FREQ_COLUMNS)


def compact_frequencies(spark: SparkSession, table: str) -> int | None:
    """Fold finished batches into one, see ``compact``; the stream and readers may go on meanwhile."""
    return compact(spark, table, FREQ_SCHEMA, *FREQ_COLUMNS)


def start_sketch(items: DataFrame, hashes: HashFamily, table: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Sketch a stream of items; the state never exceeds depth * width cells."""
    with state_on_disk(items.sparkSession):
        return _start(sketch_cells(items, hashes), table, checkpoint, trigger or DEFAULT_TRIGGER)


def read_sketch(spark: SparkSession, table: str, hashes: HashFamily) -> Sketch:
    return Sketch(read_latest(spark, table, CELL_SCHEMA, *CELL_COLUMNS), hashes)


def compact_sketch(spark: SparkSession, table: str) -> int | None:
    return compact(spark, table, CELL_SCHEMA, *CELL_COLUMNS)


def start_registers(items: DataFrame, table: str, checkpoint: str, bits: int = BITS, **trigger) -> StreamingQuery:
    """Keep the distinct-count registers of a stream; the state never exceeds 2 ** bits rows."""
    with state_on_disk(items.sparkSession):
        return _start(item_registers(items, bits), table, checkpoint, trigger or DEFAULT_TRIGGER)


def read_registers(spark: SparkSession, table: str) -> DataFrame:
    return read_latest(spark, table, REGISTER_SCHEMA, *REGISTER_COLUMNS)


def compact_registers(spark: SparkSession, table: str) -> int | None:
    return compact(spark, table, REGISTER_SCHEMA, *REGISTER_COLUMNS)

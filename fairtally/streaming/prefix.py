"""Process a stream up to an item threshold, batch by batch.

Each micro-batch writes two partial tables under its number: its item counts and its sketch
cells. Which batches count is decided afterwards from the tables alone: a batch is accepted
while fewer than ``threshold`` items came before it, so the last accepted batch may overshoot
and anything that slips in after it changes nothing. Restarts and the moment of stopping
therefore never change a result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from fairtally.functions.hashing import HashFamily
from fairtally.operators.frequency import item_frequencies, merge_frequencies
from fairtally.operators.sketch import Sketch, add_cells, sketch_cells, sketch_report
from fairtally.streaming.running import CELL_SCHEMA, FREQ_SCHEMA
from fairtally.streaming.tables import DEFAULT_TRIGGER, read_batches, write_batch


def _freq_table(out_dir: str) -> str:
    return f"{out_dir}/freq"


def _cell_table(out_dir: str) -> str:
    return f"{out_dir}/cells"


def batch_lengths(spark: SparkSession, out_dir: str) -> DataFrame:
    """(batch_id, n): every item hits exactly one cell of row 0."""
    cells = read_batches(spark, _cell_table(out_dir), CELL_SCHEMA).where("r = 0")
    return cells.groupBy("batch_id").agg(F.sum("cm").alias("n"))


def accepted_batches(lengths: DataFrame, threshold: int) -> DataFrame:
    """(batch_id, n, before): the shortest prefix of batches that reaches the threshold."""
    if threshold < 1:
        raise ValueError("threshold must be positive")
    # One row per batch, and writing stops at the threshold: a single task may add them up.
    earlier = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    running = lengths.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    return running.where(F.col("before") < threshold)


@dataclass
class Arrived:
    """Items of all batches, and of the newest one, which may run again. Batches come in order."""

    last: int = -1
    total: int = 0
    newest: int = 0

    def before(self, batch_id: int) -> int:
        return self.total - self.newest if batch_id == self.last else self.total

    def add(self, batch_id: int, n: int) -> None:
        self.total = self.before(batch_id) + n
        self.last, self.newest = batch_id, n


@dataclass(frozen=True)
class PrefixStream:
    """A running query and the number of items it has written.

    ``arrived`` only tells when to stop and spares work on batches that cannot count; the
    tables stay the authority, also for the lengths themselves after a restart.
    """

    query: StreamingQuery
    threshold: int
    arrived: Arrived

    @property
    def reached(self) -> bool:
        return self.arrived.total >= self.threshold

    def await_threshold(self, poll_seconds: float = 0.2) -> None:
        """Block until enough items came or the stream ends, then stop the query."""
        try:
            while not self.reached and not self.query.awaitTermination(poll_seconds):
                pass
        finally:
            self.query.stop()


def start_prefix_stream(
    items: DataFrame, hashes: HashFamily, threshold: int, out_dir: str, checkpoint: str, **trigger
) -> PrefixStream:
    """Start writing the partial tables of a stream of (item)."""
    known = batch_lengths(items.sparkSession, out_dir).agg(F.sum("n"), F.max(F.struct("batch_id", "n"))).first()
    arrived = Arrived(known[1].batch_id, known[0], known[1].n) if known[1] else Arrived()
    freq_table, cell_table = _freq_table(out_dir), _cell_table(out_dir)

    def process(batch: DataFrame, batch_id: int) -> None:
        if arrived.before(batch_id) >= threshold or batch.isEmpty():
            return
        session = batch.sparkSession
        counted = write_batch(item_frequencies(batch), freq_table, batch_id)
        # Sketches are linear: build the cells from the counts, not from the items again.
        counts = session.read.schema(FREQ_SCHEMA).parquet(counted)
        written = write_batch(sketch_cells(counts, hashes, weight="cnt"), cell_table, batch_id)
        cells = session.read.schema(CELL_SCHEMA).parquet(written)
        arrived.add(batch_id, cells.where("r = 0").agg(F.sum("cm")).first()[0])

    query = (
        items.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .foreachBatch(process)
        .start()
    )
    return PrefixStream(query, threshold, arrived)


def _accepted(spark: SparkSession, table: str, schema: str, out_dir: str, threshold: int) -> DataFrame:
    last = accepted_batches(batch_lengths(spark, out_dir), threshold).agg(F.max("batch_id").alias("last"))
    # Accepted batches are a prefix of the batches: comparing their number prunes the folders.
    return read_batches(spark, table, schema).where(F.col("batch_id") <= last.scalar())


def prefix_frequencies(spark: SparkSession, out_dir: str, threshold: int) -> DataFrame:
    """(item, cnt) over the accepted batches."""
    return merge_frequencies(_accepted(spark, _freq_table(out_dir), FREQ_SCHEMA, out_dir, threshold))


def prefix_sketch(spark: SparkSession, out_dir: str, threshold: int, hashes: HashFamily) -> Sketch:
    cells = _accepted(spark, _cell_table(out_dir), CELL_SCHEMA, out_dir, threshold)
    return Sketch(add_cells(cells), hashes)


def prefix_report(spark: SparkSession, out_dir: str, threshold: int, hashes: HashFamily, k: int) -> DataFrame:
    """One row: n, n_distinct, n_topk, err_cm, err_cs over the accepted batches."""
    freq = prefix_frequencies(spark, out_dir, threshold)
    return sketch_report(freq, prefix_sketch(spark, out_dir, threshold, hashes), k)

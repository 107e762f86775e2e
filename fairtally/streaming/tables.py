"""Batch-numbered tables that a stream writes and batch queries read, with a versioned list of live folders.

A write goes to a new folder ``batch_id=<n>/write=<unique>``. It counts once a new version of the table's
list, which names it, is in place; a rerun of a batch replaces the folder of its first try in that one
step, and compaction replaces many folders by one. A reader takes the newest list and reads just
its folders, so it sees the table as of one moment, whatever happens meanwhile. Replaced folders stay
for a delay and go by ``vacuum``; who reads one later gets an error, never fewer rows.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairtally.storage import ChangedMeanwhile, Files

# Micro-batches of a running stream, unless the caller asks for others.
DEFAULT_TRIGGER = {"processingTime": "10 seconds"}

LISTS = "_lists"
KEEP_LISTS = 20
KEEP_SECONDS = 3600
# Two changes of one process never race; those of several rely on the file system refusing to rename onto a file.
_changing = threading.RLock()


@dataclass(frozen=True)
class Listing:
    """Version ``number`` of a table: live folder per batch, and replaced folders with the time they were replaced."""

    number: int = -1
    live: dict[int, str] = field(default_factory=dict)
    retired: dict[str, float] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"live": sorted(self.live.items()), "retired": self.retired})

    def with_folder(self, batch_id: int, folder: str, replaced: list[int], now: float) -> Listing:
        """The listing in which ``folder`` stands for the batch and for all batches of ``replaced``."""
        gone = {b: f for b, f in self.live.items() if b in replaced or b == batch_id}
        live = {b: f for b, f in self.live.items() if b not in gone} | {batch_id: folder}
        return Listing(self.number + 1, live, self.retired | {f: now for f in gone.values()})


def _versions(files: Files) -> list[int]:
    return sorted(int(n) for n in files.names(LISTS) if n.isdigit())


def read_listing(spark: SparkSession, table: str) -> Listing:
    """The newest version; an empty one before the first write."""
    files = Files(spark, table)
    while numbers := _versions(files):
        try:
            known = json.loads(files.read(f"{LISTS}/{numbers[-1]:012d}"))
        except Py4JJavaError as error:
            if "FileNotFound" not in error.java_exception.getClass().getName():
                raise
            continue  # old lists were removed meanwhile: a newer one is there
        return Listing(numbers[-1], {int(b): f for b, f in known["live"]}, known["retired"])
    return Listing()


def _change(spark: SparkSession, table: str, change: Callable[[Listing], Listing | None]) -> Listing:
    """Puts the next version in place, again from the newest one when another writer was faster."""
    files = Files(spark, table)
    with _changing:
        while True:
            before = read_listing(spark, table)
            after = change(before)
            if after is None:
                return before
            try:
                files.put(f"{LISTS}/{after.number:012d}", after.text())
            except ChangedMeanwhile:
                continue
            for number in _versions(files)[:-KEEP_LISTS]:
                files.delete(f"{LISTS}/{number:012d}")
            return after


def _write(rows: DataFrame, table: str, batch_id: int) -> str:
    """A new folder with as few files as the rows' size asks for, whatever the number of their partitions."""
    folder = f"batch_id={batch_id}/write={uuid.uuid4().hex}"
    rows.hint("rebalance").write.parquet(f"{table}/{folder}")
    return folder


def write_batch(rows: DataFrame, table: str, batch_id: int) -> str:
    """The rows as the batch's only ones, those of an earlier try replaced. Returns the folder's path."""
    folder = _write(rows, table, batch_id)
    _change(rows.sparkSession, table, lambda now: now.with_folder(batch_id, folder, [], time.time()))
    return f"{table}/{folder}"


def _folders(spark: SparkSession, table: str, schema: str, folders: list[str]) -> DataFrame:
    full = f"{schema}, batch_id bigint"
    if not folders:
        return spark.createDataFrame([], full)
    names = [f.split()[0] for f in full.split(", ")]
    return spark.read.schema(full).option("basePath", table).parquet(*[f"{table}/{f}" for f in folders]).select(names)


def read_batches(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All rows with their batch_id, as of now; empty before the first batch."""
    return _folders(spark, table, schema, list(read_listing(spark, table).live.values()))


def latest_rows(batches: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """For an update-mode table: the values of each key from the last batch that changed it."""
    last = batches.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch_id")).alias("v"))
    return last.select(*keys, *[F.col(f"v.{v}").alias(v) for v in values])


def read_latest(spark: SparkSession, table: str, schema: str, keys: list[str], values: list[str]) -> DataFrame:
    """The latest values of each key, as of now."""
    return latest_rows(read_batches(spark, table, schema), keys, values)


def compact(spark: SparkSession, table: str, schema: str, keys: list[str], values: list[str]) -> int | None:
    """Folds all batches but the newest, which may run again, into one folder; the number of the last one folded.

    The latest rows of all batches up to a number stand for that batch and those before it. A stream
    may write and others may read meanwhile: they see the table before or after the change. When a
    folded batch was written again before the change, the fold is dropped, to be done by the next call.
    """
    before = read_listing(spark, table)
    folded = sorted(before.live)[:-1]
    if len(folded) < 2:
        return folded[-1] if folded else None
    rows = latest_rows(_folders(spark, table, schema, [before.live[b] for b in folded]), keys, values)
    folder = _write(rows, table, folded[-1])

    def fold(now: Listing) -> Listing | None:
        if any(now.live.get(b) != before.live[b] for b in folded):
            return None
        return now.with_folder(folded[-1], folder, folded, time.time())

    done = _change(spark, table, fold)
    return folded[-1] if done.live.get(folded[-1]) == folder else None


def vacuum(spark: SparkSession, table: str, keep_seconds: float = KEEP_SECONDS) -> list[str]:
    """Removes folders replaced longer ago than ``keep_seconds``, and tries as old that never counted.

    The delay must be longer than any reader takes, and than a batch takes to be written.
    """
    files, now = Files(spark, table), time.time()
    listing = read_listing(spark, table)
    old = {f for f, since in listing.retired.items() if now - since >= keep_seconds}
    known = {*listing.live.values(), *listing.retired}
    for batch in (n for n in files.names() if n.startswith("batch_id=")):
        for name in (f"{batch}/{n}" for n in files.names(batch)):
            if name not in known and now - files.newest(name) >= keep_seconds:
                old.add(name)
    for name in sorted(old):
        files.delete(name)
        if not files.names(name.split("/")[0]):
            files.delete(name.split("/")[0])
    forget = lambda v: replace(v, number=v.number + 1, retired={f: t for f, t in v.retired.items() if f not in old})
    _change(spark, table, lambda v: forget(v) if old & set(v.retired) else None)
    return sorted(old)

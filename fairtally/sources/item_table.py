"""A replayable stream of items out of a Parquet table, with offsets and bounded micro-batches.

The table's files are read in the order of their names, rows in the order of the file. An offset is a
file and a row in it, so the same range of offsets always gives the same rows, after a failure and
after a restart too. Files that appear later are read when their names come after those already read.
"""

from __future__ import annotations

import json
import sys
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# Executors get the source with the query, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "item_table"
ROWS_PER_TRIGGER, ROWS_PER_PARTITION = 10_000_000, 1_000_000
BEGIN = ("", 0)


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


@dataclass
class Rows(InputPartition):
    """Rows ``start`` to ``stop`` of a file."""

    file: str
    start: int
    stop: int


class ItemTableReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        # Spark lowers the names of options.
        values = {k.lower(): v for k, v in options.items()}
        self.path, self.column = values["path"], values.get("column", "item")
        self.per_trigger = int(values.get("rowspertrigger", ROWS_PER_TRIGGER))
        self.per_partition = int(values.get("rowsperpartition", ROWS_PER_PARTITION))
        if min(self.per_trigger, self.per_partition) < 1:
            raise ValueError("rowsPerTrigger and rowsPerPartition must be positive")
        self.checkpoint = values.get("checkpoint")
        self.counts: dict[str, int] = {}
        self.planned: tuple[str, int] | None = None

    def _files(self) -> list[str]:
        files, path = _file_system(self.path)
        info = files.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [path]
        found = files.get_file_info(pafs.FileSelector(path, recursive=True, allow_not_found=True))
        inner = lambda f: f[len(path) :].strip("/").split("/")
        names = [f.path for f in found if f.type == pafs.FileType.File and f.size]
        return sorted(f for f in names if not any(p.startswith(("_", ".")) for p in inner(f)))

    def _count(self, file: str) -> int:
        """Rows of a file, by its footer; only files that a batch touches are opened."""
        if file not in self.counts:
            files, _ = _file_system(self.path)
            self.counts[file] = pq.read_metadata(files.open_input_file(file)).num_rows
        return self.counts[file]

    def _walk(self, start: tuple[str, int], most: int) -> Iterator[Rows]:
        """The next ``most`` rows after an offset, by file."""
        files = self._files()
        if start[0] and start[0] not in files:
            raise FileNotFoundError(f"{start[0]}, which the stream had reached, is gone")
        row = start[1]
        for file in files[bisect_left(files, start[0]) :]:
            stop = min(self._count(file), row + most)
            if stop > row:
                yield Rows(file, row, stop)
                most -= stop - row
            if not most:
                return
            row = 0

    def _resumed(self) -> tuple[str, int]:
        """The last offset of this table in the query's checkpoint: where a restarted query goes on."""
        if not self.checkpoint:
            return BEGIN
        files, path = _file_system(f"{self.checkpoint.rstrip('/')}/offsets")
        found = files.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        batches = sorted((int(f.base_name), f.path) for f in found if f.base_name.isdigit())
        for _, file in reversed(batches):
            with files.open_input_stream(file) as log:
                lines = log.read().decode().split("\n")
            for line in lines:
                offset = json.loads(line) if line.startswith("{") else {}
                if offset.get("table") == self.path:
                    return offset["file"], offset["row"]
        return BEGIN

    def _offset(self, at: tuple[str, int]) -> dict:
        return {"table": self.path, "file": at[0], "row": at[1]}

    def initialOffset(self) -> dict:
        return self._offset(BEGIN)

    def latestOffset(self) -> dict:
        """At most ``rowsPerTrigger`` rows after what was planned last; asked again, the same."""
        if self.planned is None:
            self.planned = self._resumed()
        last = self.planned
        for rows in self._walk(self.planned, self.per_trigger):
            last = (rows.file, rows.stop)
        return self._offset(last)

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        first, last = (start["file"], start["row"]), (end["file"], end["row"])
        if last < first:
            raise ValueError(f"offsets go back from {first} to {last}: give the source the query's checkpoint")
        self.planned = max(last, self.planned or BEGIN)
        found = []
        for rows in self._walk(first, sys.maxsize):
            if (rows.file, rows.start) >= last:
                break
            stop = last[1] if rows.file == last[0] else rows.stop
            found += [Rows(rows.file, a, min(a + self.per_partition, stop)) for a in range(rows.start, stop, self.per_partition)]
            if rows.file == last[0]:
                break
        return found

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        files, _ = _file_system(self.path)
        with files.open_input_file(partition.file) as source:
            table = pq.ParquetFile(source)
            first = 0
            for group in range(table.num_row_groups):
                n = table.metadata.row_group(group).num_rows
                a, b = max(partition.start, first), min(partition.stop, first + n)
                if a < b:
                    items = table.read_row_group(group, columns=[self.column]).slice(a - first, b - a).column(0).cast(pa.int64())
                    yield from pa.table({"item": items}).to_batches(max_chunksize=65_536)
                first += n


class ItemTable(DataSource):
    """Options: path, column, rowsPerTrigger, rowsPerPartition, checkpoint (that of the query)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "item bigint"

    def streamReader(self, schema) -> ItemTableReader:
        return ItemTableReader(dict(self.options))


def table_items(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    column: str = "item",
    rows_per_trigger: int = ROWS_PER_TRIGGER,
    rows_per_partition: int = ROWS_PER_PARTITION,
) -> DataFrame:
    """A stream of (item) from an integer column of a Parquet table; null items stay null.

    ``checkpoint`` must be the checkpointLocation of the query that reads the stream: a bounded source
    has to know where the query stands when it starts again. A micro-batch gets at most
    ``rows_per_trigger`` rows, a task at most ``rows_per_partition``. An availableNow query of this
    source is one micro-batch.
    """
    spark.dataSource.register(ItemTable)
    reader = spark.readStream.format(NAME).option("path", path).option("column", column).option("checkpoint", checkpoint)
    return reader.option("rowsPerTrigger", rows_per_trigger).option("rowsPerPartition", rows_per_partition).load()

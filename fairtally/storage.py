"""Where jobs put files that tasks on any machine must read back."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="fairtally-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"



def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written once below the shared folder and read back: lineage ends here."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, cache: bool = True) -> Iterator[DataFrame]:
    """The rows kept in memory and on disk inside the block, for jobs that read them again and again.

    Rows in fewer partitions than there are cores, as of one file of one row group, are spread first.
    Frames that the caller keeps already are left as they are; lost blocks are computed again.
    """
    if not cache or df.is_cached:
        yield df
        return
    rows = df.persist(StorageLevel.MEMORY_AND_DISK)
    cores = df.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:  # nothing has been read yet
        rows.unpersist()
        rows = df.repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield rows
    finally:
        rows.unpersist()


class ChangedMeanwhile(RuntimeError):
    """A file of this name was put in place first."""


class Files:
    """The Hadoop file system of a folder: what Spark itself writes to."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.root = self.path(folder)
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path(*parts)

    def names(self, *below: str) -> list[str]:
        folder = self.path(self.root, "/".join(below)) if below else self.root
        return [s.getPath().getName() for s in self.fs.listStatus(folder)] if self.fs.exists(folder) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(self.root, name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A file that appears as a whole, or not at all if one of that name is there."""
        target = self.path(self.root, name)
        draft = self.path(target.getParent(), f".{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.conf)
        never = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = never
        try:
            context.rename(draft, target, options)
        except Py4JJavaError as error:
            self.fs.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise ChangedMeanwhile(name) from error
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(self.root, name), True)

    def newest(self, name: str) -> float:
        """Time in seconds of the last change of a folder or a file in it."""
        status = [self.fs.getFileStatus(self.path(self.root, name)), *self.fs.listStatus(self.path(self.root, name))]
        return max(s.getModificationTime() for s in status) / 1000

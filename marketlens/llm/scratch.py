"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import ctypes
import gc
import time
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marketlens.session import shared_folder


#: glibc's call that returns freed memory; absent elsewhere.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def own_name(df: DataFrame) -> str:
    """A name that no column of `df` has: it is longer than all of them."""
    return "_" * (1 + max(map(len, df.columns), default=0))


class Scratch:
    """A new folder per operator call, below the shared one.

    Tables written here cut the lineage: a lost executor costs the tasks after the table, not the
    work before it. Spark removes the folder when the session's file systems close; `drop` removes
    a table as soon as nothing reads it any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/marketlens-{name}-{uuid.uuid4().hex}"
        path, files = self._files(self.folder)
        files.mkdirs(path)
        files.deleteOnExit(path)

    def _files(self, folder: str):
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def keep(self, df: DataFrame, name: str, *partitions: str, release: bool = True) -> DataFrame:
        """Write `df` once and read it back; with `release` the shuffles behind it go at once."""
        writer = df.write.option("compression", "zstd")
        if partitions:
            writer = writer.partitionBy(*partitions)
        writer.parquet(self.path(name))
        schema = df.schema
        del df, writer
        if release:
            self.release()
        return self.read(name, schema)

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path, files = self._files(self.path(name))
            files.delete(path, True)

    def release(self) -> None:
        """Shuffle files go when the driver collects the plans that made them.

        It is asked twice: the events of a job that has just ended hold its plan a moment longer.
        What Python has freed goes back to the system too: a driver runs many operators in a row.
        """
        gc.collect()
        pa.default_memory_pool().release_unused()
        if _trim is not None:
            _trim(0)
        for wait in (0.0, 0.3):
            time.sleep(wait)
            self.spark.sparkContext._jvm.System.gc()

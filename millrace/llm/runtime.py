"""What the operators of this package share: code shipping, batches, scratch tables and null-safe inputs."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.scratch import scratch_path

__all__ = ["Workspace", "ship", "slices", "flat_bytes", "is_held_out", "table"]

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors' Python this package, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="millrace-code-"), "millrace_code.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in sorted(os.walk(package)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        out.write(full, os.path.join("millrace", os.path.relpath(full, package)))
        context.addPyFile(target)
        _SHIPPED.add(context.applicationId)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def is_held_out(key: Column) -> Column:
    """Rows that no model learns from: crc32 of the key as text leaves remainder 0 by 5; a null key is held out too."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(True))


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of each part hold at most ``limit`` bytes, or are a single text."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in a row, and where each text starts (one more entry: the end). Null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


class Workspace:
    """Tables that one operator writes in the shared folder; dropped one by one, or all that are left."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; an older table of that name goes as soon as the new one is whole."""
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

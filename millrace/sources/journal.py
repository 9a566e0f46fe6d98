"""Rewrites of table partitions that a stop can't leave half done.

The new content is written to a folder inside the table that scans skip, with the list of
partitions it replaces; a ready mark, put there in one rename, decides the rewrite.  Only
then do partition folders move.  A rewrite without the mark has changed nothing and is
dropped; one with the mark is finished by the next writer, from whatever step it had
reached: a new folder that is no longer in the journal has been moved already.

One job at a time writes a table.  A reader in another job may meet a rewrite while its
folders move; after a stop, ``repair`` brings the table to the new content.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

FOLDER = "_rewrite"
_READY = "_READY"


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _partitions(spark: SparkSession, root: str, depth: int) -> set[str]:
    """Partition folders below a root, relative to it.  Names are as the writer escaped them."""
    fs = _system(spark, root)
    base = fs.makeQualified(_path(spark, root)).toString().rstrip("/") + "/"
    level = [base.rstrip("/")]
    for _ in range(depth):
        level = [s.getPath().toString() for name in level if fs.exists(_path(spark, name)) for s in fs.listStatus(_path(spark, name))
                 if s.isDirectory() and "=" in s.getPath().getName()]
    return {name.removeprefix(base) for name in level}


def rewrite(spark: SparkSession, path: str, touched: DataFrame, fresh: DataFrame, partition_by: Sequence[str]) -> None:
    """Make ``fresh`` the whole content of the partitions listed in ``touched``; those without a row of it are removed."""
    base = f"{path}/{FOLDER}/{uuid.uuid4().hex}"
    touched.select(*partition_by).distinct().selectExpr("*", "true as __listed").write.partitionBy(*partition_by).parquet(f"{base}/touched")
    fresh.write.partitionBy(*partition_by).parquet(f"{base}/data")
    # one name for each touched partition, as the committer of a partitioned write holds them too
    listed, filled = (_partitions(spark, f"{base}/{name}", len(partition_by)) for name in ("touched", "data"))
    if filled - listed:
        raise ValueError(f"rows of partitions that are not to be rewritten: {sorted(filled - listed)[:5]}")
    text = "\n".join([*(f"fill {name}" for name in sorted(filled)), *(f"drop {name}" for name in sorted(listed - filled))])
    _mark(spark, base, text)
    _apply(spark, path, base)


def _mark(spark: SparkSession, base: str, text: str) -> None:
    fs = _system(spark, base)
    out = fs.create(_path(spark, f"{base}/_writing"), True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(_path(spark, f"{base}/_writing"), _path(spark, f"{base}/{_READY}"))


def _apply(spark: SparkSession, path: str, base: str) -> None:
    fs = _system(spark, base)
    source = fs.open(_path(spark, f"{base}/{_READY}"))
    text = bytes(source.readAllBytes()).decode()
    source.close()
    for line in text.splitlines():
        kind, name = line.split(" ", 1)
        old, new = _path(spark, f"{path}/{name}"), _path(spark, f"{base}/data/{name}")
        if kind == "drop":
            _delete(fs, old)
        elif fs.exists(new):
            _delete(fs, old)
            fs.mkdirs(old.getParent())
            if not _move(fs, new, old):
                raise OSError(f"could not move {new} to {old}")
    _delete(fs, _path(spark, base))


def _move(fs, new, old) -> bool:
    return fs.rename(new, old)


def _delete(fs, path) -> None:
    fs.delete(path, True)


def repair(spark: SparkSession, path: str) -> None:
    """Finish the rewrites that were decided, drop those that were not."""
    fs, root = _system(spark, path), _path(spark, f"{path}/{FOLDER}")
    if not fs.exists(root):
        return
    for status in fs.listStatus(root):
        base = status.getPath().toString()
        if fs.exists(_path(spark, f"{base}/{_READY}")):
            _apply(spark, path, base)
        else:
            _delete(fs, status.getPath())
    _delete(fs, root)

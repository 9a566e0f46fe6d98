"""Tables as Parquet folders or catalog names: scans, sinks and declared schemas."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.conform import distinct_keys, try_cast_columns
from millrace.operators.audit import observed
from millrace.operators.lookup import Split
from millrace.operators.merge import on_map, upsert_full
from millrace.scratch import drop_frame, materialise
from millrace.sources import journal

# ---- scans -------------------------------------------------------------------


def by_path(spark: SparkSession, path: str, schema: T.StructType | None = None, evolve: bool = False) -> DataFrame:
    """A table folder; ``evolve`` merges the schemas of files written at different times."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("mergeSchema", str(evolve).lower()).parquet(path)


def by_name(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def by_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """A query; ``{name}`` in the text stands for the frame passed under that name."""
    return spark.sql(text, **frames)


def metadata(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A metadata table: CSV with header, or a table folder."""
    if fmt == "csv":
        return spark.read.option("header", True).csv(path)
    return spark.read.parquet(path)


def schema_of(df: DataFrame) -> T.StructType:
    """Column order and types of a table, without reading rows."""
    return df.schema


# ---- sinks -------------------------------------------------------------------


def write(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """Append to or overwrite a table folder, optionally partitioned."""
    journal.repair(df.sparkSession, path)
    writer = df.write.mode(mode)
    if mode == "overwrite":
        # The whole table, whatever the session says about partitions.
        writer = writer.option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that occur in the frame."""
    journal.repair(df.sparkSession, path)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
               bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """A catalog table.  Bucketing on the merge key spares later merges the target's exchange."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        count, keys = bucket_by
        writer = writer.bucketBy(count, *keys).sortBy(*keys)
    writer.saveAsTable(name)


def merged_buckets(spark: SparkSession, name: str, delta: str, keys: Sequence[str]) -> DataFrame:
    """Full-row upsert of one bucketed table into another; with the same buckets on the keys neither is exchanged, whatever their sizes."""
    return upsert_full(by_name(spark, name), by_name(spark, delta), keys, action=None)


def merge_bucketed(spark: SparkSession, name: str, delta: DataFrame, keys: Sequence[str], buckets: int, into: str) -> DataFrame:
    """Upsert a delta into a table bucketed on the keys, as a new table of the same buckets.

    Only the delta is dealt out: it is written in the target's buckets first, and bucket
    meets bucket after that.  ``into`` is another name than ``name``, which is being read.
    """
    side = f"{name}_delta_{uuid.uuid4().hex}"
    save_table(delta, side, bucket_by=(buckets, keys))
    try:
        save_table(merged_buckets(spark, name, side, keys), into, bucket_by=(buckets, keys))
    finally:
        spark.sql(f"drop table {side}")
    return by_name(spark, into)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def write_split(split: Split, path: str, flag: str = "rejected") -> dict[str, int]:
    """Loaded and rejected rows in one write, so the lookups behind them run once; gives how many there were of each."""
    marked = split.frame.withColumn(flag, F.col(split.error).isNotNull())
    return observed(marked, lambda df: df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(flag).parquet(path),
                    {"loaded": F.count_if(~F.col(flag)), "rejected": F.count_if(F.col(flag))})


def truncate(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Remove all rows, keep the schema."""
    write(spark.createDataFrame([], schema), path, "overwrite")


# ---- rewriting only what a merge touches -------------------------------------------


def touched_partitions(target: DataFrame, source: DataFrame, on: Mapping[str, str] | Sequence[str],
                       partition_by: Sequence[str]) -> DataFrame:
    """Partitions that hold a row the source replaces, or that receive a source row."""
    on = on_map(on)
    keys = source.select(*[F.col(theirs).alias(mine) for mine, theirs in on.items()])
    replaced = target.select(*dict.fromkeys([*on, *partition_by])).join(keys, list(on), "left_semi")
    return distinct_keys([replaced, source], list(partition_by))


def in_partitions(df: DataFrame, partitions: DataFrame) -> DataFrame:
    """Rows of the listed partitions.

    The values of each partition column become a literal filter, which prunes
    folders when the scan is planned; a semi join, NULL-safe, then keeps exactly
    the listed combinations.  There is one listed row per partition, no more.
    """
    listed = partitions.collect()
    for i, name in enumerate(partitions.columns):
        values = {row[i] for row in listed}
        known = F.col(name).isin([v for v in values if v is not None])
        df = df.filter(known | F.col(name).isNull() if None in values else known)
    side = partitions.toDF(*[f"__{name}" for name in partitions.columns])
    same = reduce(Column.__and__, [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in partitions.columns])
    return df.join(side, same, "left_semi")


def rewrite_partitions(spark: SparkSession, path: str, touched: DataFrame, partition_by: Sequence[str],
                       change: Callable[[DataFrame], DataFrame], schema: T.StructType | None = None) -> None:
    """Replace the content of some partitions by a function of it; the others are not read or written.

    The new content is written once, in the table's journal, and its folders are moved
    to their places when all of it is there; a stop on the way is made good by the next
    writer.  A partition left without rows is removed.  Without a schema, partition
    columns have the types that ``touched`` gives them.
    """
    journal.repair(spark, path)
    if schema is None:
        kinds = {f.name: f.dataType for f in touched.schema}
        schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType) if f.name in partition_by else f.dataType)
                               for f in by_path(spark, path).schema])
    touched = materialise(touched.select(*partition_by).distinct(), "touched")
    fresh = change(in_partitions(by_path(spark, path, schema), touched))
    journal.rewrite(spark, path, touched, fresh, partition_by)
    drop_frame(touched)


def upsert_partitions(spark: SparkSession, path: str, source: DataFrame, on: Mapping[str, str] | Sequence[str],
                      partition_by: Sequence[str], schema: T.StructType | None = None) -> None:
    """Full-row upsert into a partitioned table that rewrites only the partitions it touches."""
    journal.repair(spark, path)
    target = by_path(spark, path, schema)
    if schema is None:
        # Values read from folder names would be guessed: text '01' would become the number 1.
        kinds = {f.name: f.dataType for f in source.schema}
        schema = T.StructType([T.StructField(f.name, kinds[f.name] if f.name in partition_by else f.dataType) for f in target.schema])
        target = by_path(spark, path, schema)
    touched = touched_partitions(target, source, on, partition_by)
    rewrite_partitions(spark, path, touched, partition_by,
                       lambda part: upsert_full(part.select(*target.columns), source, on, action=None), schema)


# ---- versions: overwrite a table that is being read ----------------------------

_VERSION = re.compile(r"version=(\d+)$")


def _file_system(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a table; one whose job failed has no success marker."""
    root, fs = _file_system(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        folder = status.getPath()
        match = _VERSION.search(folder.toString())
        if match and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
            found.append(int(match.group(1)))
    return sorted(found)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    complete = versions(spark, path)
    if not complete:
        raise FileNotFoundError(f"no complete version of {path}")
    return spark.read.parquet(f"{path}/version={complete[-1]}")


def write_next(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = 2) -> DataFrame:
    """Write the next version, which may read the current one, and return it.

    Readers of the current version are not disturbed; versions older than the
    last ``keep`` are removed afterwards.
    """
    spark = df.sparkSession
    complete = versions(spark, path)
    number = (complete[-1] if complete else 0) + 1
    write(df, f"{path}/version={number}", "overwrite", partition_by)
    _, fs = _file_system(spark, path)
    for old in complete[: max(0, len(complete) + 1 - keep)]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={old}"), True)
    return read_current(spark, path)


def write_together(spark: SparkSession, path: str, number: int, frames: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> None:
    """Write several tables (frame, partition columns) as one version, which ``commit_version`` makes count.

    A version that broke off has no marker and is written over.
    """
    for name, (df, partition_by) in frames.items():
        write(df, f"{path}/version={number}/{name}", "overwrite", partition_by)


def commit_version(spark: SparkSession, path: str, number: int, keep: int = 2) -> None:
    """From now on readers take this version; versions older than the last ``keep`` go."""
    root, fs = _file_system(spark, f"{path}/version={number}")
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(root, "_SUCCESS"), True).close()
    for old in versions(spark, path)[:-keep]:
        drop_folder(spark, f"{path}/version={old}")


def drop_folder(spark: SparkSession, path: str) -> None:
    root, fs = _file_system(spark, path)
    fs.delete(root, True)


def exists(spark: SparkSession, path: str) -> bool:
    root, fs = _file_system(spark, path)
    return fs.exists(root)


# ---- declared tables -----------------------------------------------------------

# Type names a metadata table may use.
_TYPES: dict[str, type[T.DataType]] = {
    "stringtype": T.StringType, "str": T.StringType,
    "integertype": T.IntegerType, "int": T.IntegerType,
    "longtype": T.LongType, "long": T.LongType,
    "short": T.ShortType,
    "floattype": T.FloatType, "doubletype": T.DoubleType,
    "booleantype": T.BooleanType, "boolean": T.BooleanType,
    "datetype": T.DateType, "timestamptype": T.TimestampType,
    "binarytype": T.BinaryType,
    "decimaltype": T.DecimalType, "decimal": T.DecimalType,
    # The short names mean exact numbers.
    "float": T.DecimalType, "double": T.DecimalType,
}
_PRECISION, _SCALE = 38, 18


def type_of(name: str, precision=None, scale=None) -> T.DataType:
    kind = _TYPES.get(name.strip().lower())
    if kind is None:
        raise ValueError(f"unknown type name {name!r}")
    if kind is T.DecimalType:
        def number(value, default: int) -> int:
            return default if value in (None, "") else int(float(value))
        return T.DecimalType(number(precision, _PRECISION), number(scale, _SCALE))
    return kind()


def declared_tables(meta: DataFrame) -> dict[str, tuple[T.StructType, list[str]]]:
    """Schema and partition columns of each table a metadata table describes.

    Columns: TableName, ColumnName, DataType, Precision, Scale, forPartition.
    Schemas are configuration, so the metadata is read whole, in its row order.
    """
    tables: dict[str, tuple[T.StructType, list[str]]] = {}
    for row in meta.select("TableName", "ColumnName", "DataType", "Precision", "Scale", "forPartition").collect():
        schema, partitions = tables.setdefault(row.TableName, (T.StructType(), []))
        schema.add(row.ColumnName, type_of(row.DataType, row.Precision, row.Scale), True)
        if row.forPartition is not None and int(float(row.forPartition)) == 1:
            partitions.append(row.ColumnName)
    return tables


def create_tables(spark: SparkSession, meta: DataFrame, root: str, only: Iterable[str] | None = None) -> dict[str, T.StructType]:
    """Create the described tables empty, below a folder."""
    wanted = None if only is None else set(only)
    created = {}
    for name, (schema, partitions) in declared_tables(meta).items():
        if wanted is None or name in wanted:
            write(spark.createDataFrame([], schema), f"{root}/{name}", "overwrite", partitions)
            created[name] = schema
    return created


def retype(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Change column types; values that do not fit become NULL."""
    return try_cast_columns(df, types)

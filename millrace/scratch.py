"""Intermediate tables in the folder the cluster shares between its machines."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Only a single-machine session without the setting gets a folder of its own:
    on a cluster a machine-local folder would be invisible to other executors.
    """
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="millrace-")
    return _LOCAL[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{scratch_root(spark)}/millrace/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once and read it back.

    Unlike a cached frame the result survives the loss of executors, and unlike
    a longer lineage it gives the planner true sizes for the steps that follow.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_frame(*frames: DataFrame) -> None:
    """Delete the tables that ``materialise`` wrote for these frames, when no plan needs them any more."""
    for df in frames:
        spark = df.sparkSession
        root = f"/millrace/{spark.sparkContext.applicationId}/"
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            if root in folder:
                _delete(spark, folder)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete this application's intermediate tables."""
    _delete(spark, f"{scratch_root(spark)}/millrace/{spark.sparkContext.applicationId}")

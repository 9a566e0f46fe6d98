"""Audit rows around a load, and table sizes."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.conform import union_by_name

COLUMNS = (
    "AUDITKEY", "PIPELINENAME", "PIPELINERUNID", "TRIGGERTYPE", "TABLE_NAME", "FUNCTION_NAME",
    "STARTTIME", "ENDTIME", "STATUS_ACTIVITY", "COUNTROWSBEFORE", "COUNTROWSAFTER", "ERRORCODE", "ERRORMESSAGE",
)
AUDIT = T.StructType([T.StructField(name, T.StringType()) for name in COLUMNS])
SUCCESS, FAIL = "Success", "Fail"


def audit_key(pipeline: str, table: str, started: datetime | str) -> str:
    moment = str(started).replace(" ", "_").replace(":", "_")
    return f"{pipeline}-{table}-{moment}"


def audit_row(spark: SparkSession, details: Mapping[str, object], started, ended, status: str = SUCCESS,
              error: BaseException | str | None = None) -> DataFrame:
    """One audit row; ``details`` may name any audit column, all are text."""
    unknown = set(details) - set(COLUMNS)
    if unknown:
        raise ValueError(f"not audit columns: {sorted(unknown)}")
    row = dict(details) | {"STARTTIME": started, "ENDTIME": ended, "STATUS_ACTIVITY": status}
    row.setdefault("AUDITKEY", audit_key(str(row.get("PIPELINENAME")), str(row.get("TABLE_NAME")), started))
    if error is not None:
        row |= {"ERRORCODE": "-", "ERRORMESSAGE": error}
    text = [None if row.get(name) is None else str(row[name]) for name in COLUMNS]
    return spark.createDataFrame([tuple(text)], AUDIT)


def with_counts(row: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Fill the row counts as part of the plan, without an action of their own."""
    def count(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n")).scalar().cast("string")

    return row.withColumns({"COUNTROWSBEFORE": count(before), "COUNTROWSAFTER": count(after)})


def run_audited(spark: SparkSession, step: Callable[[], object], count: Callable[[], int],
                write: Callable[[DataFrame], None], details: Mapping[str, object],
                clock: Callable[[], datetime], raise_error: bool = True) -> bool:
    """Run a load between two counts and append its audit row, also when it fails.

    A failure is raised again after it has been recorded, unless told not to.
    """
    started = clock()
    counts: dict[str, object] = {}
    try:
        counts["COUNTROWSBEFORE"] = count()
        step()
        counts["COUNTROWSAFTER"] = count()
    except Exception as error:
        write(audit_row(spark, {**details, **counts}, started, clock(), FAIL, error))
        if raise_error:
            raise
        return False
    write(audit_row(spark, {**details, **counts}, started, clock()))
    return True


def counted(df: DataFrame, measures: Mapping[str, Column] | None = None) -> tuple[DataFrame, Observation]:
    """A frame whose row count (and other measures) become known as a by-product of writing it."""
    observation = Observation()
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in (measures or {}).items()]), observation


def observed(df: DataFrame, write: Callable[[DataFrame], object], measures: Mapping[str, Column] | None = None) -> dict[str, int]:
    """Write a frame and give its measures, ``rows`` among them, as the write found them: no job counts it."""
    frame, observation = counted(df, measures)
    write(frame)
    return dict(observation.get)


def last_count(spark: SparkSession, log: str, table: str) -> int:
    """Rows of a table after its last recorded load; 0 without one.  Reads the audit rows, not the table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return 0
    rows = spark.read.schema(AUDIT).parquet(log).filter((F.col("TABLE_NAME") == table) & (F.col("STATUS_ACTIVITY") == SUCCESS))
    return int(rows.agg(F.max_by("COUNTROWSAFTER", F.struct("ENDTIME", "STARTTIME")).alias("n")).first().n or 0)


def run_observed(spark: SparkSession, df: DataFrame, write: Callable[[DataFrame], object], log: Callable[[DataFrame], None], details: Mapping[str, object],
                 clock: Callable[[], datetime], before: int = 0, raise_error: bool = True) -> bool:
    """Append a frame and its audit row; the counts are those before (as the log has them) and with the rows the write saw."""
    started = clock()
    counts: dict[str, object] = {"COUNTROWSBEFORE": before}
    try:
        counts["COUNTROWSAFTER"] = before + observed(df, write)["rows"]
    except Exception as error:
        log(audit_row(spark, {**details, **counts}, started, clock(), FAIL, error))
        if raise_error:
            raise
        return False
    log(audit_row(spark, {**details, **counts}, started, clock()))
    return True


def table_size(df: DataFrame, name: str) -> DataFrame:
    """Rows and columns of a table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_by_name([table_size(df, name) for name, df in tables.items()], False)

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-06-15 08:30:05"


@dataclass(frozen=True)
class Case:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def case(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""
    def register(run):
        CASES[name or run.__name__] = Case(run, sql)
        return run
    return register


def tables(spark: SparkSession, folder: str, *names: str):
    """One frame, or a list of frames, of the generated tables."""
    frames = [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]
    return frames[0] if len(frames) == 1 else frames


def day(name: str) -> Column:
    """``yyyyMMdd`` of a timestamp as an integer."""
    return F.date_format(name, "yyyyMMdd").cast("int")


def number(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("double")

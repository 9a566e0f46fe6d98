"""Declared acceptance metrics of tables, and their reconciliation.

One result row per check, or per check and group:
(index, Table, Column, KeyCheck, KeyGroupby, groupbyValue, value, checked_at).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import as_timestamp
from millrace.functions.conform import union_by_name

VALUE = "decimal(36,5)"
SCALAR = {"countrow", "countnonnull", "sum", "min", "max", "firstdate", "lastdate"}
GROUPED = {"countby", "sumby"}
DISTINCT = {"distinct", "countdistinctby"}
# Group columns whose values are reported as yyyyMMdd.
DATE_GROUPS = frozenset({"saledate"})


@dataclass(frozen=True)
class Check:
    index: int
    table: str
    column: str
    kind: str
    group_by: str = ""
    where: str = ""

    def __post_init__(self) -> None:
        if self.kind not in SCALAR | GROUPED | DISTINCT:
            raise ValueError(f"unknown check {self.kind!r}")


def _passing(check: Check, value: Column) -> Column:
    return F.when(F.expr(check.where), value) if check.where else value


def _sum(df: DataFrame, check: Check) -> Column:
    """Sum of a check's column; floating-point values are made exact, so it does not depend on row order.

    A sum with a value that has no exact form (too large, not finite), or that grows
    too large itself, is NULL and leaves the other checks alone.
    """
    column = F.col(check.column)
    if not isinstance(df.schema[check.column].dataType, (T.DoubleType, T.FloatType)):
        return F.try_sum(_passing(check, column))
    exact = column.try_cast("decimal(28,10)")
    inexact = F.bool_or(_passing(check, column.isNotNull() & exact.isNull()))
    return F.when(inexact, F.lit(None)).otherwise(F.try_sum(_passing(check, exact)))


def _scalar(df: DataFrame, check: Check) -> Column:
    if check.kind == "countrow":
        return F.count(_passing(check, F.lit(1)))
    column = F.col(check.column)
    value = {
        "countnonnull": lambda: F.count(_passing(check, column)),
        "sum": lambda: _sum(df, check),
        "min": lambda: F.min(_passing(check, column)),
        "max": lambda: F.max(_passing(check, column)),
        "firstdate": lambda: _extreme_day(df, check, F.min),
        "lastdate": lambda: _extreme_day(df, check, F.max),
    }
    return value[check.kind]()


def _extreme_day(df: DataFrame, check: Check, extreme) -> Column:
    """First or last day of a column as ``yyyyMMdd``.

    A day or moment is formatted once per result, as formatting keeps its order;
    text has to be read as a date row by row.
    """
    column = F.col(check.column)
    if isinstance(df.schema[check.column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.date_format(extreme(_passing(check, column)), "yyyyMMdd")
    return extreme(_passing(check, F.date_format(column, "yyyyMMdd")))


def _labels(check: Check, group_key: str, group_value: Column) -> list[Column]:
    return [
        F.lit(check.index).cast("int").alias("index"),
        F.lit(check.table).alias("Table"),
        F.lit(check.column).alias("Column"),
        F.lit(check.kind).alias("KeyCheck"),
        F.lit(group_key).alias("KeyGroupby"),
        group_value.cast("string").alias("groupbyValue"),
    ]


def _row(check: Check, value: Column, group_key: str = "", group_value: Column | None = None) -> Column:
    group_value = F.lit("") if group_value is None else group_value
    return F.struct(*_labels(check, group_key, group_value), value.try_cast(VALUE).alias("value"))


def _group_text(name: str) -> Column:
    column = F.col("__group")
    if name.lower() in DATE_GROUPS:
        return F.date_format(column.cast("string").try_cast("timestamp"), "yyyyMMdd")
    return column.cast("string")


def _scalars(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All ungrouped checks of a table in one aggregate over one scan."""
    filters = {check.where for check in checks}
    if len(filters) == 1 and (only := filters.pop()):
        # A filter all checks share can be pushed into the scan.
        df = df.filter(F.expr(only))
        checks = [Check(c.index, c.table, c.column, c.kind, c.group_by) for c in checks]
    row = df.agg(*[_scalar(df, check).alias(f"__v{i}") for i, check in enumerate(checks)])
    labelled = [
        _row(check, F.col(f"__v{i}"), check.group_by if check.kind == "countrow" else "")
        for i, check in enumerate(checks)
    ]
    return row.select(F.inline(F.array(*labelled)))


def _groups(df: DataFrame, name: str, checks: Sequence[Check]) -> DataFrame:
    """All counts and sums by one group column in one aggregate."""
    measures = []
    for i, check in enumerate(checks):
        measures.append(F.count(_passing(check, F.lit(1))).alias(f"__n{i}"))
        if check.kind == "sumby":
            measures.append(_sum(df, check).alias(f"__v{i}"))
    grouped = df.groupBy(F.col(name).alias("__group")).agg(*measures)
    rows = F.array(*[
        F.struct(
            F.col(f"__n{i}").alias("n"),
            _row(check, F.col(f"__v{i}" if check.kind == "sumby" else f"__n{i}"), name, _group_text(name)).alias("row"),
        )
        for i, check in enumerate(checks)
    ])
    # A group none of whose rows pass a check's filter has no result for it.
    return grouped.select(F.explode(rows).alias("r")).filter("r.n > 0").select("r.row.*")


def _distinct(df: DataFrame, check: Check) -> DataFrame:
    """One distinct count by an aggregate of its own, which reads one or two columns."""
    rows = df.filter(F.expr(check.where)) if check.where else df
    if check.kind == "distinct":
        counted = rows.agg(F.count_distinct(check.column).alias("__v"))
        return counted.select(F.inline(F.array(_row(check, F.col("__v"), check.group_by))))
    counted = rows.groupBy(F.col(check.group_by).alias("__group")).agg(F.count_distinct(check.column).alias("__v"))
    return counted.select(F.inline(F.array(_row(check, F.col("__v"), check.group_by, _group_text(check.group_by)))))


def _as_text(df: DataFrame, name: str) -> Column | None:
    """A text that two values of a column share if and only if they are equal; None for types that have none here."""
    column, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")  # an hour that comes twice reads the same
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (column + F.lit(0.0)).cast("string")  # minus zero is zero
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampNTZType)):
        return column.cast("string")
    return None


def _distincts(df: DataFrame, checks: Sequence[Check]) -> list[DataFrame]:
    """Distinct counts: those without a group in one scan, those by one group column in one scan each.

    A row becomes a (check, value) pair for each check, and equal pairs are one before they leave
    a task and after; counting them is a second, small aggregate.  So a scan
    gives any number of exact counts, and only pairs travel.
    """
    text = {c.column: _as_text(df, c.column) for c in checks}
    frames = [_distinct(df, c) for c in checks if text[c.column] is None]
    rest = [c for c in checks if text[c.column] is not None]
    for group in dict.fromkeys(c.group_by if c.kind == "countdistinctby" else "" for c in rest):
        own = [c for c in rest if (c.group_by if c.kind == "countdistinctby" else "") == group]
        if len(own) == 1:
            frames.append(_distinct(df, own[0]))
            continue
        pairs = F.array(*[_passing(c, F.struct(F.lit(i).alias("i"), text[c.column].alias("v"))) for i, c in enumerate(own)])
        by = [F.col(group).alias("__group")] if group else []
        once = df.select(*by, F.explode(F.array_compact(pairs)).alias("p")).select(*[F.col("__group") for _ in by], "p.i", "p.v").distinct()
        if not group:
            counted = once.agg(*[F.count(F.when(F.col("i") == i, F.col("v"))).alias(f"__v{i}") for i in range(len(own))])
            frames.append(counted.select(F.inline(F.array(*[_row(c, F.col(f"__v{i}"), c.group_by) for i, c in enumerate(own)]))))
            continue
        counted = once.groupBy("__group", "i").agg(F.count("v").alias("n"))
        rows = F.array(*[F.struct(F.lit(i).alias("i"), _row(c, F.col("n"), group, _group_text(group)).alias("row")) for i, c in enumerate(own)])
        frames.append(counted.select("i", F.explode(rows).alias("r")).filter("i = r.i").select("r.row.*"))
    return frames


def table_metrics(df: DataFrame, checks: Sequence[Check], as_of) -> DataFrame:
    """Results of all checks of one table."""
    frames = []
    scalars = [c for c in checks if c.kind in SCALAR]
    if scalars:
        frames.append(_scalars(df, scalars))
    for name in dict.fromkeys(c.group_by for c in checks if c.kind in GROUPED):
        frames.append(_groups(df, name, [c for c in checks if c.kind in GROUPED and c.group_by == name]))
    frames.extend(_distincts(df, [c for c in checks if c.kind in DISTINCT]))
    return union_by_name(frames, False).withColumn("checked_at", as_timestamp(as_of))


def run_checklist(tables: Mapping[str, DataFrame], checks: Iterable[Check], as_of) -> DataFrame:
    """Results of a checklist over several tables, as one plan."""
    by_table: dict[str, list[Check]] = {}
    for check in sorted(checks, key=lambda c: c.index):
        by_table.setdefault(check.table.lower(), []).append(check)
    named = {name.lower(): df for name, df in tables.items()}
    return union_by_name([table_metrics(named[name], rows, as_of) for name, rows in by_table.items()], False)


def checklist(rows: DataFrame) -> list[Check]:
    """Active checks of a checklist table (idx, Table, Column, KeyCheck, groupbyKey,
    additionalSQLFilter, check).  The checklist is configuration, so it is read whole."""
    text = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("Table", "Column", "KeyCheck", "groupbyKey", "additionalSQLFilter")]
    active = rows.filter(F.col("check").cast("int") == 1).select(F.col("idx").cast("int").alias("idx"), *text)
    return [Check(*row) for row in active.orderBy("idx").collect()]


KEYS = ("index", "Table", "Column", "KeyCheck", "KeyGroupby", "groupbyValue")


def reconcile(left: DataFrame, right: DataFrame, left_name: str = "left_value",
              right_name: str = "right_value", tolerance: float = 0.0) -> DataFrame:
    """The same metrics of two stores side by side, with their difference."""
    a = left.select(*KEYS, F.col("value").alias(left_name), F.lit(True).alias("__in_left")).alias("a")
    b = right.select(*[F.col(k).alias(f"__{k}") for k in KEYS], F.col("value").alias(right_name)).alias("b")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEYS])
    joined = a.join(b, same, "full_outer")
    here = F.col("__in_left").isNotNull()
    difference = F.col(left_name) - F.col(right_name)
    equal = F.col(left_name).eqNullSafe(F.col(right_name)) | F.coalesce(F.abs(difference) <= tolerance, F.lit(False))
    both = here & F.col("__index").isNotNull()
    return joined.select(
        *[F.when(here, F.col(k)).otherwise(F.col(f"__{k}")).alias(k) for k in KEYS],
        left_name, right_name, difference.alias("difference"), (both & equal).alias("agrees"),
    )

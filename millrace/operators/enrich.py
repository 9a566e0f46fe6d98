"""Fill, resolve and propagate attributes of existing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ColumnOrName, col_of
from millrace.operators.merge import merge, on_map, s, t


def fill_once(target: DataFrame, source: DataFrame, on: Mapping[str, str] | Sequence[str], guard: str,
              values: Mapping[str, Column], insert: bool = True, action: str | None = None) -> DataFrame:
    """Write values only where the guard column is still NULL; optionally add unseen keys.

    ``values`` maps target columns to expressions over the merge source.
    """
    on = on_map(on)
    row = {mine: s(theirs) for mine, theirs in on.items()} | dict(values)
    return merge(target, source, on, values, row if insert else None, t(guard).isNull(), action=action)


def backfill(df: DataFrame, source: DataFrame, on: Mapping[str, str], column: str, value: str, only: Column) -> DataFrame:
    """Fill a missing value from the source for rows meeting a condition; others stay."""
    side = source.select(*[F.col(theirs).alias(f"__b{i}") for i, theirs in enumerate(on.values())],
                         F.col(value).alias("__value"))
    condition = F.coalesce(only, F.lit(False))
    for i, mine in enumerate(on):
        condition = condition & (F.col(mine) == F.col(f"__b{i}"))
    joined = df.join(side, condition, "left")
    return joined.select(*[F.coalesce(F.col(c), F.col("__value")).alias(c) if c == column else F.col(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName],
                  take: Sequence[str]) -> DataFrame:
    """Columns of each key's first row in ascending order, by a partial aggregate.

    The order should be total; NULL sorts first, as in an ascending sort.
    """
    row = F.min(F.struct(*[col_of(c).alias(f"__o{i}") for i, c in enumerate(order)], *take))
    return df.groupBy(*keys).agg(row.alias("__first")).select(*keys, *[F.col("__first")[c].alias(c) for c in take])


def first_after(starts: DataFrame, events: DataFrame, key: str, start: str, moment: str,
                order: Sequence[ColumnOrName], take: Sequence[str]) -> DataFrame:
    """For each key, the first event later than its start.

    ``starts`` has one row per key and is narrow; ``events`` may hold a hot key,
    whose rows adaptive execution splits in the join.  The first event per key
    then comes from a partial aggregate.
    """
    begin = starts.select(F.col(key).alias("__key"), F.col(start).alias("__start")).filter(F.col("__start").isNotNull())
    later = events.join(begin, (F.col(key) == F.col("__key")) & (F.col(moment) > F.col("__start")))
    return first_per_key(later, [key], order, take)


def resolve_attribute(df: DataFrame, candidates: DataFrame, member: str, attribute: str,
                      order: Sequence[ColumnOrName], known: Column | None = None, conflict: str = "ERR") -> DataFrame:
    """One attribute value for every row of the members under consideration.

    ``candidates`` lists the members and a proposed value.  A member without a
    known value among the rows meeting ``known`` takes its first candidate's
    value; with exactly one it takes that; with several it is a conflict.
    Whether there are 0, 1 or more values follows from the smallest and greatest
    one, so no distinct values are gathered.  Other members keep their values.
    """
    first = first_per_key(candidates.withColumn("__m", F.trim(member)), ["__m"], order, [attribute])
    first = first.withColumnRenamed(attribute, "__proposed")
    rows = df if known is None else df.filter(known)
    seen = rows.groupBy(F.trim(member).alias("__n")).agg(
        F.min(attribute).alias("__low"), F.max(attribute).alias("__high")
    )
    verdict = first.join(seen, F.col("__m") == F.col("__n"))
    value = (
        F.when(F.col("__low").isNull(), F.col("__proposed"))
        .when(F.col("__low") == F.col("__high"), F.col("__low"))
        .otherwise(F.lit(conflict))
    )
    verdict = verdict.select("__m", value.alias("__value"))
    joined = df.join(verdict, F.trim(member) == F.col("__m"), "left")
    resolved = F.when(F.col("__m").isNotNull(), F.col("__value")).otherwise(F.col(attribute))
    return joined.select(*[resolved.alias(c) if c == attribute else F.col(c) for c in df.columns])


def propagate_flag(df: DataFrame, qualifying: DataFrame, member: str, into: str, value: str = "Y") -> DataFrame:
    """Set a flag on every row of the members that qualify; others keep theirs."""
    members = qualifying.select(F.trim(member).alias("__m")).distinct()
    joined = df.join(members, F.trim(member) == F.col("__m"), "left")
    old = F.col(into) if into in df.columns else F.lit(None).cast("string")
    flag = F.when(F.col("__m").isNotNull(), F.lit(value)).otherwise(old)
    return joined.select(*[F.col(c) for c in df.columns if c != into], flag.alias(into))

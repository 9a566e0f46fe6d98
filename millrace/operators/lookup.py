"""Resolve business keys and split the input into loaded and explained rows.

Lookup tables are joined without a hint: Spark broadcasts one only if its
measured size is below the session's threshold, and otherwise shuffles both
sides and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.conform import trim_text

ERROR = "Error"


@dataclass(frozen=True)
class Split:
    """An annotated frame: ``Error`` is NULL for loaded rows, else the reason.

    Both halves come from one pass over the lookups; a sink that writes both
    partitions the annotated frame by reason and so runs them once.  ``others``
    are the rows of the frame that hold every rejected one, if a later step left them out.
    """

    frame: DataFrame
    error: str = ERROR
    others: DataFrame | None = None

    @property
    def matched(self) -> DataFrame:
        return self.frame.filter(F.col(self.error).isNull()).drop(self.error)

    @property
    def rejected(self) -> DataFrame:
        return (self.frame if self.others is None else self.others).filter(F.col(self.error).isNotNull())

    def map(self, change) -> Split:
        return Split(change(self.frame), self.error, None if self.others is None else change(self.others))

    def counts(self, source: DataFrame) -> DataFrame:
        """One row: input, loaded and rejected rows, and whether they add up.

        They do not if a lookup table holds a key twice.
        """
        reason = F.col(self.error)
        found = self.frame.agg(
            F.count(F.when(reason.isNull(), 1)).alias("matched"),
            F.count(reason).alias("rejected"),
        )
        total = source.agg(F.count(F.lit(1)).alias("n")).scalar()
        return found.select(
            total.alias("input"), "matched", "rejected",
            (total == F.col("matched") + F.col("rejected")).alias("complete"),
        )


@dataclass(frozen=True)
class Lookup:
    """A lookup table, the keys it is joined on (input column -> its column) and what it gives."""

    table: DataFrame
    on: Mapping[str, str]
    values: Sequence[str]
    when: Column | None = None


def mapping_table(df: DataFrame, condition: Column, columns: Sequence[str]) -> DataFrame:
    """Filtered, trimmed and deduplicated lookup table."""
    return trim_text(df.filter(condition).select(*columns)).dropDuplicates()


def assert_unique(table: DataFrame, keys: Sequence[str], what: str = "lookup table") -> None:
    """Refuse a table that holds a key twice (it would multiply rows)."""
    double = table.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if double:
        raise ValueError(f"{what} has a repeated key: {double[0].asDict()}")


def _joined(df: DataFrame, lookup: Lookup, number: int, unless: Column | None) -> tuple[DataFrame, Column, dict[str, str]]:
    prefix = f"__l{number}_"
    keys = {mine: f"{prefix}k{i}" for i, mine in enumerate(lookup.on)}
    values = {value: f"{prefix}v{i}" for i, value in enumerate(lookup.values)}
    side = lookup.table.select(
        *[F.col(theirs).alias(keys[mine]) for mine, theirs in lookup.on.items()],
        *[F.col(value).alias(alias) for value, alias in values.items()],
    )
    condition = reduce(Column.__and__, [F.col(mine) == F.col(alias) for mine, alias in keys.items()])
    for extra in (lookup.when, unless):
        if extra is not None:
            condition = condition & extra
    hit = F.col(next(iter(keys.values()))).isNotNull()
    return df.join(side, condition, "left"), hit, values


def lookup_any(df: DataFrame, lookups: Sequence[Lookup], reason: str | Column, unique: bool = False,
               error: str = ERROR) -> Split:
    """Try each lookup for the rows no earlier one resolved; reject the rest.

    Every lookup is one left join.  A row already resolved, or already rejected
    by an earlier step, takes no part in later joins, so it cannot be multiplied
    by them.  Rows keep their columns; a looked-up column replaces one of the
    same name.
    """
    kept = [c for c in df.columns if c != error]
    earlier = F.col(error) if error in df.columns else None
    done = earlier.isNotNull() if earlier is not None else None
    hits: list[Column] = []
    found: dict[str, list[Column]] = {}
    for number, lookup in enumerate(lookups):
        if unique:
            assert_unique(lookup.table, list(lookup.on.values()))
        open_row = reduce(Column.__and__, [~h for h in ([done] if done is not None else []) + hits], F.lit(True))
        df, hit, values = _joined(df, lookup, number, open_row if hits or done is not None else None)
        hits.append(hit)
        for value, alias in values.items():
            found.setdefault(value, []).append(F.col(alias))
    resolved = reduce(Column.__or__, hits)
    why = F.when(~resolved, F.lit(reason) if isinstance(reason, str) else reason)
    if earlier is not None:
        why = F.coalesce(earlier, why)
    columns = [F.col(f"`{c}`") for c in kept if c not in found]
    values = [F.coalesce(*options).alias(name) for name, options in found.items()]
    return Split(df.select(*columns, *values, why.cast("string").alias(error)), error)


def lookup(df: DataFrame, table: DataFrame, on: Mapping[str, str], values: Sequence[str], reason: str,
           unique: bool = False, error: str = ERROR) -> Split:
    """Match or reject with one lookup table."""
    return lookup_any(df, [Lookup(table, on, values)], reason, unique, error)


def enrich(df: DataFrame, table: DataFrame, on: Mapping[str, str], values: Mapping[str, str]) -> DataFrame:
    """Left join that adds columns (table column -> new name); misses give NULL."""
    joined, _, aliases = _joined(df, Lookup(table, on, list(values)), 0, None)
    taken = set(values.values())
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in taken],
        *[F.col(aliases[old]).alias(new) for old, new in values.items()],
    )


def flag_present(df: DataFrame, table: DataFrame, on: Mapping[str, str], into: str) -> DataFrame:
    """1 if the key occurs in the table, else 0; rows are not multiplied."""
    keys = table.select(*on.values()).distinct()
    joined, hit, _ = _joined(df, Lookup(keys, on, []), 0, None)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != into],
                         F.when(hit, 1).otherwise(0).alias(into))

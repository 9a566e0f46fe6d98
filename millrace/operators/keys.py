"""Latest rows, flags and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.columns import ColumnOrName, col_of
from millrace.scratch import materialise

_RANK, _PLACE, _BEST = "__rank", "__place", "__best"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order.

    ``row_number() <= 1`` lets Spark keep one row per key in every task before
    the exchange, so a hot key sends one row per task and not all its rows.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def all_but_latest(df: DataFrame, keys: Sequence[str], newest_by: Sequence[ColumnOrName]) -> DataFrame:
    """Every row of a key except the one with the greatest ``newest_by``.

    ``newest_by`` must be unique within a key.  The greatest value is found by a
    partial aggregate; the rows themselves are joined, never gathered per key.
    """
    best = F.struct(*[col_of(c) for c in newest_by])
    newest = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.max(best).alias(_BEST))
    same_key = _all_equal(df, keys, [f"__k{i}" for i in range(len(keys))])
    joined = df.join(newest, same_key)
    return joined.filter(~best.eqNullSafe(F.col(_BEST))).select(*df.columns)


def _all_equal(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> Column:
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & df[a].eqNullSafe(F.col(b))
    return condition


def flag_latest(df: DataFrame, group: str, newest_by: Sequence[str], unique_key: str, into: str,
                is_open: Column, rank_open_only: bool = False) -> DataFrame:
    """1 for the open row that ranks first in its group, else 0.

    Closed rows take part in the ranking unless ``rank_open_only``.  One winner
    per group is found by a partial aggregate and joined on the unique key, so a
    group that holds a third of the table is never sorted or joined as a whole.
    Ties are broken by the greatest ``unique_key``.
    """
    ranked = df.filter(is_open) if rank_open_only else df
    winners = (
        ranked.groupBy(group)
        .agg(F.max(F.struct(*newest_by, unique_key)).alias(_BEST))
        .select(F.col(_BEST)[unique_key].alias("__winner"))
    )
    rest = [F.col(c) for c in df.columns if c != into]
    flag = F.when(is_open & F.col("__winner").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return df.join(winners, df[unique_key] == F.col("__winner"), "left").select(*rest, flag.alias(into))


def highest(df: DataFrame, key: str) -> Column:
    """Greatest key of a table, 0 when it is empty: a scalar subquery, no collect."""
    return F.coalesce(df.agg(F.max(key).cast("bigint").alias("m")).scalar(), F.lit(0).cast("bigint"))


def number_rows(df: DataFrame, order: Sequence[ColumnOrName], into: str,
                after: Column | int = 0, tasks: int | None = None) -> DataFrame:
    """Dense numbers ``after + 1 ...`` in the given total order.

    The rows are range-partitioned and sorted by the order, each gets its place
    within its task, and the place is turned into a number by the row counts of
    the tasks before.  The places are written once, so the numbers cannot move
    when a task is run again.  Only one count per task reaches the driver.
    ``order`` must be a total order; its last columns break ties and also let
    the range partitioner cut through a value many rows share.
    """
    order = [col_of(c) for c in order]
    # Without a fixed count adaptive execution merges neighbouring small ranges.
    ranged = df.repartitionByRange(tasks, *order) if tasks else df.repartitionByRange(*order)
    placed = ranged.sortWithinPartitions(*order).withColumn(_PLACE, F.monotonically_increasing_id())
    placed = materialise(placed, "numbering")
    # monotonically_increasing_id: task number in the upper bits, place in the lower 33.
    task = F.shiftright(F.col(_PLACE), 33)
    within = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    counts = dict(placed.groupBy(task.alias("t")).agg(F.max(within) + 1).collect())
    before = [0, *accumulate(counts.get(t, 0) for t in range(max(counts, default=0)))]
    starts = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    base = F.lit(after).cast("bigint") if isinstance(after, int) else after
    number = base + F.get(starts, task.cast("int")) + within + 1
    return placed.withColumn(into, number).drop(_PLACE)


def allocate_keys(df: DataFrame, key: str, order: Sequence[ColumnOrName], existing: DataFrame | None = None,
                  tasks: int | None = None, stage: bool = False) -> DataFrame:
    """Give rows without a key the next numbers in business-key order.

    Numbers continue after the greatest key of ``existing`` (default: of ``df``).
    Rows with and without a key are two reads of ``df``; ``stage`` writes a
    computed ``df`` once so that its joins do not run for each of them.
    """
    kind = df.schema[key].dataType
    if stage:
        df = materialise(df, "keyed")
    known = df.filter(F.col(key).isNotNull())
    fresh = number_rows(df.filter(F.col(key).isNull()), order, key, highest(existing if existing is not None else df, key), tasks)
    # A plain cast: a number beyond the key's type must fail, not become NULL.
    return known.unionByName(fresh.withColumn(key, F.col(key).cast(kind)))


def file_keys(files: DataFrame, ledger: DataFrame, name: str = "FileName", key: str = "FileKey") -> DataFrame:
    """One key per distinct file name, in name order, after the ledger's greatest key."""
    return number_rows(files.select(name).distinct(), [name], key, highest(ledger, key))

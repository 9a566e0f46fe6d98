"""Aggregates joined back to their rows, and staged totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def join_back(df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column], where: Column | None = None) -> DataFrame:
    """Add group totals to every row.

    The totals come from a partial aggregate and are joined back, NULL-safe on
    the keys.  A window would give the same result but sort a hot group in one
    task; here adaptive execution can split that group's rows.
    """
    names = {k: f"__g{i}" for i, k in enumerate(keys)}
    rows = df if where is None else df.filter(where)
    grouped = rows.groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(
        *[total.alias(name) for name, total in totals.items()]
    )
    condition = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return df.join(grouped, condition, "left").drop(*names.values())


def net_refunds(df: DataFrame, keys: Sequence[str], quantity: str, amount: str, where: Column | None = None,
                quantity_type: str = "decimal(15,3)", amount_type: str | None = None) -> DataFrame:
    """Keep sales (quantity not negative) and give them their transaction's net total.

    Quantity and amount become the sum over the keys, refunds included; several
    sales of one transaction each carry the full total.  Rows outside ``where``
    pass through unchanged and take no part in the join with the totals.
    """
    net, others = net_parts(df, keys, quantity, amount, where, quantity_type, amount_type)
    return net if others is None else others.unionByName(net)


def net_parts(df: DataFrame, keys: Sequence[str], quantity: str, amount: str, where: Column | None = None,
              quantity_type: str = "decimal(15,3)", amount_type: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """What :func:`net_refunds` gives in two frames: the sales with their net totals, and the rows outside ``where`` (None without it)."""
    amount_kind = amount_type or df.schema[amount].dataType
    # Text is read as a number first; what is no number is no sale.
    typed = df.withColumns({
        name: F.col(name).try_cast(kind)
        for name, kind in ((quantity, quantity_type), (amount, amount_kind))
        if isinstance(df.schema[name].dataType, T.StringType)
    })
    rows = typed if where is None else typed.filter(where)
    sales = join_back(rows, keys, {"__quantity": F.sum(quantity), "__amount": F.sum(amount)}).filter(F.col(quantity) >= 0)
    net = sales.withColumns({quantity: F.col("__quantity").cast(quantity_type), amount: F.col("__amount").cast(amount_kind)}).drop("__quantity", "__amount")
    if where is None:
        return net, None
    others = typed.filter(~F.coalesce(where, F.lit(False)))
    return net, others.withColumns({quantity: F.col(quantity).cast(quantity_type), amount: F.col(amount).cast(amount_kind)})


def staged_total(df: DataFrame, fine: Sequence[str], coarse: Sequence[str], amount: str, latest: str,
                 into: str, latest_into: str) -> DataFrame:
    """Sum per fine key, then per coarse key with the greatest ``latest`` value.

    Both levels aggregate before they shuffle, and a sum of sums is a sum, so one
    grouping gives the same result as two.
    """
    if not set(coarse) | {latest} <= set(fine):
        raise ValueError("the fine key must contain the coarse key and the latest column")
    return df.groupBy(*coarse).agg(F.sum(amount).alias(into), F.max(latest).alias(latest_into))


def day_with_cutoff(day_key: Column, clock_text: Column, cutoff: str) -> Column:
    """Business day of a ``yyyyMMdd`` key: times before the cutoff count to the day before."""
    day = F.to_date(day_key.cast("string"), "yyyyMMdd")
    return F.when(clock_text < cutoff, F.date_sub(day, 1)).otherwise(day)


def value_counts(df: DataFrame, column: str, into: str = "count") -> DataFrame:
    """Frequency of each non-NULL value."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(into))

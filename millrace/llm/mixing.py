"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power of an exponent, normalised: 1 keeps
the natural shares, 0 makes all sources equal.  The exponent is bisected until the
mix has a target entropy, or until no source is repeated more often than a limit
while every source is used whole at least once (or the mix has a stated budget).

The weights are realised as token quotas.  A source's documents are dealt into blocks
(about the square root of their number, so that neither a source nor a block is too
large for one task), blocks and the documents in them are permuted by hashes, and
the quota takes whole passes over the permutation and then its longest beginning that
fits; the mix is therefore the same on every run, and never over a quota.

Sources are never collected: each step of the bisection is one aggregate over their
totals that tries many exponents at once.

Defined results: a null source is a source of its own; null and empty texts have no
tokens; a source without tokens is used once with weight 0; rows that repeat another
in key and text share its fate; an empty table gives an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.runtime import Workspace, ship

#: Exponents tried in one step of the bisection, and steps.
TRIED, STEPS = 32, 7
LIMIT, SEED = 2.0, 20240
_WORDS = r"\s+"


def token_count(text: Column) -> Column:
    """Words between white space."""
    body = F.trim(F.coalesce(text, F.lit("")))
    return F.when(body == "", 0).otherwise(F.size(F.split(body, _WORDS))).cast("bigint")


def _row_key(seed: int) -> Column:
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")), F.lit(seed))


def _measured(totals: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """Entropy of the mix, and the largest and smallest ratio of weight to natural share, for each exponent."""
    share = F.col("share")
    sums = []
    for i, e in enumerate(exponents):
        power = F.pow(share, F.lit(e))
        sums += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log(share)).alias(f"s{i}"), F.max(power / share).alias(f"a{i}"), F.min(power / share).alias(f"b{i}")]
    row = totals.filter("share > 0").agg(*sums).first()
    return [(math.log(row[f"z{i}"]) - e * row[f"s{i}"] / row[f"z{i}"], row[f"a{i}"] / row[f"z{i}"], row[f"b{i}"] / row[f"z{i}"]) for i, e in enumerate(exponents)]


def find_exponent(totals: DataFrame, limit: float | None = LIMIT, entropy: float | None = None, budget_ratio: float | None = None) -> float:
    """The exponent of the mix.

    ``entropy``: the one between 0 and 16 whose mix has this entropy in nats, as near as can be.  Else
    the smallest one between 0 and 1 that repeats no source more than ``limit`` times,
    the budget being ``budget_ratio`` times all tokens, or as small as uses each source once.
    """
    low, high = (0.0, 16.0) if entropy is not None else (0.0, 1.0)

    def enough(h: float, most: float, least: float) -> bool:
        if entropy is not None:
            return h <= entropy
        return (most * budget_ratio if budget_ratio else most / least) <= limit * (1 + 1e-12)

    if enough(*_measured(totals, [low])[0]):
        return low
    if not enough(*_measured(totals, [high])[0]):
        if entropy is None:
            raise ValueError("the budget repeats even the natural mix more often than the limit")
        return high
    for _ in range(STEPS):
        tried = [low + (high - low) * i / (TRIED + 1) for i in range(1, TRIED + 1)]
        good = [enough(*m) for m in _measured(totals, tried)]
        first = good.index(True) if any(good) else TRIED
        low, high = ([low, *tried][first], [*tried, high][first])
    return high


def plan_mix(slim: DataFrame, work: Workspace, limit: float | None = LIMIT, entropy: float | None = None, budget_ratio: float | None = None) -> DataFrame:
    """One row for each source: weight, whole passes, and up to where the last pass goes in the permutation."""
    counted = slim.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    all_tokens = F.lit(counted.agg(F.sum("tokens")).first()[0] or 0).cast("double")
    totals = work.put(counted.withColumn("share", F.when(all_tokens > 0, F.col("tokens") / all_tokens).otherwise(0.0)), "totals")
    if totals.filter("share > 0").isEmpty():
        return totals.select("source", F.lit(0.0).alias("weight"), F.lit(1).cast("bigint").alias("passes"), *_nowhere())
    exponent = find_exponent(totals, limit, entropy, budget_ratio)
    (_, _, least), = _measured(totals, [exponent])
    norm = totals.filter("share > 0").agg(F.sum(F.pow("share", F.lit(exponent)))).first()[0]
    weight = F.when(F.col("share") > 0, F.pow("share", F.lit(exponent)) / norm).otherwise(0.0)
    ratio = F.when(F.col("share") > 0, F.col("weight") / F.col("share") * (budget_ratio if budget_ratio else 1 / least)).otherwise(1.0)
    # a source used exactly once or a whole number of times is not cut short by a rounding error
    quotas = (totals.withColumn("weight", weight).withColumn("ratio", ratio).withColumn("passes", F.floor(F.col("ratio") + 1e-9))
              .withColumn("rest", F.floor(F.greatest((F.col("ratio") - F.col("passes")) * F.col("tokens"), F.lit(0.0)) + 1e-6)))
    quotas = work.put(quotas.select("source", "weight", "passes", "rest", F.ceil(F.sqrt("rows")).alias("blocks")), "quotas")
    ordered = _placed(slim, quotas)
    sums = ordered.groupBy("source", "block").agg(F.sum("n_tokens").alias("held"), F.first("rest").alias("rest"))
    upto = sums.withColumn("end", F.sum("held").over(Window.partitionBy("source").orderBy("block")))
    border = upto.filter(F.col("end") > F.col("rest")).groupBy("source").agg(F.min_by(F.struct("block", (F.col("end") - F.col("held")).alias("before")), "end").alias("at"))
    border = work.put(border.select("source", F.col("at.block").alias("block"), F.col("at.before").alias("before")), "border")
    inside = ordered.alias("o").join(border.alias("b"), F.col("o.source").eqNullSafe(F.col("b.source")) & (F.col("o.block") == F.col("b.block"))).select(
        "o.source", "o.row", "n_tokens", "rest", "before")
    run = inside.withColumn("sum", F.col("before") + F.sum("n_tokens").over(Window.partitionBy("source").orderBy("row")))
    last = run.filter(F.col("sum") <= F.col("rest")).groupBy("source").agg(F.max("row").alias("last_row"))
    q, b, r = quotas.alias("q"), border.alias("b"), last.alias("r")
    return work.put(
        q.join(b, F.col("q.source").eqNullSafe(F.col("b.source")), "left").join(r, F.col("q.source").eqNullSafe(F.col("r.source")), "left")
        .select("q.source", "weight", "passes", "blocks", "last_row",
                F.when(F.col("rest") == 0, F.lit(-(1 << 63))).otherwise(F.col("b.block")).alias("last_block")), "plan")


def _nowhere() -> list[Column]:
    return [F.lit(1).cast("bigint").alias("blocks"), F.lit(-(1 << 63)).cast("bigint").alias("last_block"), F.lit(None).cast("bigint").alias("last_row")]


def _placed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (with source and key) beside their source's plan, with their block's and their own place in the permutation."""
    others = plan.withColumnRenamed("source", "_source")
    joined = rows.join(others, rows["source"].eqNullSafe(others["_source"])).drop("_source")
    block = F.pmod("key", F.col("blocks"))
    return joined.withColumn("block", F.xxhash64(block, F.lit(SEED))).withColumn("row", F.xxhash64("key", F.lit(SEED + 1)))


def mix(docs: DataFrame, limit: float | None = LIMIT, entropy: float | None = None, budget_ratio: float | None = None) -> DataFrame:
    """``docs`` with the columns ``copy`` (from 0), ``n_tokens``, ``weight`` and ``place``: one row for each time a document is used.

    Ordering by ``place`` shuffles the mix.  Columns of these names are replaced.
    """
    spark = ship(docs.sparkSession)
    work = Workspace(spark, "mix")
    source = F.col("source").cast("string").alias("source")
    slim = work.put(docs.select(source, _row_key(SEED).alias("key"), token_count(F.col("text")).alias("n_tokens")), "slim")
    plan = plan_mix(slim, work, limit, entropy, budget_ratio)
    work.drop("slim", "quotas", "border")
    names = [c for c in docs.columns if c not in ("copy", "n_tokens", "weight", "place")]
    packed = docs.select(source, _row_key(SEED).alias("key"), token_count(F.col("text")).alias("n_tokens"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_doc"))
    placed = _placed(packed, plan)
    # without a border all blocks fit; in the border block the rows up to the last that fits
    part = F.when(F.col("last_block").isNull(), True).otherwise(
        (F.col("block") < F.col("last_block")) | ((F.col("block") == F.col("last_block")) & F.coalesce(F.col("row") <= F.col("last_row"), F.lit(False))))
    times = F.col("passes") + F.when(part, 1).otherwise(0)
    used = placed.withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(0).cast("bigint"), times - 1))))
    return used.select(*[F.col("_doc")[c].alias(c) for c in names], "copy", "n_tokens", "weight", F.xxhash64("key", "copy", F.lit(SEED + 2)).alias("place"))

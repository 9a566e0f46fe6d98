"""A key that holds a third of all rows must not hold a third of the work."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.enrich import first_after
from millrace.operators.keys import latest_per_key
from millrace.operators.lookup import lookup
from millrace.operators.merge import upsert_full
from millrace.operators.totals import net_refunds


@pytest.fixture
def small_joins(spark):
    """Force shuffled joins and a low skew threshold, so that a small table behaves like a large one."""
    changes = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
               "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in changes}
    for k, v in changes.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, rows=90_000):
    """A third of the rows has key 0, every tenth of the rest no key."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id"))
    # Many input files, as adaptive execution splits a hot partition between map outputs.
    return spark.range(0, rows, 1, 24).select(key.alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_splits_a_hot_key(spark, small_joins):
    table = spark.range(30_000).select(F.col("id").alias("c"), (F.col("id") * 2).alias("v"))
    split = lookup(hot(spark), table, {"k": "c"}, ["v"], "no")
    assert "skewed" in final_plan(split.frame)
    assert split.counts(hot(spark)).first().complete


def test_upsert_splits_a_hot_target_key(spark, small_joins):
    source = spark.range(100).select(F.col("id").alias("k"), F.lit(-1).cast("bigint").alias("id"), F.lit("new").alias("pad"))
    merged = upsert_full(hot(spark), source, ["k"])
    assert "skewed" in final_plan(merged)
    assert merged.filter("k = 0").groupBy("action").count().collect()[0][:] == ("UPDATED", 30_000)


def test_netting_splits_a_hot_group(spark, small_joins):
    rows = hot(spark).select("k", "pad", F.lit(1).cast("decimal(15,3)").alias("q"), F.lit(2).cast("decimal(18,2)").alias("a"))
    net = net_refunds(rows, ["k"], "q", "a")
    assert "skewed" in final_plan(net)
    assert net.filter("k = 0").agg(F.min("q").cast("int"), F.max("a").cast("int"), F.count("*")).first()[:] == (30_000, 60_000, 30_000)


def test_latest_row_sends_one_row_per_key_and_task(spark, small_joins):
    newest = latest_per_key(hot(spark), ["k"], [F.col("id").desc()])
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert newest.filter("k = 0").first().id == 89_997


def test_first_after_on_a_hot_key(spark, small_joins):
    events = hot(spark).select("k", F.col("id").alias("m"), "id")
    starts = spark.range(1).select(F.col("id").alias("k"), F.lit(1000).alias("b"))
    found = first_after(starts, events, "k", "b", "m", ["m", "id"], ["id"])
    assert [r[:] for r in found.collect()] == [(0, 1002)]
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()  # no copies of the starts

"""The same results in the shapes this library avoids, for the benchmark to compare with.

Each entry gives the rows of the case of the same name: an inner join plus an
anti join per lookup, three joins per upsert, one window over all rows for
numbering, a window sum for netting, and one aggregate per metric.
"""

from functools import reduce

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cases.base import tables
from cases.lookups import LINE, PARTS
from cases.quality import LINE_CHECKS


def split_by_two_joins(spark, sf):
    line, part = tables(spark, sf, "lineitem", "part")
    known = part.filter(PARTS).select(F.col("p_partkey").alias("l_partkey"), "p_brand").dropDuplicates()
    rows = line.select(*LINE)
    hit = rows.join(known, "l_partkey", "inner").withColumn("error", F.lit(None).cast("string"))
    miss = rows.join(known, "l_partkey", "left_anti").withColumn("error", F.lit("Mismatch ProductKey"))
    return hit.unionByName(miss, allowMissingColumns=True)


def netting_by_window(spark, sf):
    line = tables(spark, sf, "lineitem")
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    rows = line.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") * sign).cast("decimal(15,3)").alias("q"),
                       (F.col("l_extendedprice") * sign).cast("decimal(18,2)").alias("a"))
    order = W.partitionBy("l_orderkey")
    return rows.withColumns({"quantity": F.sum("q").over(order), "amount": F.sum("a").over(order)}).filter("q >= 0").drop("q", "a")


def upsert_by_three_joins(spark, sf):
    orders = tables(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    target = orders.filter("o_orderkey % 2 = 0")
    source = orders.filter("o_orderkey % 3 = 0 or o_orderkey % 2 = 1").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    keys = target.select("o_orderkey")
    parts = [target.join(source, "o_orderkey", "left_anti").withColumn("action", F.lit("NOT MATCHED")),
             source.join(keys, "o_orderkey", "inner").withColumn("action", F.lit("UPDATED")),
             source.join(keys, "o_orderkey", "left_anti").withColumn("action", F.lit("INSERT"))]
    return reduce(lambda a, b: a.unionByName(b), parts)


def keys_by_one_window(spark, sf):
    orders = tables(spark, sf, "orders")
    keyed = orders.select("o_orderkey", "o_orderdate", F.when(F.expr("o_orderkey % 2 = 0"), F.col("o_orderkey") + 1).alias("order_sk"))
    last = keyed.agg(F.max("order_sk")).collect()[0][0]
    number = F.row_number().over(W.orderBy("o_orderdate", "o_orderkey"))
    return keyed.filter("order_sk is not null").unionByName(keyed.filter("order_sk is null").withColumn("order_sk", number + last))


def flag_by_window(spark, sf):
    orders = tables(spark, sf, "orders")
    newest = W.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
    rank = F.row_number().over(newest)
    return orders.select("o_orderkey", F.when((F.col("o_orderstatus") != "F") & (rank == 1), 1).otherwise(0).alias("latest"))


def metrics_one_by_one(spark, sf):
    line = tables(spark, sf, "lineitem")
    kinds = {
        "countrow": lambda c: F.count(F.lit(1)), "sum": lambda c: F.sum(F.col(c).cast("decimal(28,10)")), "max": F.max, "min": F.min,
        "firstdate": lambda c: F.min(F.date_format(c, "yyyyMMdd")), "lastdate": lambda c: F.max(F.date_format(c, "yyyyMMdd")),
        "distinct": F.count_distinct, "countnonnull": F.count}
    frames = []
    for check in LINE_CHECKS:
        rows = line.filter(check.where) if check.where else line
        value = kinds[check.kind](check.column).cast("decimal(36,5)").cast("double").alias("value")
        frames.append(rows.agg(value).withColumn("index", F.lit(check.index)))
    return reduce(lambda a, b: a.unionByName(b), frames)


SHAPES = {
    "lookup_split": split_by_two_joins, "refund_netting": netting_by_window, "upsert_whole_rows": upsert_by_three_joins,
    "surrogate_keys": keys_by_one_window, "latest_flag": flag_by_window, "metrics_scalar": metrics_one_by_one,
}

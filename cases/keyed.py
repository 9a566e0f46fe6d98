"""Latest rows, flags, surrogate keys, projections and cleaning."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cases.base import case, day, tables
from millrace.functions import columns as c
from millrace.functions.conform import (conform_table, fill_by_type, fill_columns, fill_text, nulls_from,
                                        recode_columns, trim_text, try_cast_columns)
from millrace.operators.keys import (all_but_latest, allocate_keys, flag_latest, highest, latest_per_key, number_rows)
from millrace.operators.totals import value_counts


@case("""
select o_custkey, o_orderkey, o_totalprice from
  (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r from orders)
where r = 1""")
def latest_per_customer(spark, sf):
    orders = tables(spark, sf, "orders")
    newest = latest_per_key(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return newest.select("o_custkey", "o_orderkey", "o_totalprice")


@case("""
select o_custkey, o_orderkey from
  (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r from orders)
where r > 1""")
def all_but_latest_per_customer(spark, sf):
    orders = tables(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return all_but_latest(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@case("""
select o_orderkey, case when o_orderstatus <> 'F' and
  row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1 then 1 else 0 end as latest
from orders""")
def latest_flag(spark, sf):
    orders = tables(spark, sf, "orders")
    return flag_latest(orders, "o_custkey", ["o_orderdate"], "o_orderkey", "latest",
                       F.col("o_orderstatus") != "F").select("o_orderkey", "latest")


@case("""
select o_orderkey, case when o_orderstatus <> 'F' and row_number() over
  (partition by o_custkey, o_orderstatus <> 'F' order by o_orderdate desc, o_orderkey desc) = 1 then 1 else 0 end as latest
from orders""")
def latest_flag_open_only(spark, sf):
    orders = tables(spark, sf, "orders")
    return flag_latest(orders, "o_custkey", ["o_orderdate"], "o_orderkey", "latest",
                       F.col("o_orderstatus") != "F", rank_open_only=True).select("o_orderkey", "latest")


@case("""
with keyed as (select o_orderkey, o_orderdate, case when o_orderkey % 2 = 0 then o_orderkey + 1 end as k from orders)
select o_orderkey, k as order_sk from keyed where k is not null
union all
select o_orderkey, (select max(k) from keyed) + row_number() over (order by o_orderdate, o_orderkey) from keyed
where k is null""")
def surrogate_keys(spark, sf):
    orders = tables(spark, sf, "orders")
    keyed = orders.select("o_orderkey", "o_orderdate",
                          F.when(F.expr("o_orderkey % 2 = 0"), F.col("o_orderkey") + 1).alias("order_sk"))
    return allocate_keys(keyed, "order_sk", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@case("""
select p_brand, p_type, (select max(n_nationkey) from nation) + row_number() over (order by p_brand, p_type) as number
from (select distinct p_brand, p_type from part)""")
def numbers_after(spark, sf):
    part, nation = tables(spark, sf, "part", "nation")
    kinds = part.select("p_brand", "p_type").distinct()
    return number_rows(kinds, ["p_brand", "p_type"], "number", highest(nation, "n_nationkey"))


@case("""
select (select coalesce(max(o_orderkey), 0) from orders) as last_order,
       (select coalesce(max(o_orderkey), 0) from orders where o_orderkey < 0) as none""")
def last_number(spark, sf):
    orders = tables(spark, sf, "orders")
    counted = orders.agg(F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("last_order"))
    return counted.withColumn("none", highest(orders.filter("o_orderkey < 0"), "o_orderkey"))


@case("""select p_type as kind, count(*) as n from part group by 1""")
def value_frequency(spark, sf):
    return value_counts(tables(spark, sf, "part"), "p_type", "n").withColumnRenamed("p_type", "kind")


@case("""
select event_id, try_cast(regexp_extract(props, ': (.*)}', 1) as smallint) as k_short,
       cast(user_id as varchar) as user_text, try_cast(event_type as integer) as type_number,
       cast(ts as date) as day, cast(round(value * 100) as integer) as cents
from events""")
def conform_event_table(spark, sf):
    events = tables(spark, sf, "events")
    schema = T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("k_short", T.ShortType()),
        T.StructField("user_text", T.StringType()), T.StructField("type_number", T.IntegerType()),
        T.StructField("day", T.DateType()), T.StructField("cents", T.IntegerType())])
    wide = events.select(
        "value", "event_id", F.regexp_extract("props", ": (.*)}", 1).alias("k_short"), F.col("user_id").alias("user_text"),
        F.col("event_type").alias("type_number"), F.col("ts").alias("day"),
        F.round(F.col("value") * 100).alias("cents"))
    return conform_table(wide, schema)


_GAPS = """
select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment, '  ' || c_name || ' ' as name,
       case when c_custkey % 3 <> 0 then c_nationkey end as nation,
       case when c_custkey % 4 <> 0 then c_acctbal end as balance,
       case when c_custkey % 5 <> 0 then 'x' || (c_custkey % 2) end as code from customer"""


def _gaps(spark, sf):
    customer = tables(spark, sf, "customer")
    return customer.select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("name"),
        F.when(F.expr("c_custkey % 3 <> 0"), F.col("c_nationkey")).alias("nation"),
        F.when(F.expr("c_custkey % 4 <> 0"), F.col("c_acctbal")).alias("balance"),
        F.when(F.expr("c_custkey % 5 <> 0"), F.concat(F.lit("x"), F.expr("c_custkey % 2"))).alias("code"))


@case(f"""
select c_custkey, coalesce(segment, '') as segment, trim(name) as name, coalesce(nation, 0) as nation,
       coalesce(balance, 0.0) as balance, coalesce(code, '') as code from ({_GAPS})""")
def trim_fill(spark, sf):
    return trim_text(fill_by_type(_gaps(spark, sf)))


@case(f"""
select c_custkey, coalesce(segment, 'NA') as segment, name, nation, balance, coalesce(code, 'NA') as code from ({_GAPS})""")
def fill_text_only(spark, sf):
    return fill_text(_gaps(spark, sf))


@case(f"""
select c_custkey, segment, name, coalesce(nation, 99) as nation, coalesce(balance, -1.0) as balance,
       case when code = 'x0' then null else code end as code from ({_GAPS})""")
def fill_per_column(spark, sf):
    return nulls_from(fill_columns(_gaps(spark, sf), {"nation": 99, "balance": -1.0}), {"code": "x0"})


@case("""
select p_partkey,
  case p_type when 'PROMO' then 'P' when 'ECONOMY' then 'E' else p_type end as recoded,
  case when p_type in ('LARGE', 'MEDIUM') then 'Big' else p_type end as grouped,
  case when p_brand = 'Brand#7' or substring(trim(p_name), 1, 3) = 'red' then 'IN' else 'OUT' end as classified,
  case when p_type = 'PROMO' and p_size <> 38 then 'NA' when p_type = 'PROMO' and p_size = 38 then 'P38'
       else p_brand end as nested,
  case when p_name = 'blue gear' and p_size = 1 then 'NONE' else p_name end as title
from part""")
def relabel(spark, sf):
    part = recode_columns(tables(spark, sf, "part").withColumn("recoded", F.col("p_type")), {"PROMO": "P", "ECONOMY": "E"}, ["recoded"])
    promo = F.col("p_type") == "PROMO"
    return part.select(
        "p_partkey", "recoded", c.same_or("p_type", ["LARGE", "MEDIUM"], "Big").alias("grouped"),
        c.class_by_code_or_prefix("p_brand", "Brand#7", "p_name", "red", "IN", "OUT").alias("classified"),
        F.when(promo & (F.col("p_size") != 38), "NA").when(promo, "P38").otherwise(F.col("p_brand")).alias("nested"),
        F.when((F.col("p_name") == "blue gear") & (F.col("p_size") == 1), "NONE").otherwise(F.col("p_name")).alias("title"))


@case("""
select o_orderkey, cast(strftime(o_orderdate, '%Y') as bigint) as year_key, cast(strftime(o_orderdate, '%m') as bigint) as month_key
from orders""")
def integer_date_parts(spark, sf):
    orders = tables(spark, sf, "orders").select("o_orderkey", day("o_orderdate").alias("d"))
    return orders.select("o_orderkey", c.year_of_key("d").alias("year_key"), c.month_of_key("d").alias("month_key"))


@case("""
with t as (select event_id, strftime(ts, '%Y%m%d %H%M%S') as text from events)
select event_id, try_cast(regexp_extract(text, '([0-9]+) [0-9]+', 1) as integer) as drop_date,
  try_cast(regexp_extract(text, '[0-9]+ ([0-9]+)', 1) as integer) as drop_time,
  replace(text, ' ', '') as drop_text,
  substr(text, 10, 2) || ':' || substr(text, 12, 2) || ':' || substr(text, 14, 2) as clock
from t""")
def parse_compact_time(spark, sf):
    from millrace.plans.cash import clock_text

    events = tables(spark, sf, "events").select("event_id", F.date_format("ts", "yyyyMMdd HHmmss").alias("text"))
    parts = try_cast_columns(events.select(
        "event_id", F.regexp_extract("text", r"([0-9]+) [0-9]+", 1).alias("drop_date"),
        F.regexp_extract("text", r"[0-9]+ ([0-9]+)", 1).alias("drop_time"),
        F.regexp_replace("text", " ", "").alias("drop_text"),
        clock_text(F.trim(F.regexp_replace("text", ".* ", ""))).alias("clock")), {"drop_date": "int", "drop_time": "int"})
    return parts


@case("""
with t as (select event_id, case when event_id % 10 = 0 then 'bad' else strftime(ts, '%d/%m/%Y %H:%M:%S') end as text from events),
p as (select event_id, try_strptime(text, '%d/%m/%Y %H:%M:%S') + interval 7 hours as local from t)
select event_id, cast(strftime(local, '%Y%m%d') as integer) as date_key, cast(strftime(local, '%H%M%S') as integer) as time_key
from p""")
def text_time_keys(spark, sf):
    events = tables(spark, sf, "events")
    text = F.when(F.expr("event_id % 10 = 0"), "bad").otherwise(F.date_format("ts", "dd/MM/yyyy HH:mm:ss"))
    local = c.parse_time(text, "dd/MM/yyyy HH:mm:ss", 7)
    return events.select("event_id", c.date_key(local).alias("date_key"), c.time_key(local).alias("time_key"))

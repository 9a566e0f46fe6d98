"""Upserts, refreshes and slowly changing dimensions on customers and orders."""

from pyspark.sql import functions as F

from cases.base import AS_OF, case, day, tables
from millrace.operators.keys import allocate_keys
from millrace.operators.merge import (insert_only, refresh_keep_keys, s, scd1_current, scd2_status, upsert_changed,
                                      upsert_full)
from millrace.operators.slices import purge_loaded, remove_reloaded, replace_slice, split_hot_cold, supersede_month_to_date
from millrace.plans.sales import merge_members

_ORDERS = """
with t as (select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey % 2 = 0),
s as (select o_orderkey, o_custkey, o_totalprice + 1 as o_totalprice from orders where o_orderkey % 3 = 0 or o_orderkey % 2 = 1),
merged as (
  select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey,
         case when s.o_orderkey is not null then s.o_custkey else t.o_custkey end as o_custkey,
         case when s.o_orderkey is not null then s.o_totalprice else t.o_totalprice end as o_totalprice,
         case when t.o_orderkey is null then 'INSERT' when s.o_orderkey is null then 'NOT MATCHED' else 'UPDATED' end as action
  from t full join s on t.o_orderkey = s.o_orderkey)
"""


def merged_orders(spark, sf):
    orders = tables(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    source = orders.filter("o_orderkey % 3 = 0 or o_orderkey % 2 = 1").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return upsert_full(orders.filter("o_orderkey % 2 = 0"), source, ["o_orderkey"])


@case(_ORDERS + "select * from merged")
def upsert_whole_rows(spark, sf):
    return merged_orders(spark, sf)


@case(_ORDERS + "select action, count(*) as n from merged group by action")
def upsert_actions(spark, sf):
    return merged_orders(spark, sf).groupBy("action").agg(F.count(F.lit(1)).alias("n"))


_SOURCE = """select c_custkey, c_name, nullif(c_mktsegment, case when c_custkey % 5 = 0 then c_mktsegment end) as c_mktsegment,
  case when c_custkey % 9 = 0 then c_acctbal + 100 else c_acctbal end as c_acctbal from customer where c_custkey % 3 = 0 or c_custkey % 2 = 1"""


def _source(customer):
    return customer.filter("c_custkey % 3 = 0 or c_custkey % 2 = 1").select(
        "c_custkey", "c_name", F.when(F.expr("c_custkey % 5 <> 0"), F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(F.expr("c_custkey % 9 = 0"), F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")).alias("c_acctbal"))


@case(f"""
with t as (select c_custkey, c_name, nullif(c_mktsegment, 'BUILDING') as c_mktsegment, c_acctbal from customer where c_custkey % 2 = 0),
s as ({_SOURCE}),
j as (select t.c_custkey as tk, s.c_custkey as sk, t.c_mktsegment as tm, s.c_mktsegment as sm, t.c_acctbal as ta, s.c_acctbal as sa,
             t.c_name as tn, s.c_name as sn from t full join s on t.c_custkey = s.c_custkey)
select coalesce(tk, sk) as c_custkey, case when tk is null then sn else tn end as c_name,
  case when tk is null or (sk is not null and (tm is distinct from sm or ta is distinct from sa)) then sm else tm end as c_mktsegment,
  case when tk is null or (sk is not null and (tm is distinct from sm or ta is distinct from sa)) then sa else ta end as c_acctbal,
  case when tk is null then 'INSERT' when sk is null then 'NOT MATCHED'
       when tm is distinct from sm or ta is distinct from sa then 'UPDATED' else 'SAME' end as action
from j""")
def upsert_changed_rows(spark, sf):
    customer = tables(spark, sf, "customer")
    target = customer.filter("c_custkey % 2 = 0").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"), "c_acctbal")
    from millrace.operators.merge import any_differs, merge
    tracked = {name: s(name) for name in ("c_mktsegment", "c_acctbal")}
    row = {name: s(name) for name in target.columns}
    return merge(target, _source(customer), ["c_custkey"], tracked, row, any_differs(list(tracked)))


@case(f"""
with t as (select c_custkey, c_mktsegment, c_acctbal, 1 as load_key from customer where c_custkey % 2 = 0),
s as ({_SOURCE}),
j as (select t.c_custkey as tk, s.c_custkey as sk, t.c_mktsegment as tm, s.c_mktsegment as sm, t.c_acctbal as ta, s.c_acctbal as sa
      from t full join s on t.c_custkey = s.c_custkey),
f as (select *, tk is null or (sk is not null and (tm is distinct from sm or ta is distinct from sa)) as chg from j)
select coalesce(tk, sk) as c_custkey, case when chg then sm else tm end as c_mktsegment,
  case when chg then sa else ta end as c_acctbal, case when chg then 20240615 else 1 end as load_key from f""")
def upsert_with_load_key(spark, sf):
    from millrace.functions.columns import stamp
    customer = tables(spark, sf, "customer")
    target = customer.filter("c_custkey % 2 = 0").select("c_custkey", "c_mktsegment", "c_acctbal", F.lit(1).alias("load_key"))
    return upsert_changed(target, _source(customer), ["c_custkey"], ["c_mktsegment", "c_acctbal"],
                          {"load_key": stamp(AS_OF)[0]}, action=None)


@case("""
with t as (select c_name, c_custkey + 1000 as sk from customer where c_custkey % 3 = 0 or c_custkey % 7 = 0),
j as (select c.c_name, c.c_acctbal, t.sk from (select * from customer where c_custkey % 7 <> 0) c left join t on c.c_name = t.c_name)
select c_name, c_acctbal, sk from j where sk is not null
union all
select c_name, c_acctbal, (select max(sk) from t) + row_number() over (order by c_name) from j where sk is null""")
def refresh_with_kept_keys(spark, sf):
    customer = tables(spark, sf, "customer")
    target = customer.filter("c_custkey % 3 = 0 or c_custkey % 7 = 0").select("c_name", (F.col("c_custkey") + 1000).alias("sk"))
    source = customer.filter("c_custkey % 7 <> 0").select("c_name", "c_acctbal")
    return allocate_keys(refresh_keep_keys(target, source, ["c_name"], "sk"), "sk", ["c_name"], existing=target)


# Every second customer has an open row, every tenth also a closed one; the source
# knows all customers and has new or lost segments for some.
_DIM = """
dim as (
  select c_custkey, c_mktsegment, c_acctbal, cast(c_custkey as integer) as sk, 20240101 as start_day, 0 as start_time,
         cast(null as integer) as end_day, cast(null as integer) as end_time from customer where c_custkey % 2 = 0
  union all
  select c_custkey, 'OLD', c_acctbal, cast(c_custkey + 1000000 as integer), 20230101, 0, 20231231, 235959 from customer where c_custkey % 10 = 0
  union all
  select c_custkey, 'GONE', c_acctbal, cast(c_custkey + 2000000 as integer), 20230101, 0, 20231231, 235959 from customer where c_custkey % 10 = 1),
src as (
  select c_custkey, case when c_custkey % 14 = 0 then null when c_custkey % 4 = 0 then 'CHANGED' else c_mktsegment end as c_mktsegment,
         case when c_custkey % 6 = 0 then c_acctbal + 1 else c_acctbal end as c_acctbal from customer where c_custkey % 8 <> 0)
"""


def _dimension(spark, sf):
    customer = tables(spark, sf, "customer")

    def rows(keep, segment, offset, start, end_day, end_time):
        return customer.filter(keep).select(
            "c_custkey", segment.alias("c_mktsegment"), "c_acctbal", (F.col("c_custkey") + offset).cast("int").alias("sk"),
            F.lit(start).alias("start_day"), F.lit(0).alias("start_time"),
            F.lit(end_day).cast("int").alias("end_day"), F.lit(end_time).cast("int").alias("end_time"))

    dim = rows("c_custkey % 2 = 0", F.col("c_mktsegment"), 0, 20240101, None, None)
    dim = dim.unionByName(rows("c_custkey % 10 = 0", F.lit("OLD"), 1000000, 20230101, 20231231, 235959))
    dim = dim.unionByName(rows("c_custkey % 10 = 1", F.lit("GONE"), 2000000, 20230101, 20231231, 235959))
    src = customer.filter("c_custkey % 8 <> 0").select(
        "c_custkey",
        F.when(F.expr("c_custkey % 14 <> 0"), F.when(F.expr("c_custkey % 4 = 0"), "CHANGED").otherwise(F.col("c_mktsegment"))).alias("c_mktsegment"),
        F.when(F.expr("c_custkey % 6 = 0"), F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"))
    return dim, src


_VALIDITY = {"start": ("start_day", "start_time"), "end": ("end_day", "end_time")}


@case(f"""
with {_DIM},
j as (select d.*, s.c_custkey as hit, s.c_mktsegment as seg, s.c_acctbal as bal,
             s.c_custkey is not null and not coalesce(d.c_mktsegment = s.c_mktsegment, false) as chg
      from dim d left join src s on d.c_custkey = s.c_custkey and d.end_day is null)
select c_custkey, c_mktsegment, c_acctbal, sk, start_day, start_time, case when chg then 20240615 else end_day end as end_day,
  case when chg then 153005 else end_time end as end_time,
  case when chg then 'UPDATED' when hit is not null then 'SAME' else 'NOT MATCHED' end as action from j
union all
select c_custkey, seg, bal, null, 20240615, 153005, null, null, 'INSERT' from j where chg""")
def scd2_segment(spark, sf):
    dim, src = _dimension(spark, sf)
    return scd2_status(dim, src, ["c_custkey"], "c_mktsegment", AS_OF, 7, **_VALIDITY)


@case(f"""
with {_DIM},
j as (select d.*, s.c_custkey as hit, coalesce(s.c_mktsegment, 'NA') as seg, s.c_acctbal as bal,
             s.c_custkey is not null and (d.c_mktsegment is distinct from coalesce(s.c_mktsegment, 'NA')
             or d.c_acctbal is distinct from s.c_acctbal) as chg
      from dim d left join src s on d.c_custkey = s.c_custkey and d.end_day is null)
select c_custkey, case when chg then seg else c_mktsegment end as c_mktsegment, case when chg then bal else c_acctbal end as c_acctbal,
  sk, start_day, start_time, end_day, end_time, case when chg then 'UPDATED' else 'NOT MATCHED' end as action from j
union all
select c_custkey, coalesce(c_mktsegment, 'NA'), c_acctbal, null, 20240615, 153005, null, null, 'INSERT' from src
where c_custkey not in (select c_custkey from dim)""")
def scd1_attributes(spark, sf):
    dim, src = _dimension(spark, sf)
    return scd1_current(dim, src, ["c_custkey"], ["c_mktsegment", "c_acctbal"],
                        ["sk", "start_day", "start_time", "end_day", "end_time"], AS_OF, 7,
                        defaults={"c_mktsegment": "NA"}, **_VALIDITY)


@case("""
with t as (select p_brand, nullif(p_type, 'PROMO') as p_type from part where p_size <= 2)
select distinct p_brand, p_type from t where p_type is not null
union all
select s.p_brand, s.p_type from (select distinct p_brand, p_type from part) s
where not exists (select 1 from t where t.p_brand = s.p_brand and t.p_type = s.p_type)""")
def dim_insert_only(spark, sf):
    part = tables(spark, sf, "part")
    target = part.filter("p_size <= 2").select("p_brand", F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    return insert_only(target, part, ["p_brand", "p_type"])


@case("""
with d as (select c_custkey as k, c_name as name, cast(null as varchar) as last_priority, 0 as last_day from customer where c_custkey % 2 = 0),
s as (select o_custkey as k, o_orderpriority as p, cast(strftime(o_orderdate, '%Y%m%d') as integer) as od from
      (select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r from orders) where r = 1)
select d.k as c_custkey, d.name as c_name, case when s.k is not null then s.p else d.last_priority end as last_priority,
  case when s.k is not null then s.od else d.last_day end as last_day, case when s.k is not null then 'UPDATE' else 'SAME' end as status
from d left join s on d.k = s.k
union all
select s.k, 'NA', s.p, s.od, 'INSERT' from s where s.k not in (select k from d)""")
def dim_snapshot_merge(spark, sf):
    customer, orders = tables(spark, sf, "customer", "orders")
    dimension = customer.filter("c_custkey % 2 = 0").select(
        "c_custkey", "c_name", F.lit(None).cast("string").alias("last_priority"), F.lit(0).alias("last_day"))
    source = orders.select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey", day("o_orderdate").alias("od"))
    return merge_members(dimension, source, "c_custkey", "o_custkey", ["o_orderdate", "o_orderkey"],
                         {"last_priority": "o_orderpriority", "last_day": "od"}, {"c_name": "NA"})


_LINES = "select l_orderkey, l_linenumber, l_partkey, cast(strftime(l_shipdate, '%Y%m%d') as integer) as ship, l_quantity as q from lineitem"


@case(f"""
with l as ({_LINES}), t as (select * from l where not (l_linenumber > 5 and ship % 100 <= 10)),
s as (select l_orderkey, l_linenumber, l_partkey, ship, q + 1 as q from l where l_linenumber > 5 and ship % 100 <= 10)
select * from t where ship not in (select ship from s) union all select * from s""")
def slice_replace(spark, sf):
    line = tables(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", day("l_shipdate").alias("ship"),
                                                F.col("l_quantity").alias("q"))
    source = line.filter("l_linenumber > 5 and ship % 100 <= 10").withColumn("q", F.col("q") + 1)
    return replace_slice(line.filter("not (l_linenumber > 5 and ship % 100 <= 10)"), source, ["ship"])


_FILES = """
with e as (select event_id, value, event_type || '_' || strftime(ts, '%Y%m%d') as name,
  (cast(strftime(ts, '%j') as integer) * 1000 + ascii(event_type)) * 100 + cast(strftime(ts, '%H') as integer) as file_key from events),
ledger as (select distinct file_key, name from e)
"""


def _files(spark, sf):
    events = tables(spark, sf, "events")
    key = (F.dayofyear("ts") * 1000 + F.ascii("event_type")) * 100 + F.hour("ts")
    rows = events.select("event_id", "value", "event_type", key.alias("FileKey"),
                         F.concat_ws("_", "event_type", F.date_format("ts", "yyyyMMdd")).alias("FileName"))
    return rows, rows.select("FileKey", "FileName").distinct()


@case(_FILES + """
select event_id, file_key from e where file_key not in (
  select file_key from (select *, row_number() over (partition by name order by file_key desc) as r from ledger) where r > 1)""")
def reload_removal(spark, sf):
    rows, ledger = _files(spark, sf)
    fact = rows.select("event_id", "FileKey")
    removal = remove_reloaded(fact, fact.filter("false"), ledger, ledger, before_load=False)
    return removal.fact.withColumnRenamed("FileKey", "file_key")


@case(_FILES + """
select event_id, file_key, 'fact' as part from e where value > 10 and name not like 'click%'
union all select event_id, file_key, 'reject' from e where value <= 10 and name not like 'click%'
union all select null, file_key, 'key' from ledger where name like 'click%'""")
def reload_removal_by_name(spark, sf):
    rows, ledger = _files(spark, sf)
    slim = rows.select("event_id", "FileKey", "value")
    names = ledger.filter(F.col("FileName").startswith("click"))
    removal = remove_reloaded(slim.filter("value > 10"), slim.filter("value <= 10"), ledger, names)
    part = [removal.fact.select("event_id", "FileKey", F.lit("fact").alias("part")),
            removal.rejects.select("event_id", "FileKey", F.lit("reject").alias("part")),
            removal.keys.select(F.lit(None).cast("bigint").alias("event_id"), "FileKey", F.lit("key").alias("part"))]
    return part[0].unionByName(part[1]).unionByName(part[2]).withColumnRenamed("FileKey", "file_key")


# A file per month; odd orders are reported half a month late, so files overlap with their neighbours.
_MONTHS = """
with f as (select o_orderkey, cast(strftime(o_orderdate, '%Y%m%d') as integer) as date_key,
  cast(strftime(o_orderdate + (o_orderkey % 2) * interval 15 days, '%Y%m') as integer) as file_key from orders),
led as (select distinct file_key, 'SALES' as cat, 'Daily' as sub, cast(1 as smallint) as status from f),
older as (select distinct file_key from f where file_key <> 199807 and date_key in (select date_key from f where file_key = 199807))
"""


def _months(spark, sf):
    orders = tables(spark, sf, "orders")
    reported = F.date_add("o_orderdate", (F.col("o_orderkey") % 2 * 15).cast("int"))
    fact = orders.select("o_orderkey", day("o_orderdate").alias("DateKey"), F.date_format(reported, "yyyyMM").cast("int").alias("FileKey"))
    ledger = fact.select("FileKey").distinct().select(
        "FileKey", F.lit("SALES").alias("CategoryName"), F.lit("Daily").alias("SubCategoryName"), F.lit(1).cast("smallint").alias("LoadStatus"))
    return ledger, fact


@case(_MONTHS + "select o_orderkey, file_key from f where file_key not in (select file_key from older) ")
def mtd_supersede(spark, sf):
    ledger, fact = _months(spark, sf)
    _, kept, _ = supersede_month_to_date(fact, fact.filter("false"), ledger, 199807, "SALES", "Daily")
    return kept.select("o_orderkey", F.col("FileKey").alias("file_key"))


@case(_MONTHS + """
select file_key, case when file_key in (select file_key from older) then cast(6 as smallint) else status end as status from led""")
def mtd_ledger(spark, sf):
    ledger, fact = _months(spark, sf)
    marked, _, _ = supersede_month_to_date(fact, fact, ledger, 199807, "SALES", "Daily")
    return marked.select(F.col("FileKey").alias("file_key"), F.col("LoadStatus").alias("status"))


@case("""
select event_id, user_id from events where event_type = 'error' and event_id not in
  (select event_id from events where value > 20)""")
def quarantine_purge(spark, sf):
    events = tables(spark, sf, "events")
    rejects = events.filter("event_type = 'error'").select("event_id", "user_id")
    return purge_loaded(rejects, events.filter("value > 20").select(F.col("event_id").alias("fact_id")), "event_id", "fact_id")


@case("""
select event_id, case when cast(strftime(ts, '%Y%m%d') as integer) >= 20240120 then 'today' else 'before' end as part from events""")
def hot_cold(spark, sf):
    events = tables(spark, sf, "events").select("event_id", day("ts").alias("d"))
    hot, cold = split_hot_cold(events, "d", "2024-01-19 20:00:00", 7)
    return hot.select("event_id", F.lit("today").alias("part")).unionByName(cold.select("event_id", F.lit("before").alias("part")))

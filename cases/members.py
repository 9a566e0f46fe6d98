"""Attributes filled once, resolved per member and propagated; first event after another."""

from pyspark.sql import functions as F

from cases.base import case, tables
from millrace.operators.enrich import backfill, fill_once, first_after, first_per_key, propagate_flag, resolve_attribute
from millrace.operators.merge import s


@case("""
with begin as (select user_id, min(ts) as began from events where event_type = 'signup' group by user_id)
select user_id, event_id from (
  select e.user_id, e.event_id, row_number() over (partition by e.user_id order by e.ts, e.event_id) as r
  from events e join begin b on e.user_id = b.user_id and e.ts > b.began where e.event_type = 'purchase') where r = 1""")
def first_event_after(spark, sf):
    events = tables(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    begin = first_per_key(events.filter("event_type = 'signup'"), ["user_id"], ["ts", "event_id"], ["ts"])
    return first_after(begin, events.filter("event_type = 'purchase'"), "user_id", "ts", "ts", ["ts", "event_id"], ["event_id"])


@case("""
select user_id, event_id, value from (select *, row_number() over (partition by user_id order by ts, event_id) as r from events) where r = 1""")
def first_event_per_user(spark, sf):
    events = tables(spark, sf, "events")
    return first_per_key(events, ["user_id"], ["ts", "event_id"], ["event_id", "value"])


@case("""
with first as (select o_custkey, o_orderkey, o_orderpriority from
  (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as r from orders where o_orderstatus = 'O') where r = 1),
t as (select c_custkey, case when c_custkey % 2 = 0 then 'known' end as priority, cast(null as bigint) as first_order from customer where c_custkey % 3 <> 0)
select t.c_custkey, case when t.priority is null and f.o_custkey is not null then f.o_orderpriority else t.priority end as priority,
  case when t.priority is null and f.o_custkey is not null then f.o_orderkey end as first_order from t left join first f on t.c_custkey = f.o_custkey
union all select o_custkey, o_orderpriority, o_orderkey from first where o_custkey not in (select c_custkey from t)""")
def fill_once_merge(spark, sf):
    customer, orders = tables(spark, sf, "customer", "orders")
    target = customer.filter("c_custkey % 3 <> 0").select(
        "c_custkey", F.when(F.expr("c_custkey % 2 = 0"), "known").alias("priority"), F.lit(None).cast("bigint").alias("first_order"))
    first = first_per_key(orders.filter("o_orderstatus = 'O'"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderpriority"])
    return fill_once(target, first, {"c_custkey": "o_custkey"}, "priority",
                     {"priority": s("o_orderpriority"), "first_order": s("o_orderkey")})


@case("""
with d as (select o_orderkey, ' ' || o_custkey as member, case when o_orderkey % 7 = 0 then o_orderpriority end as attr, o_orderstatus as st from orders),
cand as (select trim(member) as m, st from (select *, row_number() over (partition by member order by o_orderkey) as r from d where st = 'O') where r = 1),
seen as (select trim(member) as m, count(distinct attr) as n, min(attr) as one from d where st <> 'P' group by 1),
v as (select c.m, case when n = 0 then c.st when n = 1 then one else 'ERR' end as val from cand c join seen s on c.m = s.m)
select o_orderkey, case when v.m is not null then v.val else attr end as attr from d left join v on trim(member) = v.m""")
def resolve_member_attribute(spark, sf):
    orders = tables(spark, sf, "orders")
    rows = orders.select("o_orderkey", F.concat(F.lit(" "), "o_custkey").alias("member"), "o_orderstatus",
                         F.when(F.expr("o_orderkey % 7 = 0"), F.col("o_orderpriority")).alias("attr"))
    candidates = rows.filter("o_orderstatus = 'O'").select("member", "o_orderkey", F.col("o_orderstatus").alias("attr"))
    return resolve_attribute(rows, candidates, "member", "attr", ["o_orderkey"], F.col("o_orderstatus") != "P").select("o_orderkey", "attr")


@case("""
select c_custkey, case when exists (select 1 from orders join lineitem on o_orderkey = l_orderkey
  where o_custkey = c_custkey and l_quantity >= 49 and l_returnflag = 'R') then 'Y' end as flag from customer""")
def flag_propagation(spark, sf):
    customer, orders, line = tables(spark, sf, "customer", "orders", "lineitem")
    big = line.filter("l_quantity >= 49 and l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    members = orders.join(big, "o_orderkey", "left_semi").select(F.col("o_custkey").cast("string").alias("c_custkey"))
    flagged = propagate_flag(customer.select(F.col("c_custkey").cast("string").alias("c_custkey")), members, "c_custkey", "flag")
    return flagged.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@case("""
select d.doc_id, case when d.doc_id % 2 = 0 and d.doc_id % 5 = 0 then coalesce(l.quality, null)
  when d.doc_id % 2 = 0 then cast(d.doc_id % 4 as integer) end as quality from (select doc_id from documents) d left join labels l on d.doc_id = l.doc_id""")
def backfill_missing(spark, sf):
    docs, labels = tables(spark, sf, "documents", "labels")
    rows = docs.select("doc_id", F.when(F.expr("doc_id % 2 = 0 and doc_id % 5 <> 0"), F.expr("cast(doc_id % 4 as int)")).alias("quality"))
    return backfill(rows, labels, {"doc_id": "doc_id"}, "quality", "quality", F.col("quality").isNull() & F.expr("doc_id % 2 = 0"))

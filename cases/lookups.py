"""Single, cascading and chained lookups with explained rejects."""

from pyspark.sql import functions as F

from cases.base import case, number, tables
from millrace.functions.conform import distinct_keys, union_onto
from millrace.operators.lookup import Lookup, enrich, flag_present, lookup, lookup_any, mapping_table
from millrace.operators.totals import net_refunds

PARTS = "p_size <= 25"
NO_PART = "Mismatch ProductKey"
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def _parts(spark, sf):
    line, part = tables(spark, sf, "lineitem", "part")
    known = mapping_table(part, F.expr(PARTS), ["p_partkey", "p_brand"])
    return line, lookup(line.select(*LINE), known, {"l_partkey": "p_partkey"}, ["p_brand"], NO_PART)


@case(f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, p_brand
from lineitem join part on l_partkey = p_partkey where {PARTS}""")
def lookup_match(spark, sf):
    return _parts(spark, sf)[1].matched


@case(f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, '{NO_PART}' as error
from lineitem where not exists (select 1 from part where l_partkey = p_partkey and {PARTS})""")
def lookup_reject(spark, sf):
    return _parts(spark, sf)[1].rejected.select(*LINE, F.col("Error").alias("error"))


@case(f"""
select count(*) as input, count(p_partkey) as matched, count(*) - count(p_partkey) as rejected, true as complete
from lineitem left join part on l_partkey = p_partkey and {PARTS}""")
def lookup_counts(spark, sf):
    line, split = _parts(spark, sf)
    return split.counts(line)


@case(f"""
with by_part as (select p_partkey, p_brand from part where p_size <= 15),
by_both as (select distinct l_partkey as k1, l_suppkey as k2, 'S' || cast(l_suppkey as varchar) as mapped
            from lineitem where l_suppkey % 2 = 0 and l_returnflag = 'R')
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, coalesce(p_brand, mapped) as mapped,
       case when p_partkey is null and k1 is null then '{NO_PART}' end as error
from lineitem left join by_part on l_partkey = p_partkey
left join by_both on l_partkey = k1 and l_suppkey = k2 and p_partkey is null""")
def lookup_cascade(spark, sf):
    return cascade(spark, sf).frame.withColumnRenamed("Error", "error")


def cascade(spark, sf):
    line, part = tables(spark, sf, "lineitem", "part")
    by_part = mapping_table(part, F.col("p_size") <= 15, ["p_partkey", "p_brand"]).withColumnRenamed("p_brand", "mapped")
    by_both = line.filter("l_suppkey % 2 = 0 and l_returnflag = 'R'").select(
        F.col("l_partkey").alias("k1"), F.col("l_suppkey").alias("k2"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("mapped")).distinct()
    return lookup_any(line.select(*LINE), [
        Lookup(by_part, {"l_partkey": "p_partkey"}, ["mapped"]),
        Lookup(by_both, {"l_partkey": "k1", "l_suppkey": "k2"}, ["mapped"]),
    ], NO_PART)


_CHAIN = """
with steps as (
  select o_orderkey, o_custkey, c.c_custkey as hit1, n.n_nationkey as hit2, r.r_regionkey as hit3, r.r_name
  from orders
  left join (select * from customer where c_mktsegment <> 'BUILDING') c on o_custkey = c.c_custkey
  left join (select * from nation where n_regionkey <> 3) n on c.c_nationkey = n.n_nationkey
  left join (select * from region where r_regionkey <> 1) r on n.n_regionkey = r.r_regionkey)
"""


def _chain(spark, sf):
    orders, customer, nation, region = tables(spark, sf, "orders", "customer", "nation", "region")
    split = lookup(orders.select("o_orderkey", "o_custkey"), customer.filter("c_mktsegment <> 'BUILDING'"),
                   {"o_custkey": "c_custkey"}, ["c_nationkey"], "Mismatch CustomerKey")
    split = lookup(split.frame, nation.filter("n_regionkey <> 3"), {"c_nationkey": "n_nationkey"}, ["n_regionkey"],
                   "Mismatch NationKey")
    return lookup(split.frame, region.filter("r_regionkey <> 1"), {"n_regionkey": "r_regionkey"}, ["r_name"],
                  "Mismatch RegionKey")


@case(_CHAIN + """
select o_orderkey, o_custkey, 'Mismatch CustomerKey' as error from steps where hit1 is null
union all select o_orderkey, o_custkey, 'Mismatch NationKey' from steps where hit1 is not null and hit2 is null
union all select o_orderkey, o_custkey, 'Mismatch RegionKey' from steps where hit2 is not null and hit3 is null""")
def lookup_chain_rejects(spark, sf):
    return _chain(spark, sf).rejected.select("o_orderkey", "o_custkey", F.col("Error").alias("error"))


@case(_CHAIN + "select o_orderkey, o_custkey, r_name from steps where hit3 is not null")
def lookup_chain_match(spark, sf):
    return _chain(spark, sf).matched.select("o_orderkey", "o_custkey", "r_name")


@case("""
with signed as (
  select l_orderkey, l_linenumber, l_partkey,
         cast(case when l_returnflag = 'R' then -l_quantity else l_quantity end as decimal(15,3)) as quantity,
         cast(case when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as decimal(18,2)) as amount
  from lineitem),
netted as (select *, sum(quantity) over (partition by l_orderkey) as q, sum(amount) over (partition by l_orderkey) as a
           from signed)
select l_orderkey, l_linenumber, l_partkey, cast(q as double) as quantity, cast(a as double) as amount
from netted where quantity >= 0""")
def refund_netting(spark, sf):
    line = tables(spark, sf, "lineitem")
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    signed = line.select("l_orderkey", "l_linenumber", "l_partkey",
                         (F.col("l_quantity") * sign).cast("decimal(15,3)").alias("quantity"),
                         (F.col("l_extendedprice") * sign).cast("decimal(18,2)").alias("amount"))
    net = net_refunds(signed, ["l_orderkey"], "quantity", "amount")
    return net.withColumns({"quantity": number("quantity"), "amount": number("amount")})


@case("""
select o_orderkey, c_name, case when r.c_custkey is not null then 1 else 0 end as is_flagged,
       cast(strftime(o_orderdate + interval 7 hours, '%Y%m%d') as integer) as date_key,
       cast(strftime(o_orderdate + interval 7 hours, '%H%M%S') as integer) as time_key
from orders left join customer c on o_custkey = c.c_custkey
left join (select c_custkey from customer where c_acctbal < 0) r on o_custkey = r.c_custkey""")
def enrich_left(spark, sf):
    from millrace.functions.columns import date_key, shift, time_key

    orders, customer = tables(spark, sf, "orders", "customer")
    named = enrich(orders, customer, {"o_custkey": "c_custkey"}, {"c_name": "c_name"})
    flagged = flag_present(named, customer.filter("c_acctbal < 0"), {"o_custkey": "c_custkey"}, "is_flagged")
    local = shift("o_orderdate", 7)
    return flagged.select("o_orderkey", "c_name", "is_flagged", date_key(local).alias("date_key"),
                          time_key(local).alias("time_key"))


@case("""
select 'c' || c_custkey as party, c_nationkey as nation, c_acctbal as balance, c_mktsegment as segment from customer
union all select 's' || s_suppkey, s_nationkey, s_acctbal, null from supplier""")
def union_missing(spark, sf):
    from pyspark.sql import types as T

    customer, supplier = tables(spark, sf, "customer", "supplier")
    schema = T.StructType([T.StructField("party", T.StringType()), T.StructField("nation", T.IntegerType()),
                           T.StructField("balance", T.DoubleType()), T.StructField("segment", T.StringType())])
    buyers = customer.select(F.concat(F.lit("c"), F.col("c_custkey")).alias("party"), F.col("c_nationkey").alias("nation"),
                             F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    sellers = supplier.select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("party"), F.col("s_acctbal").alias("balance"),
                              F.col("s_nationkey").alias("nation"))
    return union_onto(schema, [buyers, sellers])


@case("""
select c_nationkey as nation from customer union select s_nationkey from supplier union select n_nationkey from nation""")
def distinct_union_keys(spark, sf):
    customer, supplier, nation = tables(spark, sf, "customer", "supplier", "nation")
    return distinct_keys([customer.withColumnRenamed("c_nationkey", "nation"), supplier.withColumnRenamed("s_nationkey", "nation"),
                          nation.withColumnRenamed("n_nationkey", "nation")], ["nation"])


@case("""

select l_orderkey, l_linenumber, l_partkey, p.p_size as product, cast(null as varchar) as error
from lineitem join (select * from part where p_size <= 40) p on l_partkey = p_partkey where l_returnflag = 'R'
union all
select l_orderkey, l_linenumber, l_partkey, 0, null from lineitem where l_returnflag <> 'R'
union all
select l_orderkey, l_linenumber, l_partkey, null, 'Mismatch ProductKey' from lineitem
where l_returnflag = 'R' and l_partkey not in (select p_partkey from part where p_size <= 40)""")
def split_lookup_fact(spark, sf):
    line, part = tables(spark, sf, "lineitem", "part")
    returned = F.col("l_returnflag").isin("R")
    known = part.filter("p_size <= 40").select("p_partkey", F.col("p_size").alias("product"))
    split = lookup_any(line.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"),
                       [Lookup(known, {"l_partkey": "p_partkey"}, ["product"], when=returned)], NO_PART)
    return split.frame.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(~returned, 0).otherwise(F.col("product")).alias("product"),
        F.when(returned, F.col("Error")).alias("error"))


@case(f"""
with wider as (select p_partkey, p_brand from part where p_size <= 40),
old as (select l_orderkey, l_linenumber, l_partkey from lineitem
        where not exists (select 1 from part where l_partkey = p_partkey and {PARTS}))
select l_orderkey, l_linenumber, l_partkey, p_brand, case when p_partkey is null then '{NO_PART}' end as error
from old left join wider on l_partkey = p_partkey""")
def quarantine_replay(spark, sf):
    part = tables(spark, sf, "part")
    old = _parts(spark, sf)[1].rejected.select("l_orderkey", "l_linenumber", "l_partkey")
    wider = mapping_table(part, F.col("p_size") <= 40, ["p_partkey", "p_brand"])
    return lookup(old, wider, {"l_partkey": "p_partkey"}, ["p_brand"], NO_PART).frame.withColumnRenamed("Error", "error")


@case(f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, p_brand, case when p_partkey is null then '{NO_PART}' end as error
from lineitem left join (select * from part where {PARTS}) on l_partkey = p_partkey""")
def lookup_split(spark, sf):
    return _parts(spark, sf)[1].frame.withColumnRenamed("Error", "error")

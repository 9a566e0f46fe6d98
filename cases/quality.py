"""Declared metrics, reconciliation, audit rows and table sizes."""

from pyspark.sql import functions as F

from cases.base import AS_OF, case, tables
from cases.merges import _ORDERS, merged_orders
from millrace.operators import audit
from millrace.operators.metrics import Check, checklist, reconcile, run_checklist, table_metrics

LINE_CHECKS = [
    Check(1, "lineitem", "", "countrow"), Check(2, "lineitem", "l_quantity", "sum"), Check(3, "lineitem", "l_extendedprice", "max"),
    Check(4, "lineitem", "l_extendedprice", "min"), Check(5, "lineitem", "l_shipdate", "firstdate"), Check(6, "lineitem", "l_shipdate", "lastdate"),
    Check(7, "lineitem", "l_partkey", "distinct"), Check(8, "lineitem", "l_discount", "countnonnull", "", "l_discount > 0.05"),
    Check(9, "lineitem", "", "countrow", "", "l_returnflag = 'R'"), Check(10, "lineitem", "l_tax", "sum", "", "l_quantity > 1000"),
]


def _value(sql):
    return f"cast(cast({sql} as decimal(36,5)) as double)"


def _line(index, column, kind, value, group="''", group_value="''"):
    return f"""select {index} as "index", 'lineitem' as "Table", '{column}' as "Column", '{kind}' as "KeyCheck", {group} as "KeyGroupby",
      {group_value} as "groupbyValue", {_value(value)} as value from lineitem"""


def _double(df):
    return df.drop("checked_at").withColumn("value", F.col("value").cast("double"))


@case(" union all ".join([
    _line(1, "", "countrow", "count(*)"), _line(2, "l_quantity", "sum", "sum(cast(l_quantity as decimal(28,10)))"),
    _line(3, "l_extendedprice", "max", "max(l_extendedprice)"), _line(4, "l_extendedprice", "min", "min(l_extendedprice)"),
    _line(5, "l_shipdate", "firstdate", "min(strftime(l_shipdate, '%Y%m%d'))"), _line(6, "l_shipdate", "lastdate", "max(strftime(l_shipdate, '%Y%m%d'))"),
    _line(7, "l_partkey", "distinct", "count(distinct l_partkey)"), _line(8, "l_discount", "countnonnull", "count(*)") + " where l_discount > 0.05",
    _line(9, "", "countrow", "count(*)") + " where l_returnflag = 'R'",
    _line(10, "l_tax", "sum", "sum(cast(l_tax as decimal(28,10)))") + " where l_quantity > 1000"]))
def metrics_scalar(spark, sf):
    return _double(table_metrics(tables(spark, sf, "lineitem"), LINE_CHECKS, AS_OF))


@case(" union all ".join([
    _line(1, "", "countby", "count(*)", "'l_returnflag'", "l_returnflag") + " group by l_returnflag",
    _line(2, "l_quantity", "sumby", "sum(cast(l_quantity as decimal(28,10)))", "'l_returnflag'", "l_returnflag") + " group by l_returnflag",
    _line(3, "l_suppkey", "countdistinctby", "count(distinct l_suppkey)", "'l_linenumber'", "cast(l_linenumber as varchar)") + " group by l_linenumber",
    _line(4, "l_tax", "sumby", "sum(cast(l_tax as decimal(28,10)))", "'l_returnflag'", "l_returnflag") + " where l_returnflag <> 'A' group by l_returnflag",
    _line(5, "", "countby", "count(*)", "'saledate'", "strftime(l_shipdate, '%Y%m%d')") + " group by l_shipdate"]))
def metrics_grouped(spark, sf):
    line = tables(spark, sf, "lineitem").withColumn("saledate", F.col("l_shipdate"))
    return _double(table_metrics(line, [
        Check(1, "lineitem", "", "countby", "l_returnflag"), Check(2, "lineitem", "l_quantity", "sumby", "l_returnflag"),
        Check(3, "lineitem", "l_suppkey", "countdistinctby", "l_linenumber"), Check(4, "lineitem", "l_tax", "sumby", "l_returnflag", "l_returnflag <> 'A'"),
        Check(5, "lineitem", "", "countby", "saledate")], AS_OF))


@case(" union all ".join([
    _line(1, "l_partkey", "distinct", "count(distinct l_partkey)"), _line(2, "l_suppkey", "distinct", "count(distinct l_suppkey)") + " where l_returnflag = 'R'",
    _line(3, "l_shipdate", "distinct", "count(distinct l_shipdate)"), _line(4, "l_discount", "distinct", "count(distinct l_discount)"),
    _line(5, "l_tax", "distinct", "count(distinct l_tax)") + " where l_quantity > 1000",
    _line(6, "l_suppkey", "countdistinctby", "count(distinct l_suppkey)", "'l_linenumber'", "cast(l_linenumber as varchar)") + " group by l_linenumber",
    _line(7, "l_partkey", "countdistinctby", "count(distinct l_partkey)", "'l_linenumber'", "cast(l_linenumber as varchar)") + " where l_linestatus = 'F' and l_linenumber < 5 group by l_linenumber"]))
def metrics_distinct(spark, sf):
    """Five distinct counts in one scan, two by a group in another."""
    kinds = [("l_partkey", ""), ("l_suppkey", "l_returnflag = 'R'"), ("l_shipdate", ""), ("l_discount", ""), ("l_tax", "l_quantity > 1000")]
    checks = [Check(i + 1, "lineitem", name, "distinct", "", where) for i, (name, where) in enumerate(kinds)]
    checks += [Check(6, "lineitem", "l_suppkey", "countdistinctby", "l_linenumber"), Check(7, "lineitem", "l_partkey", "countdistinctby", "l_linenumber", "l_linestatus = 'F' and l_linenumber < 5")]
    return _double(table_metrics(tables(spark, sf, "lineitem"), checks, AS_OF))


_LIST = [(3, "orders", "o_totalprice", "sum", None, "o_orderstatus = 'O'", 1), (1, "Customer", None, "countrow", None, None, 1),
         (2, "customer", "c_nationkey", "distinct", None, None, 1), (4, "events", None, "countby", "event_type", "value > 10", 1),
         (5, "events", "value", "sum", None, None, 0)]


@case(f"""
select 1 as "index", 'Customer' as "Table", '' as "Column", 'countrow' as "KeyCheck", '' as "KeyGroupby", '' as "groupbyValue", {_value("count(*)")} as value from customer
union all select 2, 'customer', 'c_nationkey', 'distinct', '', '', {_value("count(distinct c_nationkey)")} from customer
union all select 3, 'orders', 'o_totalprice', 'sum', '', '', {_value("sum(cast(o_totalprice as decimal(28,10)))")} from orders where o_orderstatus = 'O'
union all select 4, 'events', '', 'countby', 'event_type', event_type, {_value("count(*)")} from events where value > 10 group by event_type""")
def metric_checklist(spark, sf):
    rows = spark.createDataFrame(_LIST, "idx int, Table string, Column string, KeyCheck string, groupbyKey string, additionalSQLFilter string, check int")
    names = ("customer", "orders", "events")
    return _double(run_checklist(dict(zip(names, tables(spark, sf, *names))), checklist(rows), AS_OF))


_STATUS = """select o_orderstatus as "groupbyValue", count(*) as n, sum(cast(o_totalprice as decimal(28,10))) as s from {} group by 1"""


@case(f"""
with a as ({_STATUS.format("orders")}), b as ({_STATUS.format("(select * from orders where o_orderstatus <> 'P' and o_orderkey % 50 <> 0)")}),
m as (select 1 as "index", "groupbyValue", cast(a.n as decimal(36,5)) as l, cast(b.n as decimal(36,5)) as r, b.n is not null as paired from a left join b using ("groupbyValue")
  union all select 2, "groupbyValue", cast(a.s as decimal(36,5)), cast(b.s as decimal(36,5)), b.n is not null from a left join b using ("groupbyValue"))
select "index", "groupbyValue", cast(l as double) as left_value, cast(r as double) as right_value, cast(l - r as double) as difference, paired and l = r as agrees from m""")
def metrics_reconcile(spark, sf):
    orders = tables(spark, sf, "orders")
    checks = [Check(1, "orders", "", "countby", "o_orderstatus"), Check(2, "orders", "o_totalprice", "sumby", "o_orderstatus")]
    other = orders.filter("o_orderstatus <> 'P' and o_orderkey % 50 <> 0")
    found = reconcile(table_metrics(orders, checks, AS_OF), table_metrics(other, checks, AS_OF))
    values = [F.col(n).cast("double").alias(n) for n in ("left_value", "right_value", "difference")]
    return found.select("index", "groupbyValue", *values, "agrees")


@case(_ORDERS + """
select 'nightly-orders-2024-06-15_08-30-05' as "AUDITKEY", 'Success' as "STATUS_ACTIVITY", cast((select count(*) from t) as varchar) as "COUNTROWSBEFORE",
  cast((select count(*) from merged) as varchar) as "COUNTROWSAFTER" """.replace("08-30-05", "08_30_05"))
def audit_counts(spark, sf):
    before = tables(spark, sf, "orders").filter("o_orderkey % 2 = 0")
    row = audit.audit_row(spark, {"PIPELINENAME": "nightly", "TABLE_NAME": "orders"}, AS_OF, AS_OF)
    return audit.with_counts(row, before, merged_orders(spark, sf)).select("AUDITKEY", "STATUS_ACTIVITY", "COUNTROWSBEFORE", "COUNTROWSAFTER")


_SIZES = {"region": 2, "nation": 3, "customer": 5, "supplier": 4, "part": 6, "orders": 6, "lineitem": 11, "events": 6, "documents": 5,
          "labels": 3, "conversations": 4, "pages": 3, "benchmark": 2, "embeddings": 3}


@case(" union all ".join(f"select '{name}' as table_name, count(*) as n_rows, {width}::bigint as n_columns from {name}" for name, width in _SIZES.items()))
def table_size(spark, sf):
    return audit.table_sizes(dict(zip(_SIZES, tables(spark, sf, *_SIZES))))

"""Cash pick-up and daily sales, computed by the jobs themselves on rows derived from events and orders."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cases.base import AS_OF, case, number, tables
from millrace.plans import cash, sales
from millrace.scratch import scratch_path
from millrace.sources import reports

# Cash drops: 40 of 50 stations are known; a third of the drops is transferred the day after.
_DROPS = """
raw as (
  select event_id, user_id % 50 as station, strftime(ts, '%Y%m%d %H%M%S') as dropped,
    strftime(ts + (event_id % 3) * interval 12 hours, '%Y%m%d %H%M%S') as moved, cast(value as decimal(10,2)) as amount,
    'f' || cast(user_id % 9 as varchar) as file_name from events where event_id % 11 <> 0),
stations as (select distinct user_id % 50 as pos, cast(user_id % 50 + 700 as integer) as station_key from events where user_id % 50 < 40),
drops as (
  select event_id, station, station_key, cast(substr(dropped, 1, 8) as integer) as drop_date, cast(substr(dropped, 10) as integer) as drop_time,
    replace(dropped, ' ', '') as drop_text, cast(substr(moved, 1, 8) as integer) as move_date, cast(substr(moved, 10) as integer) as move_time,
    amount, file_name from raw left join stations on station = pos)
"""


def _raw_drops(spark, sf):
    events = tables(spark, sf, "events")
    station = (F.col("user_id") % 50).cast("string")
    moved = F.col("ts") + F.make_dt_interval(hours=F.col("event_id") % 3 * 12)
    pattern = "yyyyMMdd HHmmss"
    cells = {
        "_c0": F.col("event_id").cast("string"), "_c1": F.lit("12"),
        "_c2": F.when(F.expr("event_id % 11 <> 0"), station), "_c3": F.lit(""), "_c4": F.lit(""),
        "_c5": F.date_format("ts", pattern), "_c6": F.col("event_id").cast("string"), "_c7": F.lit("x"),
        "_c8": F.col("value").cast("decimal(10,2)").cast("string"), "_c9": F.date_format(moved, pattern),
    }
    raw = events.select(*[value.alias(name) for name, value in cells.items()],
                        F.concat(F.lit("f"), (F.col("user_id") % 9).cast("string")).alias("FileName"))
    stations = events.filter("user_id % 50 < 40").select(
        F.lit("12").alias("CustomerCode"), (F.col("user_id") % 50).cast("string").alias("POSCode"),
        (F.col("user_id") % 50 + 700).cast("int").alias("StationKey"), F.lit("S").alias("SOR")).distinct()
    return raw, stations


_FACT = T.StructType([T.StructField(n, k) for n, k in (
    ("StationKey", T.IntegerType()), ("StationCode", T.IntegerType()), ("TranferDate", T.IntegerType()),
    ("TranferTime", T.IntegerType()), ("DropDate", T.IntegerType()), ("DropTime", T.IntegerType()),
    ("DropDateTime", T.StringType()), ("PacketNumber", T.IntegerType()), ("Amount", T.DecimalType(10, 2)),
    ("RowNumber", T.LongType()), ("FileName", T.StringType()))])


def _cash_fact(spark, sf):
    from millrace.functions.conform import conform_table
    from millrace.operators.lookup import enrich
    raw, stations = _raw_drops(spark, sf)
    drops = enrich(cash.parse_drops(raw), stations.select(F.col("POSCode").cast("int").alias("pos"), "StationKey"),
                   {"StationCode": "pos"}, {"StationKey": "StationKey"})
    return conform_table(drops, _FACT, allow_missing=True)


@case(f"""
with {_DROPS},
old as (select * from drops where event_id % 2 = 0 or file_name >= 'f5'), new as (select * from drops where event_id % 2 = 1 and file_name < 'f5'),
kept as (select * from old where file_name not in (select file_name from new))
select cast(event_id as integer) as packet, station_key, cast(station as integer) as station, drop_date, drop_time, move_date, move_time, cast(amount as double) as amount,
  file_name, event_id as row_number from kept
union all
select cast(event_id as integer), station_key, cast(station as integer), drop_date, drop_time, move_date, move_time, cast(amount as double), file_name,
  (select max(event_id) from kept) + row_number() over (order by file_name, event_id) from new""")
def cash_drops(spark, sf):
    raw, stations = _raw_drops(spark, sf)
    old = _cash_fact(spark, sf).filter("PacketNumber % 2 = 0 or FileName >= 'f5'").withColumn("RowNumber", F.col("PacketNumber").cast("bigint"))
    incoming = raw.filter("cast(_c0 as bigint) % 2 = 1 and FileName < 'f5'")
    loaded = cash.load_drops(incoming, stations, old, ["PacketNumber"])
    return loaded.select(
        F.col("PacketNumber").alias("packet"), F.col("StationKey").alias("station_key"), F.col("StationCode").alias("station"),
        F.col("DropDate").alias("drop_date"), F.col("DropTime").alias("drop_time"), F.col("TranferDate").alias("move_date"),
        F.col("TranferTime").alias("move_time"), number("Amount").alias("amount"), F.col("FileName").alias("file_name"),
        F.col("RowNumber").alias("row_number"))


@case(f"""
with {_DROPS}, fine as (
  select station_key, station, move_date, drop_time, drop_date, sum(amount) as a from drops where move_date = drop_date and drop_time > 10000
  group by all)
select station_key, cast(station as integer) as station, move_date as day, cast(sum(a) as double) as amount, max(drop_time) as latest from fine group by all""")
def transfer_diff(spark, sf):
    found = cash.transfer_difference(_cash_fact(spark, sf))
    return found.select(F.col("StationKey").alias("station_key"), F.col("StationCode").alias("station"), F.col("TranferDate").alias("day"),
                        number("Amount").alias("amount"), F.col("TimeDrop").alias("latest"))


@case(f"""
with {_DROPS}, dated as (
  select *, strptime(cast(drop_date as varchar), '%Y%m%d') - case when substr(drop_text, 9, 4) < '0100' then interval 1 day else interval 0 day end as d from drops)
select station_key, cast(station as integer) as station, cast(d as date) as day, cast(strftime(d, '%Y%m') as integer) as month,
  cast(sum(amount) as double) as amount from dated group by all""")
def business_day(spark, sf):
    found = cash.business_day_totals(_cash_fact(spark, sf))
    return found.select(F.col("StationKey").alias("station_key"), F.col("StationCode").alias("station"), F.col("DropDate").alias("day"),
                        F.col("YearMonth_DropDate").alias("month"), number("Amount").alias("amount"))


# Ledger statements: amounts with thousands separators, some short assignments, some unknown stations.
_STATEMENT = """
lines as (
  select o_orderkey as doc, case when o_orderkey % 4 = 0 then 'CPICK ' || o_orderkey else 'other' end as txt,
    case when o_orderkey % 6 = 0 then '' else '1000' end as account, o_custkey % 100 as site, o_orderkey % 13 = 0 as short,
    o_orderdate as d, o_totalprice as p from orders),
placed as (select * from lines where site < 80),
normal as (
  select cast(doc as varchar) as doc, cast(site as integer) + 10000 as station, cast(site + 500 as integer) as station_key, txt, account,
    case when short then '2' || strftime(d, '%m%d') else strftime(d, '%Y%m%d') end as assigned, short,
    strftime(d, '%Y%m%d') as day, strftime(d, '%Y%m') as month, cast(floor(p) as double) as amount from placed)
"""


def _statement(spark, sf):
    orders = tables(spark, sf, "orders")
    site = F.col("o_custkey") % 100
    assigned = F.concat((site + 10000).cast("string"), F.lit("-"), F.date_format("o_orderdate", "yyyyMMdd"))
    short = F.concat((site + 10000).cast("string"), F.lit("-----"))
    rows = orders.select(
        F.when(F.expr("o_orderkey % 4 = 0"), F.concat(F.lit("CPICK "), "o_orderkey")).otherwise("other").alias("Text"),
        F.when(F.expr("o_orderkey % 6 = 0"), "").otherwise("1000").alias("G_L"),
        assigned.alias("Assignment"), F.date_format("o_orderdate", "dd.MM.yyyy").alias("Doc Date"),
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")).alias("DocumentNo"), F.lit("ZR").alias("Ty"),
        F.concat(F.lit("  "), F.format_number("o_totalprice", 2)).alias("Amount in doc curr"))
    stations = orders.select((site + 10000).cast("string").alias("POSCode"), (site + 500).cast("int").alias("StationKey"),
                             F.lit("12").alias("CustomerCode")).distinct().filter("StationKey < 580")
    return rows, stations


_STATEMENT_COLUMNS = {"StationCode": "station", "StationKey": "station_key", "AssignmentDateKey": "assigned", "DOC_Date": "day",
                      "YYYYMM_DocDate": "month"}


def _statement_out(df, number_name):
    return df.select(F.col(number_name).alias("doc"), *[F.col(a).alias(b) for a, b in _STATEMENT_COLUMNS.items()],
                     number("Amount_DOC_Curr").alias("amount"))


@case(f"""
with {_STATEMENT} select doc, station, station_key, strftime(strptime(day, '%Y%m%d'), '%Y%m%d') as assigned, day, month, amount
from normal where txt like '%CPICK%'""")
def normalise_statement(spark, sf):
    rows, stations = _statement(spark, sf)
    return _statement_out(cash.normalise_statement(rows, cash.pickup_statement(), stations, AS_OF).matched, "DOC_Number")


_CHECKED = f"""
with {_STATEMENT}, checked as (select *, case when cast(doc as bigint) % 13 = 0 then '9' else day end as a from normal where account <> '')
"""


def _checked(spark, sf):
    rows, stations = _statement(spark, sf)
    # The whole assignment is the station and one digit: its last eight characters then reach into the station.
    short = F.concat(F.left("Assignment", F.lit(5)), F.lit("9"))
    rows = rows.withColumn("Assignment", F.when(F.trim("DocumentNo").cast("bigint") % 13 == 0, short).otherwise(F.col("Assignment")))
    return cash.normalise_statement(rows, cash.account_statement(), stations, AS_OF)


@case(_CHECKED + "select doc, station, station_key, a as assigned, day, month, amount from checked where length(a) = 8")
def statement_valid(spark, sf):
    return _statement_out(_checked(spark, sf).matched, "DOC_No")


@case(_CHECKED + """select doc, station, 'MismatchAssignment' as error from checked where length(a) <> 8
union all select cast(doc as varchar), cast(site as integer) + 10000, 'Mismatch StationKey' from lines where site >= 80 and account <> ''""")
def statement_rejects(spark, sf):
    return _checked(spark, sf).rejected.select(F.col("DOC_No").alias("doc"), F.col("StationCode").alias("station"), F.col("Error").alias("error"))


# Daily sales: a line per order line; two divisions need a product.
_SALES = """
staged as (
  select l_orderkey, l_linenumber, l_suppkey, l_shipdate, cast(l_suppkey as integer) as sold_to, case when l_linenumber > 6 then null else '0' || l_linenumber end as division,
    'M' || (l_partkey % 400) as material, l_quantity from lineitem),
sites as (select distinct cast(s_suppkey as varchar) as code, cast(s_suppkey + 10 as integer) as station_key from supplier where s_suppkey % 6 <> 0),
products as (select distinct 'M' || p_partkey as material, cast(p_partkey + 1 as integer) as product from part where p_partkey < 300),
placed as (select *, station_key is not null as ok from staged left join sites on cast(sold_to as varchar) = code)
"""


def _sales_tables(spark, sf):
    line, supplier, part = tables(spark, sf, "lineitem", "supplier", "part")
    staged = line.select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("CalendarDay"), F.col("l_suppkey").cast("int").alias("SoldtoPartyKey"),
        F.when(F.col("l_linenumber") <= 6, F.col("l_linenumber").cast("string")).alias("DivisionKey"),
        F.concat(F.lit("M"), F.expr("l_partkey % 400").cast("string")).alias("MaterialKey"), F.col("l_quantity").alias("Quantity"))
    stations = supplier.select(F.col("s_suppkey").cast("string").alias("CustomerCode"), (F.col("s_suppkey") + 10).cast("int").alias("StationKey"))
    mapping = part.filter("p_partkey < 300").select(
        F.lit("SALES").alias("SourceName"), F.lit("DailySales").alias("SourceFile"),
        F.concat(F.lit("M"), F.col("p_partkey").cast("string")).alias("SourceKey"), (F.col("p_partkey") + 1).cast("int").alias("MappingKey"))
    return staged, stations, stations.filter("cast(CustomerCode as int) % 6 <> 0"), mapping


def _workbook(spark, sf):
    """The same rows as a workbook, the staging schema they are for, stations and mapping."""
    staged, _, stations, mapping = _sales_tables(spark, sf)
    return staged, T.StructType([*staged.schema, T.StructField("FileKey", T.IntegerType())]), stations, mapping


def _sales(spark, sf):
    staged, _, stations, mapping = _sales_tables(spark, sf)
    return sales.load_sales(staged, stations, mapping, "SALES", file_key=77)


@case(f"""
with {_SALES}
select l_orderkey, l_linenumber, station_key, product, cast(strftime(l_shipdate, '%Y%m%d') as integer) as date_key, 77 as file_key, l_quantity as quantity
from placed join products using (material) where ok and division in ('02', '04')
union all
select l_orderkey, l_linenumber, station_key, 0, cast(strftime(l_shipdate, '%Y%m%d') as integer), 77, l_quantity from placed where ok and division not in ('02', '04')""")
def daily_sales_fact(spark, sf):
    from millrace.plans.sales import RENAMES
    return _sales(spark, sf).matched.withColumnsRenamed(RENAMES).select(
        "l_orderkey", "l_linenumber", F.col("StationKey").alias("station_key"), F.col("ProductKey").alias("product"),
        F.col("DateKey").alias("date_key"), F.col("FileKey").alias("file_key"), F.col("Quantity").alias("quantity"))


@case(f"""
with {_SALES}
select l_orderkey, l_linenumber, material, 'Mismatch StationKey' as error from placed where not ok
union all select l_orderkey, l_linenumber, material, 'Mismatch ProductKey' from placed where ok and division in ('02', '04')
  and material not in (select material from products)
union all select l_orderkey, l_linenumber, material, 'Mismatch DivisionKey' from placed where ok and division is null""")
def daily_sales_rejects(spark, sf):
    return _sales(spark, sf).rejected.select("l_orderkey", "l_linenumber", F.col("MaterialKey").alias("material"), F.col("Error").alias("error"))


_SALES_FACT = T.StructType([T.StructField(n, k) for n, k in (
    ("l_orderkey", T.LongType()), ("l_linenumber", T.IntegerType()), ("StationKey", T.IntegerType()), ("ProductKey", T.IntegerType()),
    ("DateKey", T.IntegerType()), ("FileKey", T.IntegerType()))])
_SALES_REJECTS = T.StructType([T.StructField(n, k) for n, k in (
    ("l_orderkey", T.LongType()), ("l_linenumber", T.IntegerType()), ("CalendarDay", T.TimestampNTZType()), ("SoldtoPartyKey", T.IntegerType()),
    ("DivisionKey", T.StringType()), ("MaterialKey", T.StringType()), ("FileKey", T.IntegerType()), ("Error", T.StringType()))])


def _sales_load(spark, sf):
    """A file per year was loaded; the odd orders' lines of 1998 come as a month-to-date file."""
    staged, _, stations, mapping = _sales_tables(spark, sf)
    odd = F.expr("l_orderkey % 2 = 1")
    year = F.year("CalendarDay")
    old = sales.load_sales(staged.filter(~(odd & (year == 1998))).withColumn("FileKey", year), stations, mapping, "SALES")
    fact, rejects = sales.to_tables(old, _SALES_FACT, _SALES_REJECTS)
    from millrace.operators import ledger as ledgers
    keys = staged.select(year.alias("FileKey")).distinct().select("FileKey", F.concat(F.lit("MTD"), "FileKey").alias("FileName"))
    ledger = ledgers.new_rows(keys, "SALES", "DailySales", ledgers.LOADED, AS_OF)
    return sales.load_file(staged.filter(odd & (year == 1998)), stations, mapping, "SALES", fact, rejects, ledger, 9000, "MTD", AS_OF, month_to_date=True)


_OLD_AND_NEW = f"""
with {_SALES},
dated as (select *, cast(strftime(l_shipdate, '%Y') as integer) as y, cast(strftime(l_shipdate, '%Y%m%d') as integer) as d,
  case when not ok then 'Mismatch StationKey' when division in ('02', '04') and material not in (select material from products) then 'Mismatch ProductKey'
    when division is null then 'Mismatch DivisionKey' end as error from placed),
now_ as (select *, case when l_orderkey % 2 = 1 and y = 1998 then 9000 else y end as file_key from dated),
older as (select distinct file_key from now_ where error is null and file_key <> 9000 and d in (select d from now_ where file_key = 9000 and error is null))
"""


@case(_OLD_AND_NEW + """
select l_orderkey, l_linenumber, file_key, d as date_key, cast(null as varchar) as error from now_ where error is null and file_key not in (select file_key from older)
union all select l_orderkey, l_linenumber, file_key, null, error from now_ where error is not null and file_key not in (select file_key from older)""")
def daily_sales_month(spark, sf):
    done = _sales_load(spark, sf)
    loaded = done.fact.select("l_orderkey", "l_linenumber", "FileKey", "DateKey", F.lit(None).cast("string").alias("error"))
    waiting = done.rejects.select("l_orderkey", "l_linenumber", "FileKey", F.lit(None).cast("int").alias("DateKey"), F.col("Error").alias("error"))
    return loaded.unionByName(waiting).toDF("l_orderkey", "l_linenumber", "file_key", "date_key", "error")


@case(_OLD_AND_NEW + """
select file_key, cast(case when file_key in (select file_key from older) then 6 else 1 end as smallint) as status from (select distinct y as file_key from (select cast(strftime(l_shipdate, '%Y') as integer) as y from lineitem))
union all select 9000, cast(1 as smallint)""")
def daily_sales_ledger(spark, sf):
    return _sales_load(spark, sf).ledger.select(F.col("FileKey").alias("file_key"), F.col("LoadStatus").alias("status"))


@case(f"""
with {_SALES},
waiting as (select * from placed where not ok or division is null or (division in ('02', '04') and material not in (select material from products)))
select l_orderkey, l_linenumber, case when division in ('02', '04') and material not in (select material from products) then 'Mismatch ProductKey'
  when division is null then 'Mismatch DivisionKey' end as error from waiting""")
def daily_sales_replay(spark, sf):
    """All stations are known by now, so only products are still missing."""
    staged, every, known, mapping = _sales_tables(spark, sf)
    rejects = sales.to_tables(sales.load_sales(staged, known, mapping, "SALES", file_key=77), _SALES_FACT, _SALES_REJECTS)[1]
    from millrace.operators.ledger import LEDGER
    empty = spark.createDataFrame([], LEDGER)
    done = sales.replay_rejects(every, mapping, "SALES", spark.createDataFrame([], _SALES_FACT), rejects, empty)
    loaded = done.fact.select("l_orderkey", "l_linenumber", F.lit(None).cast("string").alias("error"))
    return loaded.unionByName(done.rejects.select("l_orderkey", "l_linenumber", F.col("Error").alias("error")))


@case("""
with t as (select distinct lpad(p_size, 2, '0') as k, p_brand as b from part where p_size < 20),
src as (select distinct lpad(cast(p_size as varchar), 2, '0') as k, p_brand as b from part)
select k as "divisionKey", b as division from t union all select k, b from src where not exists (select 1 from t where t.k = src.k and t.b = src.b)""".replace("lpad(p_size,", "lpad(cast(p_size as varchar),"))
def small_dimension(spark, sf):
    part = tables(spark, sf, "part")
    pairs = part.select(F.col("p_size").cast("string").alias("divisionKey"), F.col("p_brand").alias("division"))
    target = pairs.filter("cast(divisionKey as int) < 20").withColumn("divisionKey", F.lpad("divisionKey", 2, "0"))
    return sales.update_small_dimension(target, pairs, "division")


@case("""
with d as (select s_suppkey as k, s_name as name from supplier where s_suppkey % 2 = 0),
src as (select k, party, grp from (select l_suppkey as k, 'P' || l_partkey as party, l_returnflag as grp,
   row_number() over (partition by l_suppkey order by l_shipdate desc, l_orderkey desc, l_linenumber desc, l_partkey desc, l_returnflag desc) as r from lineitem) where r = 1)
select cast(d.k as varchar) as customer_code, d.name as station_name, src.party as party, src.grp as grp,
  case when src.k is null then 'SAME' else 'UPDATE' end as status, 1 as height from d left join src on d.k = src.k
union all select cast(src.k as varchar), 'NA', party, grp, 'INSERT', 99 from src where k not in (select k from d)""")
def station_dimension(spark, sf):
    supplier, line = tables(spark, sf, "supplier", "lineitem")
    dimension = supplier.filter("s_suppkey % 2 = 0").select(
        F.col("s_suppkey").cast("string").alias("CustomerCode"), F.col("s_name").alias("StationName"),
        F.lit(None).cast("string").alias("XSoldtoName"), F.lit(None).cast("string").alias("XSalesGroupSoldTo"),
        F.lit(1).alias("HighwaySignHeight"))
    staged = line.select(F.col("l_suppkey").cast("int").alias("SoldtoPartyKey"), "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey",
                         F.concat(F.lit("P"), "l_partkey").alias("SoldtoParty"), F.col("l_returnflag").alias("SalesGroupSoldTo"))
    names = {k: v for k, v in sales.station_columns("X").items() if k in dimension.columns}
    merged = sales.merge_members(dimension, staged, "CustomerCode", "SoldtoPartyKey",
                                 ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "SalesGroupSoldTo"], names,
                                 sales.station_defaults(dimension.schema))
    return merged.toDF("customer_code", "station_name", "party", "grp", "height", "status")


@case("""
with l as (select doc_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) as x from documents),
b as (select doc_id, unnest(x) as line, generate_subscripts(x, 1) - 1 as n, len(x) as total from l)
select doc_id, cast(n as integer) as line_no, line as first_cell from b where n > 2 and n < total - 1""")
def text_report_lines(spark, sf):
    docs = tables(spark, sf, "documents").select("doc_id", "text")
    lines = reports.report_lines(docs, skip=1, after_header=1, trailer=1)
    return lines.select("doc_id", "line_no", F.array_join("cells", "\t").alias("first_cell"))


@case("""
select o_orderkey as report, 3 as line_no, cast(o_custkey as varchar) as "DocumentNo", o_orderstatus as "G_L" from orders
union all select o_orderkey, 5, cast(o_orderkey as varchar), o_orderpriority from orders""")
def text_report_rows(spark, sf):
    orders = tables(spark, sf, "orders")
    # A short report per order: a title, a blank line, a header whose names need cleaning, two rows, and two lines without an account.
    text = F.concat(F.lit("Statement\n\n G/L \t\tDocument.No.\n"), "o_orderstatus", F.lit("\tx\t"), "o_custkey", F.lit("\n\t\ttotal\n"),
                    "o_orderpriority", F.lit("\ty\t"), "o_orderkey", F.lit("\n\t\tsum\n"))
    lines = reports.report_lines(orders.select(F.col("o_orderkey").alias("report"), text.alias("text")), skip=2)
    return reports.report_rows(lines, ["G_L", "DocumentNo"], required="G_L")


@case("""select cast(o_orderkey as varchar) as document, o_orderstatus as account, cast(5 + row_number() over (partition by o_orderkey % 16 order by o_orderkey) as integer) as line_no from orders""")
def split_report_rows(spark, sf):
    """Sixteen reports of many lines, each read in many splits: preamble, header, lines in key order, two closing lines."""
    orders, folder = tables(spark, sf, "orders"), scratch_path(spark, "reports")
    body = orders.select((F.col("o_orderkey") % 16).alias("report"), F.col("o_orderkey").alias("n"), F.concat("o_orderstatus", F.lit("\t"), "o_orderkey").alias("value"))
    around = F.array(*[F.struct(F.lit(n).cast("bigint").alias("n"), F.lit(v).alias("value")) for n, v in
                       [(-9, "Statement"), (-8, ""), (-7, "of accounts"), (-6, ""), (-5, "-"), (-4, " G/L \tDocument.No."), (1 << 60, "total\t"), ((1 << 60) + 1, "end")]])
    whole = body.unionByName(body.select("report").distinct().select("report", F.explode(around).alias("x")).select("report", "x.n", "x.value"))
    whole.repartition("report").sortWithinPartitions("report", "n").select("report", "value").write.partitionBy("report").text(folder)
    setting = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(setting)
    spark.conf.set(setting, "16384")
    try:
        lines = reports.read_lines(spark, f"{folder}/*/part-*")
    finally:
        spark.conf.set(setting, old)
    rows = reports.report_rows(reports.body_lines(lines, skip=5, trailer=2), ["G_L", "DocumentNo"], required="DocumentNo")
    return rows.select(F.col("DocumentNo").alias("document"), F.col("G_L").alias("account"), "line_no")


@case("""
with years as (select distinct cast(year(l_shipdate) as integer) as y from lineitem)
select y as file_key, 'sales ' || y as file_name, cast(case y % 3 when 0 then 2 when 1 then 4 else 1 end as smallint) as status from years""")
def daily_sales_states(spark, sf):
    """A workbook for each year: some have a column nobody knows, for some the stations lack a column, the others are loaded."""
    raw, schema, stations, mapping = _workbook(spark, sf)
    kept = sales.SalesTables(scratch_path(spark, "sales"), schema, _SALES_FACT, _SALES_REJECTS)
    years = sorted(r[0] for r in raw.select(F.year("CalendarDay")).distinct().collect())
    for year in years:
        rows = raw.filter(F.year("CalendarDay") == year)
        given = rows.withColumn("Nobody", F.lit(1)) if year % 3 == 0 else rows
        try:
            sales.load_workbook(spark, kept, given, stations.drop("StationKey") if year % 3 == 1 else stations, mapping, "SALES", year, f"sales {year}", AS_OF)
        except (ValueError, AnalysisException):
            pass
    return sales.stored(spark, kept).ledger.select(F.col("FileKey").alias("file_key"), F.col("FileName").alias("file_name"), F.col("LoadStatus").alias("status"))

"""Whole jobs: raw files to fact, quarantine and ledger; audited loads; tables and files around them."""

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cases.base import AS_OF, case, number, tables
from cases.cash_sales import _STATEMENT, _statement
from cases.feeds import _FUEL, _mapping, _rows, _stations
from cases.files import _LEDGER, old_ledger, out
from millrace.functions.conform import conform_table
from millrace.operators import audit
from millrace.operators import ledger as ledgers
from millrace.operators.lookup import lookup
from millrace.plans import cash, pos, pos_files, sales
from millrace.scratch import scratch_path
from millrace.sources import feeds
from millrace.sources import tables as store
from millrace.streaming import ingest

# ---- raw fuel files: loaded once with part of the stations known, then two of five are sent again -----------------

_TYPES = {"CloseDateKey": T.IntegerType(), "TransNumber": T.LongType(), "TransDateKey": T.IntegerType(), "ReceiptNumber": T.IntegerType(),
          "Amount": T.DecimalType(18, 2), "LoadDateKey": T.IntegerType(), "LoadTimeKey": T.IntegerType()}
STAGING = T.StructType([T.StructField(f.name, _TYPES.get(f.name, T.StringType())) for f in feeds.staging_schema("TRN")]
                       + [T.StructField("FileKey", T.IntegerType())])
FACT = T.StructType([T.StructField(n, k) for n, k in (
    ("TransNumber", T.LongType()), ("ReceiptNumber", T.IntegerType()), ("FileKey", T.IntegerType()), ("StationKey", T.IntegerType()),
    ("ProductKey", T.IntegerType()), ("Volume", T.DecimalType(15, 3)), ("Amount", T.DecimalType(18, 2)), ("AttendeeNumber", T.StringType()),
    ("ChiefNumber", T.StringType()))])
REJECTS = T.StructType([f for f in STAGING if f.name not in ("FileName", "LoadDateKey", "LoadTimeKey")] + [T.StructField("Error", T.StringType())])


def write_files(spark, rows):
    """Rows (value, FileName) as one file for each name, byte for byte."""
    parts, folder = scratch_path(spark, "parts"), scratch_path(spark, "files")
    rows.repartition("FileName").write.partitionBy("FileName").option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 0).csv(parts, sep="\u0001", quote="", escape="")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for status in fs.listStatus(path(parts)):
        name = status.getPath().getName()
        if name.startswith("FileName="):
            own = [p.getPath() for p in fs.listStatus(status.getPath()) if p.getPath().getName().startswith("part-")]
            if len(own) != 1:
                raise ValueError(f"{name} was written in {len(own)} parts")
            fs.rename(own[0], path(folder, name.removeprefix("FileName=").replace("%23", "#")))
    return folder


def write_parts(spark, rows):
    """Rows (value, FileName) byte for byte as files in folders: each task writes a file of every name it has rows of, so no row is moved to another task."""
    parts, folder = scratch_path(spark, "parts"), scratch_path(spark, "files")
    rows.write.partitionBy("FileName").option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 0).csv(parts, sep="\u0001", quote="", escape="")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path(parts)):
        name = status.getPath().getName()
        if name.startswith("FileName="):
            for part in fs.listStatus(status.getPath()):
                if part.getPath().getName().startswith("part-"):
                    own = path(folder, part.getPath().getName().split("-")[1])
                    fs.mkdirs(own)
                    fs.rename(part.getPath(), path(own, name.removeprefix("FileName=").replace("%23", "#")))
    return folder


def _fuel_lines(spark, sf):
    """Order lines as lines of ten files; some volumes are no numbers, names carry blanks, one field is Thai."""
    rows = _rows(spark, sf, "TRN")
    name = F.concat(F.lit("2025010"), (F.col("TransNumber") % 5).cast("string"), F.lit("#1TRN"), F.when(F.col("__b"), "FLOWCO").otherwise(""), F.lit(".CSV"))
    volume = F.when(F.expr("TransNumber % 97 = 0 and ReceiptNumber = 2"), "n/a").otherwise(F.col("Volume").cast("string"))
    line = F.concat_ws("|", "KeyID", "CustomerCode", "POSCode", F.concat(F.lit(" "), "StationName", F.lit(" ")), "CloseDateKey", "TransNumber", "TransDateKey",
                       "TransTime", "ReceiptNumber", F.lit("1"), F.lit("2"), "Grade", "GradeTitle", F.lit("9.5"), volume, "Amount", F.lit("¡Å"), F.col("Part").cast("string"))
    return rows.select(line.alias("value"), name.alias("FileName"), (F.col("TransNumber") % 5).alias("i"))


def _loaded(spark, sf, with_tables=False):
    lines, stations, mapping = _fuel_lines(spark, sf), _stations(spark, sf), _mapping(spark, sf)
    kept = pos_files.FeedTables(scratch_path(spark, "pos"), STAGING, FACT, REJECTS)
    known = stations.filter("cast(POSCode as int) % 4 <> 1")
    for rows, sites in ((lines, known), (lines.filter("i >= 3"), stations)):
        folder = write_parts(spark, rows.drop("i"))
        paths = {ledgers.SYSTEM_A: f"{folder}/*/*TRN.CSV", ledgers.SYSTEM_B: f"{folder}/*/*TRNFLOWCO.CSV"}
        state = pos_files.load_files(spark, kept, paths, "TRN", sites, mapping, AS_OF, 7)
    return (state, kept) if with_tables else state


# Files 0 to 2 keep their first keys (1 to 6), 3 and 4 have those of the second load.  A row of files 0 to 2 whose station was not
# known at first comes from the quarantine, and is netted apart from the rows loaded before.
_FILES = _FUEL + """,
lines as (select *, trans % 5 as i, case when trans % 97 = 0 and line = 2 then null else cast(volume as decimal(15,3)) end as vol from found),
marked as (
  select *, case when error is not null then error when sys = 'FIRSTPRO' and vol is null then 'Mismatch Volume' end as err, i < 3 and supp % 4 <> 1 as early,
    cast(case when i < 3 then 2 * i + 1 else 2 * i + 5 end + case sys when 'FLOWCO' then 1 else 0 end as integer) as key from lines)
"""


@case(_FILES + """,
netted as (select *, cast(sum(vol) over (partition by close_day, trans, key, early) as double) as v,
  cast(sum(cast(amount as decimal(18,2))) over (partition by close_day, trans, key, early) as double) as a from marked where err is null)
select trans, line, cast(part as varchar) as chief, key as file_key, sk as station_key, coalesce(m1, m2) as product_key, chr(3585) || chr(3621) as attendee,
  case sys when 'FIRSTPRO' then v else cast(vol as double) end as volume, case sys when 'FIRSTPRO' then a else cast(amount as double) end as amount
from netted where sys = 'FLOWCO' or vol >= 0""")
def pos_files_fact(spark, sf):
    return _loaded(spark, sf).fact.select(
        F.col("TransNumber").alias("trans"), F.col("ReceiptNumber").alias("line"), F.col("ChiefNumber").alias("chief"), F.col("FileKey").alias("file_key"),
        F.col("StationKey").alias("station_key"), F.col("ProductKey").alias("product_key"), F.col("AttendeeNumber").alias("attendee"),
        number("Volume").alias("volume"), number("Amount").alias("amount"))


@case(_FILES + "select trans, line, cast(part as varchar) as chief, key as file_key, err as error from marked where err is not null")
def pos_files_rejects(spark, sf):
    return _loaded(spark, sf).rejects.select(F.col("TransNumber").alias("trans"), F.col("ReceiptNumber").alias("line"), F.col("ChiefNumber").alias("chief"),
                                             F.col("FileKey").alias("file_key"), F.col("Error").alias("error"))


@case(_FILES + """,
arrived as (select distinct i, sys from marked),
sent as (select i, sys, 2 * i + 1 as k, case when i < 3 then 1 else 4 end as status from arrived union all select i, sys, 2 * i + 5, 1 from arrived where i >= 3)
select cast(k + case sys when 'FLOWCO' then 1 else 0 end as integer) as file_key, '2025010' || i || '#1TRN' || case sys when 'FLOWCO' then 'FLOWCO' else '' end || '.CSV' as file_name,
  sys as cat, 'TRN' as sub, 20240615 as load_date, 153005 as load_time, cast(status as smallint) as status from sent""")
def pos_files_ledger(spark, sf):
    return out(_loaded(spark, sf).ledger)


@case(_FILES + """,
arrived_lines as (select * replace (i + 1 + case sys when 'FLOWCO' then 5 else 0 end as key), case when error is not null then error when sys = 'FIRSTPRO' and vol is null then 'Mismatch Volume' end as e from marked),
netted as (select *, cast(sum(vol) over (partition by close_day, trans, key) as double) as v from arrived_lines where e is null)
select trans, line, cast(part as varchar) as chief, cast(key as integer) as file_key, sk as station_key, case sys when 'FIRSTPRO' then v else cast(vol as double) end as volume
from netted where sys = 'FLOWCO' or vol >= 0""")
def streamed_feed_fact(spark, sf):
    """The files arrive as a stream for each system; a last call finds nothing new."""
    lines, stations, mapping = _fuel_lines(spark, sf), _stations(spark, sf), _mapping(spark, sf)
    kept = pos_files.FeedTables(scratch_path(spark, "pos"), STAGING, FACT, REJECTS)
    folder, progress = write_parts(spark, lines.drop("i")), scratch_path(spark, "progress")
    paths = {ledgers.SYSTEM_A: f"{folder}/*/*TRN.CSV", ledgers.SYSTEM_B: f"{folder}/*/*TRNFLOWCO.CSV"}
    for _ in range(2):
        state = ingest.load_arrived(spark, kept, paths, "TRN", stations, mapping, progress, AS_OF, 7)
    return state.fact.select(F.col("TransNumber").alias("trans"), F.col("ReceiptNumber").alias("line"), F.col("ChiefNumber").alias("chief"), F.col("FileKey").alias("file_key"),
                             F.col("StationKey").alias("station_key"), number("Volume").alias("volume"))


@case(_FILES + """,
netted as (select *, cast(sum(vol) over (partition by close_day, trans, key, early) as double) as v from marked where err is null)
select trans, line, key as file_key, case sys when 'FIRSTPRO' then v else cast(vol as double) end as volume from netted where sys = 'FLOWCO' or vol >= 0""")
def pos_files_compacted(spark, sf):
    """The rows of files that were sent again are off the disk; nothing else has changed."""
    _, kept = _loaded(spark, sf, True)
    state = pos_files.compact(spark, kept)
    return state.stored.select(F.col("TransNumber").alias("trans"), F.col("ReceiptNumber").alias("line"), F.col("FileKey").alias("file_key"), number("Volume").alias("volume"))


@case(_FILES + """,
keyed_lines as (select * replace (2 * i + 1 + case sys when 'FLOWCO' then 1 else 0 end as key) from marked),
again as (select *, sum(vol) over (partition by close_day, trans, key) as v from keyed_lines where err is null and supp % 4 = 1)
select 'fact' as part, trans, line, cast(key as integer) as file_key, case sys when 'FIRSTPRO' then cast(v as double) else cast(vol as double) end as volume, cast(null as varchar) as error
from again where sys = 'FLOWCO' or vol >= 0
union all select 'rejects', trans, line, cast(key as integer), null, err from keyed_lines where err is not null""")
def replay_changed_keys(spark, sf):
    """A quarter of the stations become known; only the rows of those are looked up again, the rest of the quarantine stays."""
    lines, stations, mapping = _fuel_lines(spark, sf), _stations(spark, sf), _mapping(spark, sf)
    kept = pos_files.FeedTables(scratch_path(spark, "pos"), STAGING, FACT, REJECTS)
    known = stations.filter("cast(POSCode as int) % 4 <> 1")
    folder = write_parts(spark, lines.drop("i"))
    paths = {ledgers.SYSTEM_A: f"{folder}/*/*TRN.CSV", ledgers.SYSTEM_B: f"{folder}/*/*TRNFLOWCO.CSV"}
    state = pos_files.load_files(spark, kept, paths, "TRN", known, mapping, AS_OF, 7)
    done = pos.replay_changed(state.rejects, state.ledger, "TRN", (known, mapping), (stations, mapping), STAGING, FACT)
    columns = [F.col("TransNumber").alias("trans"), F.col("ReceiptNumber").alias("line"), F.col("FileKey").alias("file_key")]
    loaded = done.loaded.select(F.lit("fact").alias("part"), *columns, number("Volume").alias("volume"), F.lit(None).cast("string").alias("error"))
    return loaded.unionByName(done.rejects.select(F.lit("rejects").alias("part"), *columns, F.lit(None).cast("double").alias("volume"), F.col("Error").alias("error")))


@case("select lang as feed, cast(1 as bigint) as files from documents where lang <= 'en' group by lang")
def empty_file_list(spark, sf):
    """A file for each language; languages after 'en' have rows in theirs, the others none."""
    docs, folder = tables(spark, sf, "documents"), scratch_path(spark, "empties")
    docs.filter("lang > 'en'").select(F.col("doc_id").cast("string"), "lang").write.partitionBy("lang").text(f"{folder}")
    for row in docs.select("lang").distinct().filter("lang <= 'en'").collect():  # a folder of a language each
        spark.range(0).select(F.lit("").alias("value")).write.text(f"{folder}/lang={row.lang}")
    found = feeds.empty_files(spark, f"{folder}/lang=*")
    return found.select(F.regexp_extract("path", "/lang=([^/]+)/[^/]+$", 1).alias("feed")).groupBy("feed").agg(F.count(F.lit(1)).alias("files"))


# ---- tables ----------------------------------------------------------------------


@case("select cast(n_nationkey as varchar) as n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey from nation")
def metadata_table(spark, sf):
    """A metadata table is text, whatever wrote it."""
    path = scratch_path(spark, "meta")
    tables(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey").write.option("header", True).csv(path)
    return store.metadata(spark, path)


@case("select o_orderkey, o_custkey, o_orderstatus from orders")
def bucketed_table(spark, sf):
    name = f"millrace_{uuid.uuid4().hex}"
    store.save_table(tables(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), name, bucket_by=(4, ["o_orderkey"]))
    return store.by_name(spark, name)


@case("""select o_orderkey, case when o_orderkey % 3 = 0 then -o_custkey else o_custkey end as o_custkey, case when o_orderkey % 3 = 0 then 'new' else o_orderstatus end as o_orderstatus
  from orders""")
def bucketed_merge(spark, sf):
    """A third of the rows come again or for the first time; bucket meets bucket."""
    orders, name = tables(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), f"millrace_{uuid.uuid4().hex}"
    store.save_table(orders.filter("o_orderkey % 3 <> 0 or o_orderkey % 2 = 0"), name, bucket_by=(8, ["o_orderkey"]))
    delta = orders.filter("o_orderkey % 3 = 0").withColumns({"o_custkey": -F.col("o_custkey"), "o_orderstatus": F.lit("new")})
    return store.merge_bucketed(spark, name, delta, ["o_orderkey"], 8, f"{name}_next")


@case("select o_orderkey, o_custkey from orders where o_orderkey % 2 = 1")
def truncated_table(spark, sf):
    """All rows go, the columns stay, new rows come."""
    orders, path = tables(spark, sf, "orders").select("o_orderkey", "o_custkey"), scratch_path(spark, "truncate")
    store.write(orders, path, "overwrite")
    store.truncate(spark, path, orders.schema)
    store.write(orders.filter("o_orderkey % 2 = 1"), path)
    return store.by_path(spark, path)


@case("select s_suppkey, s_name, s_nationkey from supplier")
def schema_of_table(spark, sf):
    """Text in another order is brought to a table's own columns and types."""
    supplier = tables(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    text = supplier.select(*[F.col(c).cast("string").alias(c) for c in reversed(supplier.columns)])
    return conform_table(text, store.schema_of(supplier))


# ---- audit, ledger, statements, stations ----------------------------------------------


@case("""select 'Success' as status, cast(count(*) filter (o_orderkey % 2 = 0) as varchar) as before, cast(count(*) as varchar) as after, cast(null as varchar) as message from orders
union all select 'Fail', cast(count(*) as varchar), null, 'no more rows' from orders""")
def audited_load(spark, sf):
    """An append between two counts, then one that fails; both leave a row."""
    orders, path, log = tables(spark, sf, "orders").select("o_orderkey"), scratch_path(spark, "audited"), scratch_path(spark, "audit")
    store.write(orders.filter("o_orderkey % 2 = 0"), path)
    moments = iter(datetime.fromisoformat(AS_OF) + timedelta(seconds=i) for i in range(4))

    def fail():
        raise RuntimeError("no more rows")

    for step in (lambda: store.write(orders.filter("o_orderkey % 2 <> 0"), path), fail):
        audit.run_audited(spark, step, lambda: store.by_path(spark, path).count(), lambda row: store.write(row, log),
                          {"PIPELINENAME": "orders", "TABLE_NAME": "orders"}, lambda: next(moments), raise_error=False)
    return store.by_path(spark, log, audit.AUDIT).select(F.col("STATUS_ACTIVITY").alias("status"), F.col("COUNTROWSBEFORE").alias("before"),
                                                         F.col("COUNTROWSAFTER").alias("after"), F.col("ERRORMESSAGE").alias("message"))


@case("""select 'orders' as name, 'Success' as status, '0' as before, cast(count(*) filter (o_orderkey % 2 = 0) as varchar) as after from orders
union all select 'orders', 'Success', cast(count(*) filter (o_orderkey % 2 = 0) as varchar), cast(count(*) as varchar) from orders
union all select 'lines', 'loaded', cast(count(*) filter (p_partkey is not null) as varchar), cast(count(*) as varchar) from lineitem left join (select * from part where p_size <= 25) on l_partkey = p_partkey""")
def observed_load(spark, sf):
    """Two appends and a lookup, counted by their writes alone."""
    orders, line, part = tables(spark, sf, "orders", "lineitem", "part")
    path, log = scratch_path(spark, "observed"), scratch_path(spark, "audit")
    moments = iter(datetime.fromisoformat(AS_OF) + timedelta(seconds=i) for i in range(4))
    for rest in (0, 1):
        audit.run_observed(spark, orders.select("o_orderkey").filter(F.col("o_orderkey") % 2 == rest), lambda df: store.write(df, path), lambda row: store.write(row, log),
                           {"PIPELINENAME": "orders", "TABLE_NAME": "orders"}, lambda: next(moments), audit.last_count(spark, log, "orders"))
    split = lookup(line.select("l_orderkey", "l_partkey"), part.filter("p_size <= 25"), {"l_partkey": "p_partkey"}, ["p_brand"], "Mismatch")
    found = store.write_split(split, scratch_path(spark, "split"))
    rows = store.by_path(spark, log, audit.AUDIT).select(F.col("TABLE_NAME").alias("name"), F.col("STATUS_ACTIVITY").alias("status"), F.col("COUNTROWSBEFORE").alias("before"),
                                                         F.col("COUNTROWSAFTER").alias("after"))
    return rows.unionByName(spark.createDataFrame([("lines", "loaded", str(found["loaded"]), str(found["rows"]))], rows.schema))


@case(f"""
with {_LEDGER}, numbered as (select * replace (cast(row_number() over (order by file_name) as integer) as file_key) from ledger)
select file_key, file_name, cat, sub, load_date, load_time, cast(case when file_key = (select max(file_key) from numbered) then 5 else status end as smallint) as status from numbered""")
def ledger_edit(spark, sf):
    """One row changed by its key."""
    files = old_ledger(spark, sf)
    empty = spark.createDataFrame([], ledgers.LEDGER)
    keys = ledgers.reserve(empty, files, AS_OF).select("FileKey", "FileName")
    ledger = files.drop("FileKey").join(keys, "FileName").select(*files.columns)
    last = ledger.agg(F.max("FileKey")).first()[0]
    return out(ledgers.edit_one(ledger, last, {"LoadStatus": 5}))


@case(f"""
with {_STATEMENT},
old as (select doc, month, amount from normal where txt like '%CPICK%' and cast(doc as bigint) % 8 = 0),
new as (select doc, month, amount + 1 as amount from normal where txt like '%CPICK%' and month < '1995')
select * from old where month not in (select month from new) union all select * from new""")
def statement_months(spark, sf):
    """A statement replaces the document months that it covers."""
    rows, stations = _statement(spark, sf)
    lines = cash.normalise_statement(rows, cash.pickup_statement(), stations, AS_OF).matched.withColumnRenamed("Amount_DOC_Curr", "Amount")
    fact = lines.filter("cast(DOC_Number as bigint) % 8 = 0").select("DOC_Number", F.col("YYYYMM_DocDate").alias("YearMonth_DocDate"), "Amount")
    fact = conform_table(fact, T.StructType([T.StructField("DOC_Number", T.StringType()), T.StructField("YearMonth_DocDate", T.StringType()),
                                             T.StructField("Amount", T.DecimalType(18, 2))]))
    staged = lines.filter("YYYYMM_DocDate < '1995'").withColumn("Amount", F.col("Amount") + 1)
    done = cash.replace_statement_months(fact, staged)
    return done.select(F.col("DOC_Number").alias("doc"), F.col("YearMonth_DocDate").alias("month"), number("Amount").alias("amount"))


@case("""
with src as (select k, party, grp from (select l_suppkey as k, 'P' || l_partkey as party, l_returnflag as grp,
   row_number() over (partition by l_suppkey order by l_shipdate desc, 'P' || l_partkey desc, l_returnflag desc) as r from lineitem) where r = 1),
d as (select s_suppkey as k from supplier where s_suppkey % 2 = 0)
select cast(d.k as varchar) as customer_code, src.party as party, src.grp as grp, case when src.k is null then null else 'x' end as province from d left join src using (k)
union all select cast(k as varchar), party, grp, 'x' from src where k not in (select k from d)""")
def station_update(spark, sf):
    """The whole station job: every mirrored column of the newest sales row."""
    supplier, line = tables(spark, sf, "supplier", "lineitem")
    columns = sales.station_columns("X")
    dimension = supplier.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("string").alias("CustomerCode"), *[F.lit(None).cast("string").alias(c) for c in columns])
    given = {"SoldtoParty": F.concat(F.lit("P"), "l_partkey"), "SalesGroupSoldTo": F.col("l_returnflag")}
    staged = line.select(F.col("l_suppkey").cast("int").alias("SoldtoPartyKey"), F.col("l_shipdate").alias("CalendarDay"),
                         *[given.get(theirs, F.lit("x")).alias(theirs) for theirs in dict.fromkeys(columns.values())])
    done = sales.update_stations(dimension, staged, "X")
    return done.select(F.col("CustomerCode").alias("customer_code"), F.col("XSoldtoName").alias("party"), F.col("XSalesGroupSoldTo").alias("grp"),
                       F.col("XProvince").alias("province"))

"""Point-of-sale feeds: the feed loads themselves, on order lines dressed up as raw feed rows."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cases.base import case, number, tables
from millrace.plans import pos

# Order lines as staging rows.  Stations are suppliers (some unknown), grades come from parts.
_BASE = """
base as (
  select l_orderkey as trans, l_linenumber as line, l_partkey as part, l_suppkey as supp, cast(l_partkey % 60 as integer) as g,
    case when l_linestatus = 'F' then 'FLOWCO' else 'FIRSTPRO' end as sys, 20240101 + l_orderkey % 28 as close_day,
    cast(l_orderkey % 50 as integer) as file_key,
    case when l_linenumber = 1 and l_orderkey % 2 = 0 then 0 when l_returnflag = 'R' then -l_quantity else l_quantity end as volume,
    case when l_linenumber = 1 and l_orderkey % 2 = 0 then 0 when l_returnflag = 'R' then -l_extendedprice else l_extendedprice end as amount,
    case when l_linenumber = 1 then '' else 'T' || (l_partkey % 60 % 5) end as title from lineitem),
stations as (select s_suppkey, cast(s_suppkey + 100 as integer) as sk from supplier where s_suppkey % 10 <> 0),
files as (select unnest(['TRANSACTION', 'AR', 'METERS', 'TANKS']) as file),
systems as (select unnest(['FIRSTPRO', 'FLOWCO']) as sys),
grades as (select distinct cast(p_partkey % 60 as integer) as g from part),
titled as (
  select file, sys, g, 'T' || (g % 5) as title, g * 10 + case sys when 'FIRSTPRO' then 1 else 2 end as m from grades, files, systems where g % 3 = 0
  union all select file, 'FIRSTPRO', g, 'LUBE', g * 10 + 5 from grades, files where g % 4 = 0),
placed as (
  select distinct file, sys, cast(l_partkey % 60 as integer) as g, cast(l_suppkey + 100 as integer) as sk, l_suppkey % 4 <> 0 as untitled, cast(7000 + l_partkey % 60 as integer) as m
  from lineitem, files, systems where l_partkey % 60 % 3 = 1 and l_suppkey % 2 = 0)
"""


def _chain(title, file, fallback, condition="true"):
    """SQL of a feed with station and product lookups."""
    return f"""
with {_BASE},
named as (select *, {title} as t from base),
st as (select named.*, sk from named left join stations on supp = s_suppkey),
found as (
  select st.*, x.m as m1, y.m as m2, case when st.sk is null then 'Mismatch StationKey' when x.m is null and y.m is null then 'Mismatch ProductKey' end as error
  from st
  left join (select * from titled where file = '{file}') x on st.sk is not null and x.sys = st.sys and x.g = st.g and x.title = st.t
  left join (select * from placed where file = '{fallback}' and {condition}) y on st.sk is not null and x.m is null and y.sys = st.sys and y.g = st.g and y.sk = st.sk)
"""


def _rows(spark, sf, feed):
    line = tables(spark, sf, "lineitem")
    blank = F.expr("l_linenumber = 1 and l_orderkey % 2 = 0")

    def signed(name, kind):
        value = F.col(name).cast(kind)
        return F.when(blank, F.lit(0)).when(F.col("l_returnflag") == "R", -value).otherwise(value).cast(kind)

    grade = F.expr("l_partkey % 60")
    supplier = F.col("l_suppkey").cast("string")
    is_b = F.col("l_linestatus") == "F"
    name = F.concat(F.lit("20250101#1"), F.lit(feed), F.when(is_b, "FLOWCO").otherwise(""), F.lit(".CSV"))
    key = F.col("l_linenumber").cast("string")
    return line.select(
        F.col("l_orderkey").cast("string").alias("KeyID"), F.concat(F.lit("C"), F.expr("l_suppkey % 7").cast("string")).alias("CustomerCode"),
        supplier.alias("POSCode"), F.concat(F.lit("Site "), supplier, F.lit(" x")).alias("StationName"),
        (F.col("l_orderkey") % 28 + 20240101).cast("int").alias("CloseDateKey"), F.col("l_orderkey").alias("TransNumber"),
        (F.col("l_orderkey") % 28 + 20240101).cast("int").alias("TransDateKey"),
        F.concat(F.lit("1"), key, F.lit(":30")).alias("TransTime"), F.col("l_linenumber").alias("ReceiptNumber"),
        F.col("l_partkey").alias("Part"), grade.cast("string").alias("Grade"), grade.cast("int").alias("GradeNumber"),
        F.when(F.col("l_linenumber") == 1, "").otherwise(F.concat(F.lit("T"), (grade % 5).cast("string"))).alias("GradeTitle"),
        signed("l_quantity", "decimal(15,3)").alias("Volume"), signed("l_extendedprice", "decimal(18,2)").alias("Amount"),
        (F.col("l_orderkey") % 50).cast("int").alias("FileKey"), name.alias("FileName"), is_b.alias("__b"), "l_orderkey")


def _stations(spark, sf):
    supplier = tables(spark, sf, "supplier").filter("s_suppkey % 10 <> 0")
    code = F.col("s_suppkey").cast("string")
    return supplier.select((F.col("s_suppkey") + 100).cast("int").alias("StationKey"),
                           F.concat(F.lit("C"), F.expr("s_suppkey % 7").cast("string")).alias("CustomerCode"),
                           code.alias("POSCode"), F.concat(F.lit("Si te"), code, F.lit("x")).alias("PosName"))


def _mapping(spark, sf):
    part, line = tables(spark, sf, "part", "lineitem")
    files = F.explode(F.array(*[F.lit(f) for f in ("TRANSACTION", "AR", "METERS", "TANKS")])).alias("SourceFile")
    systems = F.explode(F.array(F.lit("FIRSTPRO"), F.lit("FLOWCO"))).alias("SourceName")
    grades = part.select(F.expr("cast(p_partkey % 60 as int)").alias("g")).distinct().select("g", files).select("*", systems)
    none = F.lit(None).cast("int")
    text = F.col("g").cast("string")
    in_a = F.col("SourceName") == "FIRSTPRO"
    plain = grades.filter("g % 3 = 0").select("SourceName", "SourceFile", text.alias("SourceKey"),
        F.concat(F.lit(" T"), (F.col("g") % 5).cast("string"), F.lit(" ")).alias("SourceTitle"), none.alias("StationKey"),
        (F.col("g") * 10 + F.when(in_a, 1).otherwise(2)).alias("MappingKey"))
    lube = grades.filter(in_a & (F.col("g") % 4 == 0)).select("SourceName", "SourceFile", text.alias("SourceKey"),
        F.lit("LUBE").alias("SourceTitle"), none.alias("StationKey"), (F.col("g") * 10 + 5).alias("MappingKey"))
    pairs = line.select(F.expr("cast(l_partkey % 60 as int)").alias("g"), "l_suppkey").filter("g % 3 = 1 and l_suppkey % 2 = 0").distinct()
    placed = pairs.select("*", files).select("*", systems).select("SourceName", "SourceFile", text.alias("SourceKey"),
        F.when(F.expr("l_suppkey % 4 = 0"), "Z").alias("SourceTitle"), (F.col("l_suppkey") + 100).cast("int").alias("StationKey"),
        (F.col("g") + 7000).alias("MappingKey"))
    return plain.unionByName(lube).unionByName(placed)


def load(spark, sf, feed, staged=None):
    staged = _rows(spark, sf, feed) if staged is None else staged
    return pos.load_feed(staged, feed, _stations(spark, sf), _mapping(spark, sf))


def _out(df, extra):
    columns = {"TransNumber": "trans", "ReceiptNumber": "line", "Part": "part", "FileKey": "file_key", **extra}
    return df.select(*[F.col(a).alias(b) for a, b in columns.items()])


_ID = "trans, line, part, file_key"
_FUEL = _chain("case when title = '' and volume = 0 and amount = 0 then 'LUBE' else title end", "TRANSACTION", "TRANSACTION")


@case(_FUEL + f""",
netted as (select *, cast(sum(cast(volume as decimal(15,3))) over (partition by close_day, trans, file_key, sys) as double) as v,
  cast(sum(cast(amount as decimal(18,2))) over (partition by close_day, trans, file_key, sys) as double) as a from found where error is null)
select {_ID}, sk as station_key, coalesce(m1, m2) as product_key, '1' || line || '3000' as time_key, cast(floor(close_day / 10000) as bigint) as year_key, t as title,
  case sys when 'FIRSTPRO' then v else volume end as volume, case sys when 'FIRSTPRO' then a else amount end as amount
from netted where sys = 'FLOWCO' or volume >= 0""")
def feed_fuel_fact(spark, sf):
    loaded = load(spark, sf, "TRN").matched
    loaded = loaded.withColumns({"Volume": number("Volume"), "Amount": number("Amount")})
    return _out(loaded, {"StationKey": "station_key", "ProductKey": "product_key", "TransTimeKey": "time_key", "YearKey": "year_key",
                         "ReGradeTitle": "title", "Volume": "volume", "Amount": "amount"})


@case(_FUEL + f"select {_ID}, sk as station_key, error from found where error is not null")
def feed_fuel_rejects(spark, sf):
    return _out(load(spark, sf, "TRN").rejected, {"StationKey": "station_key", "Error": "error"})


@case(_FUEL + "select count(*) as input, count(*) - count(error) as matched, count(error) as rejected, true as complete from found")
def feed_completeness(spark, sf):
    staged = _rows(spark, sf, "AR_TRANSACTIONS").withColumns({"GradeNumber": F.col("Grade"), "LubeCode": F.lit(""), "LBAmount": F.lit(0), "AttendantNumber": F.lit("1")})
    return load(spark, sf, "AR_TRANSACTIONS", staged).counts(staged)


@case(_chain("case when title = '' and abs(volume) < 1 and abs(amount) < 1 then 'LUBE' else title end", "AR", "TRANSACTION") + f"""
select {_ID}, sk as station_key, coalesce(m1, m2) as grade_key, case when line % 2 = 0 then '0' else 'L' end as lube, line as attendee, error from found""")
def feed_receivable(spark, sf):
    staged = _rows(spark, sf, "AR_TRANSACTIONS").withColumns({
        "LubeCode": F.when(F.col("ReceiptNumber") % 2 == 0, "").otherwise("L"), "LBAmount": F.lit(1), "AttendantNumber": F.col("ReceiptNumber")})
    return _out(load(spark, sf, "AR_TRANSACTIONS", staged).frame,
                {"StationKey": "station_key", "GradeKey": "grade_key", "CastLubeCode": "lube", "AttendeeNumber": "attendee", "Error": "error"})


@case(_chain("title", "METERS", "METERS", "(sys = 'FLOWCO' or untitled)") + f"select {_ID}, sk as station_key, coalesce(m1, m2) as product_key, error from found")
def feed_meters(spark, sf):
    return _out(load(spark, sf, "EOD_METERS").frame, {"StationKey": "station_key", "ProductKey": "product_key", "Error": "error"})


@case(_chain("title", "TANKS", "TANKS", "sys = 'FIRSTPRO'") + f"""
select {_ID}, sk as station_key, coalesce(m1, m2) as product_key, error from found where error is null or not (g = 2 and volume = 0)""")
def feed_tanks(spark, sf):
    staged = _rows(spark, sf, "EOD_TANKS")
    # System B sends no usable station name; its stations are found by code and customer alone.
    staged = staged.withColumns({"StationName": F.when(F.col("__b"), "?").otherwise(F.col("StationName")),
                                 **{name: F.col("Volume") for name in ("OpenVolume", "CloseVolume", "DeliveryVolume")}})
    return _out(load(spark, sf, "EOD_TANKS", staged).frame, {"StationKey": "station_key", "ProductKey": "product_key", "Error": "error"})


_STATION_ONLY = f"with {_BASE}, st as (select base.*, sk, case when sk is null then 'Mismatch StationKey' end as error from base left join stations on supp = s_suppkey)"


@case(_STATION_ONLY + f"""
select {_ID}, sk as station_key, error,
  case when sys = 'FIRSTPRO' then case when line % 2 = 0 then '00000000' else '20240101' end end as pay_date,
  case when sys = 'FIRSTPRO' then case when line % 3 = 0 then '999999' when error is null then '1' || line || '3015' else '1' || line || ':30:15' end end as pay_time,
  case when sys = 'FIRSTPRO' then case when line % 5 = 0 then '999999' when error is null then line || '4500' else '0' || line || '4500' end end as end_time from st""")
def feed_payment(spark, sf):
    line = F.col("ReceiptNumber")
    text = line.cast("string")
    staged = _rows(spark, sf, "PMT").withColumns({
        "PAY_Date": F.when(line % 2 == 0, " ").otherwise("20240101"), "PAY_Time": F.when(line % 3 == 0, "").otherwise(F.concat(F.lit("1"), text, F.lit(":30:15"))),
        "End_Date": F.lit("20240101"), "End_Time": F.when(line % 5 == 0, "").otherwise(F.concat(F.lit("0"), text, F.lit(":45")))})
    return _out(load(spark, sf, "PMT", staged).frame, {"StationKey": "station_key", "Error": "error", "PAY_Date": "pay_date",
                                                       "PAY_Time": "pay_time", "End_Time": "end_time"})


@case(_STATION_ONLY + f"""
select {_ID}, sk as station_key, error, cast(close_day as varchar) as day, '1' || line || ':05' as clock, cast(floor(close_day / 10000) as bigint) as year_key from st""")
def feed_points(spark, sf):
    stamp = F.concat(F.col("TransDateKey").cast("string"), F.lit("  1"), F.col("ReceiptNumber").cast("string"), F.lit(":05"))
    loaded = load(spark, sf, "POINTS", _rows(spark, sf, "POINTS").withColumn("Collect_TimeStemp", stamp)).frame
    return _out(loaded, {"StationKey": "station_key", "Error": "error", "Collect_Date": "day", "Collect_Time": "clock", "YearKey": "year_key"})


@case(_STATION_ONLY + f"select {_ID}, sk as station_key, error, line || '30000' as time_key from st")
def feed_free(spark, sf):
    staged = _rows(spark, sf, "FREE").withColumn("TransTime", F.concat(F.col("ReceiptNumber").cast("string"), F.lit(":30")))
    loaded = load(spark, sf, "FREE", staged).frame
    return _out(loaded, {"StationKey": "station_key", "Error": "error", "TransTimeKey": "time_key"})


_PLAIN = _STATION_ONLY + f"select {_ID}, sk as station_key, error, '1' || line || '3000' as time_key from st"


def _plain(feed):
    def run(spark, sf):
        return _out(load(spark, sf, feed).frame, {"StationKey": "station_key", "Error": "error", "TransTimeKey": "time_key"})
    return run


for _feed, _name in (("LUB", "feed_lube"), ("DSC", "feed_discount"), ("REFUND", "feed_refund")):
    case(_PLAIN, _name)(_plain(_feed))


# A whole load: one file was loaded before and comes again, quarantined rows are replayed.
_BATCH_TYPES = [("TransNumber", T.LongType()), ("ReceiptNumber", T.IntegerType()), ("Part", T.LongType()), ("FileKey", T.IntegerType()), ("StationKey", T.IntegerType())]

def _batch(spark, sf):
    rows = _rows(spark, sf, "LUB").withColumn("FileName", F.concat(F.lit("20250101#1LUB"), F.expr("FileKey % 10"), F.when(F.col("__b"), "FLOWCO").otherwise(""), F.lit(".CSV")))
    # Two sendings of ten names each for system A and B share a key here; 10..19 sends the names of 0..9 again.
    stations = _stations(spark, sf)
    staged = rows.filter("FileKey between 10 and 19")
    known = pos.load_feed(rows.filter("FileKey between 0 and 9"), "LUB", stations)
    fact_schema = T.StructType([T.StructField(n, k) for n, k in _BATCH_TYPES])
    reject_names = ["TransNumber", "ReceiptNumber", "Part", "FileKey", "StationKey", "CustomerCode", "POSCode", "StationName", "TransTime", "Error"]
    fact = known.matched.select(*fact_schema.names).unionByName(rows.filter("FileKey between 20 and 29 or FileKey >= 40").select(
        *fact_schema.names[:4], F.lit(1).alias("StationKey")))
    # Rejected rows of 30..39 wait with a station name that has since been corrected.
    waiting = rows.filter("FileKey between 30 and 39").select(
        "TransNumber", "ReceiptNumber", "Part", "FileKey", F.lit(None).cast("int").alias("StationKey"), "CustomerCode", "POSCode", "StationName", "TransTime",
        F.lit(pos.NO_STATION).alias("Error")).select(*reject_names)
    old = rows.select("FileKey").distinct()
    ledger = old.select("FileKey", F.concat(F.lit("n"), F.expr("case when FileKey < 20 then FileKey % 10 else FileKey end")).alias("FileName"),
                        F.lit("FIRSTPRO").alias("CategoryName"), F.lit("LUBE").alias("SubCategoryName"), F.lit(20250101).alias("LoadDateKey"), F.lit(0).alias("LoadTimeKey"),
                        F.when(F.expr("FileKey not between 10 and 19"), 1).cast("smallint").alias("LoadStatus"))
    staged = staged.withColumn("FileName", F.concat(F.lit("n"), F.expr("FileKey % 10")))
    return pos.run_feed(staged, "LUB", stations, None, fact, waiting, ledger)


@case(_STATION_ONLY + f"""
select {_ID}, case when file_key between 20 and 29 or file_key >= 40 then 1 else sk end as station_key from st
where (file_key between 20 and 29) or file_key >= 40 or (file_key between 10 and 19 and sk is not null) or (file_key between 30 and 39 and sk is not null)""")
def feed_batch_fact(spark, sf):
    return _out(_batch(spark, sf).fact, {"StationKey": "station_key"})


@case(_STATION_ONLY + f"select {_ID}, error from st where (file_key between 10 and 19 or file_key between 30 and 39) and sk is null")
def feed_batch_rejects(spark, sf):
    return _out(_batch(spark, sf).rejects, {"Error": "error"})


@case(f"""
with {_BASE} select distinct file_key, cast(case when file_key between 0 and 9 then 4 else 1 end as smallint) as status from base""")
def feed_batch_ledger(spark, sf):
    return _batch(spark, sf).ledger.select(F.col("FileKey").alias("file_key"), F.col("LoadStatus").alias("status"))

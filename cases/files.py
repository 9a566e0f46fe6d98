"""The file ledger, built from documents and orders."""

from pyspark.sql import functions as F

from cases.base import AS_OF, case, tables
from millrace.operators import ledger as ledgers
from millrace.operators.slices import replay_input

_NAMES = """
named as (
  select doc_id, n_chars, '202501' || lpad(substr(source, 4), 2, '0') || '#9910' || cast(doc_id % 3 as varchar) ||
    case lang when 'en' then 'TRN' when 'fr' then 'PMT' when 'de' then 'EOD_TANKS' else 'CPU' end ||
    case when cast(substr(source, 4) as integer) % 2 = 1 then 'FLOWCO' else '' end || '.CSV' as file_name,
    case lang when 'en' then 'TRN' when 'fr' then 'PAYMENT' when 'de' then 'TANKS' else 'CPU' end as sub,
    case when cast(substr(source, 4) as integer) % 2 = 1 then 'FLOWCO' else 'FIRSTPRO' end as cat
  from documents)
"""


def named(spark, sf):
    """Documents as rows of raw files whose names tell system and feed."""
    docs = tables(spark, sf, "documents")
    source = F.substring("source", 4, 10)
    feed = F.when(F.col("lang") == "en", "TRN").when(F.col("lang") == "fr", "PMT").when(F.col("lang") == "de", "EOD_TANKS").otherwise("CPU")
    name = F.concat(F.lit("202501"), F.lpad(source, 2, "0"), F.lit("#9910"), F.expr("doc_id % 3").cast("string"), feed,
                    F.when(source.cast("int") % 2 == 1, "FLOWCO").otherwise(""), F.lit(".CSV"))
    return docs.select("doc_id", "n_chars", name.alias("FileName"))


def old_ledger(spark, sf):
    """A row for every file of the documents, in several states."""
    files = ledgers.parse_file_name(named(spark, sf).select("FileName").distinct())
    size = F.length("FileName")
    return files.select(
        (F.expr("cast(substring(FileName, 7, 2) as int)") * 1000 + F.expr("cast(substring(FileName, 14, 1) as int)") * 100
         + F.length("SubCategoryName") * 10 + F.length("CategoryName") % 7).cast("int").alias("FileKey"),
        "FileName", "CategoryName", "SubCategoryName", F.lit(20250101).alias("LoadDateKey"), F.lit(0).alias("LoadTimeKey"),
        F.when(size % 3 == 0, 1).when(size % 3 == 1, 2).cast("smallint").alias("LoadStatus"))


_LEDGER = f"""
{_NAMES},
ledger as (select distinct cast(cast(substr(file_name, 7, 2) as integer) * 1000 + cast(substr(file_name, 14, 1) as integer) * 100
    + length(sub) * 10 + length(cat) % 7 as integer) as file_key, file_name, cat, sub, 20250101 as load_date, 0 as load_time,
    cast(case length(file_name) % 3 when 0 then 1 when 1 then 2 end as smallint) as status
  from named where sub <> 'CPU')
"""


def out(ledger):
    return ledger.toDF("file_key", "file_name", "cat", "sub", "load_date", "load_time", "status")


@case(f"with {_NAMES} select distinct file_name, cat, sub from named where sub <> 'CPU'")
def file_name_parts(spark, sf):
    return ledgers.parse_file_name(named(spark, sf).select("FileName").distinct()).toDF("file_name", "cat", "sub")


@case(f"""
with {_LEDGER},
fresh as (select distinct file_name, cat, sub from named where sub <> 'CPU')
select cast((select max(file_key) from ledger) + dense_rank() over (order by file_name) as integer) as file_key, file_name, cat, sub,
  20240615 as load_date, 153005 as load_time, cast(null as smallint) as status from fresh""")
def file_keys(spark, sf):
    files = ledgers.parse_file_name(named(spark, sf).select("FileName"))
    return out(ledgers.reserve(old_ledger(spark, sf), files, AS_OF, 7))


@case(f"""
with {_LEDGER},
twice as (select file_key + 5 as file_key, file_name from ledger where status is null union all select file_key, file_name from ledger where status is null)
select doc_id, max(file_key) as file_key from named left join twice using (file_name) group by doc_id""")
def newest_reserved_key(spark, sf):
    ledger = old_ledger(spark, sf)
    again = ledger.filter("LoadStatus is null").withColumn("FileKey", (F.col("FileKey") + 5).cast("int"))
    return ledgers.attach_key(named(spark, sf), ledger.unionByName(again)).select("doc_id", F.col("FileKey").alias("file_key"))


@case(f"with {_LEDGER} select doc_id, file_key, file_name from named join ledger using (file_name)")
def attach_file_name(spark, sf):
    ledger = old_ledger(spark, sf)
    keyed = named(spark, sf).join(ledger.select("FileName", "FileKey"), "FileName").select("doc_id", "FileKey")
    return ledgers.attach_name(keyed, ledger).select("doc_id", F.col("FileKey").alias("file_key"), F.col("FileName").alias("file_name"))


@case(f"""
with {_LEDGER} select file_key, file_name, cat, sub, load_date, load_time,
  cast(case when sub = 'TRN' and (status in (1, 3, 5, -99) or status is null) then 4 else status end as smallint) as status from ledger""")
def ledger_superseded(spark, sf):
    ledger = old_ledger(spark, sf)
    return out(ledgers.mark_superseded(ledger, ledger.filter("SubCategoryName = 'TRN'")))


@case(f"""
with {_LEDGER} select file_key, file_name, cat, sub, case when sub = 'PAYMENT' then 20240615 else load_date end as load_date, load_time,
  cast(case when sub = 'PAYMENT' then 3 else status end as smallint) as status from ledger""")
def ledger_status(spark, sf):
    ledger = old_ledger(spark, sf)
    return out(ledgers.set_columns(ledger, ledger.filter("SubCategoryName = 'PAYMENT'"), {"LoadStatus": 3, "LoadDateKey": 20240615}))


@case(f"""
with {_LEDGER}, staged as (select distinct file_key from named join ledger using (file_name)),
still as (select distinct file_key from named join ledger using (file_name) where n_chars > 2000)
select file_key, file_name, cat, sub, load_date, load_time, cast(case when file_key in (select file_key from staged) and
  file_key not in (select file_key from still) then 1 else status end as smallint) as status from ledger""")
def ledger_replayed(spark, sf):
    ledger = old_ledger(spark, sf)
    rows = named(spark, sf).join(ledger.select("FileName", "FileKey"), "FileName")
    return out(ledgers.mark_replayed(ledger, rows, rows.filter("n_chars > 2000")))


@case(f"with {_LEDGER} select distinct file_name from named where file_name in (select file_name from ledger) and doc_id % 2 = 0")
def files_seen_before(spark, sf):
    incoming = named(spark, sf).filter("doc_id % 2 = 0")
    return ledgers.seen_before(incoming, old_ledger(spark, sf)).withColumnRenamed("FileName", "file_name")


@case(f"""
with {_LEDGER} select file_key, file_name, cat, sub, load_date, load_time, cast(case
  when sub = 'TANKS' and cat = 'FLOWCO' then 3 when sub in ('PAYMENT', 'TANKS') then 1
  when sub = 'TRN' and (status in (1, 3, 5, -99) or status is null) then 4 else status end as smallint) as status from ledger""")
def ledger_all_feeds(spark, sf):
    ledger = old_ledger(spark, sf)
    feed = {name: ledger.filter(F.col("SubCategoryName") == name) for name in ("TRN", "PAYMENT", "TANKS")}
    return out(ledgers.apply_outcomes(ledger, [
        ledgers.FeedOutcome(superseded=feed["TRN"]), ledgers.FeedOutcome(loaded=feed["PAYMENT"]),
        ledgers.FeedOutcome(loaded=feed["TANKS"], failed=feed["TANKS"].filter("CategoryName = 'FLOWCO'"))]))


@case(f"""
with {_LEDGER} select file_key, file_name, cat, sub, load_date, load_time, status from ledger
union all select cast(99000 + doc_id as integer), 'doc' || doc_id, 'FIRSTPRO', 'TRN', 20240615, 83005, cast(1 as smallint) from documents where lang = 'en'""")
def ledger_append(spark, sf):
    keys = tables(spark, sf, "documents").filter("lang = 'en'").select(
        (F.col("doc_id") + 99000).cast("int").alias("FileKey"), F.concat(F.lit("doc"), "doc_id").alias("FileName"))
    rows = ledgers.new_rows(keys, "FIRSTPRO", "TRN", ledgers.LOADED, AS_OF)
    return out(ledgers.append(old_ledger(spark, sf), rows))


@case(f"""
with {_LEDGER} select doc_id, file_key, file_name from named left join ledger using (file_name) where n_chars > 2000 and file_key is not null
union all select doc_id, cast(null as integer), file_name from named where n_chars <= 2000""")
def quarantine_to_staging(spark, sf):
    ledger, rows = old_ledger(spark, sf), named(spark, sf)
    rejects = rows.filter("n_chars > 2000").join(ledger.select("FileName", "FileKey"), "FileName").select(
        "doc_id", "FileKey", F.lit("Mismatch StationKey").alias("Error"))
    staging = rows.filter("n_chars <= 2000").select("doc_id", F.lit(None).cast("int").alias("FileKey"), "FileName")
    return replay_input(rejects, ledger, staging).toDF("doc_id", "file_key", "file_name")

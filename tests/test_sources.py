import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import scratch
from millrace.operators.ledger import LEDGER
from millrace.operators.lookup import lookup
from millrace.sources import feeds, reports, tables
from millrace.streaming import ingest_new_files
from tests.conftest import rows_of

NOW = "2024-06-15 00:05:07"
LUBE = ["1", "C1", "77", "สถานี 7", "20240615", "9", "20240615", "08:30", "1", "L1", '"oil | 1"', "10", "2", "20"]


@pytest.fixture
def inbox(tmp_path):
    def put(name, *lines, encoding="iso8859_11"):
        (tmp_path / name).write_bytes("".join(f"{line}\n" for line in lines).encode(encoding))
        return str(tmp_path)
    return put


def line(**changes):
    cells = dict(zip(feeds.LAYOUTS["FLOWCO"]["LUB"], LUBE)) | changes
    return "|".join(cells.values())


def test_layout_sizes():
    sizes = {feed: (len(feeds.LAYOUTS["FIRSTPRO"][feed]), len(feeds.LAYOUTS["FLOWCO"].get(feed, []))) for feed in feeds.FEEDS}
    assert sizes == {"TRN": (18, 18), "LUB": (14, 14), "AR_TRANSACTIONS": (28, 28), "DSC": (11, 11), "EOD_TANKS": (12, 12), "PMT": (18, 14),
                     "EOD_METERS": (18, 18), "POINTS": (19, 0), "REFUND": (12, 0), "FREE": (23, 24)}


def test_read_feed(spark, inbox):
    inbox("20240615#99LUBFLOWCO.CSV", line(), line(KeyID="2", LubeName="short").rsplit("|", 2)[0])
    inbox("a+b ค%.CSV")  # zero bytes, as the next
    folder = inbox("20240615#98LUBFLOWCO.CSV")
    got = feeds.read_feed(spark, f"{folder}/*.CSV", "FLOWCO", "LUB", NOW, 7)
    assert got.schema.names == [*feeds.LAYOUTS["FLOWCO"]["LUB"], "FileName", "LoadDateKey", "LoadTimeKey"]
    assert rows_of(got, "KeyID", "StationName", "LubeName", "Quantity", "Amount", "FileName", "LoadDateKey", "LoadTimeKey") == [
        ("1", "สถานี 7", "oil | 1", "2", "20", "20240615#99LUBFLOWCO.CSV", 20240615, 70507),
        ("2", "สถานี 7", "short", None, None, "20240615#99LUBFLOWCO.CSV", 20240615, 70507)]
    assert rows_of(feeds.empty_files(spark, f"{folder}/*.CSV"), "FileName")[0] == ("20240615#98LUBFLOWCO.CSV",)
    assert feeds.empty_files(spark, f"{folder}/*.CSV").count() == 2
    assert rows_of(feeds.incoming_files(spark, f"{folder}/*.CSV")) == [("20240615#99LUBFLOWCO.CSV", "FLOWCO", "LUBE")]


def test_only_empty_files_give_the_schema(spark, inbox):
    folder = inbox("20240615#98LUB.CSV")
    got = feeds.read_feed(spark, folder, "FIRSTPRO", "LUB", NOW)
    assert got.count() == 0 and got.schema.names[:2] == ["KeyID", "CustomerCode"]


def test_both_systems_on_one_staging_schema(spark, inbox, frame):
    cells = ["1", "C", "7", "S", "20240615", "1", "20240615", "08:30", "1", "CASH", "10", "", "", "D"]
    inbox("20240615#1PMT.CSV", "|".join([*cells, "20240615", "08:31:00", "20240615", "08:32"]))
    folder = inbox("20240615#2PMTFLOWCO.CSV", "|".join(cells))
    a = feeds.read_feed(spark, f"{folder}/*#1PMT.CSV", "FIRSTPRO", "PMT", NOW)
    b = feeds.read_feed(spark, f"{folder}/*#2PMT*", "FLOWCO", "PMT", NOW)
    ledger = spark.createDataFrame([(8, "20240615#1PMT.CSV", "FIRSTPRO", "PAYMENT", 1, 1, None), (9, "20240615#1PMT.CSV", "FIRSTPRO", "PAYMENT", 1, 1, None)], LEDGER)
    staged = feeds.stage_feed([a, b], ledger, "PMT")
    assert rows_of(staged, "FileKey", "PAY_Time", "PMCode") == [(None, None, "CASH"), (9, "08:31:00", "CASH")]
    cleaned = feeds.clean_staging(staged)
    assert rows_of(cleaned, "PAY_Time", "FileKey") == [("", 0), ("08:31:00", 9)]


def test_stream_loads_each_file_once(spark, inbox, tmp_path):
    seen = []

    def load(rows, batch):
        seen.extend((r.FileName, r.KeyID, r.StationName) for r in rows.collect())

    folder = tmp_path / "in"
    folder.mkdir()
    for name, key in (("20240615#1LUB.CSV", "1"), ("20240616#1LUB.CSV", "2")):
        (folder / name).write_bytes((line(KeyID=key) + "\n").encode("iso8859_11"))
        ingest_new_files(spark, str(folder), "FIRSTPRO", "LUB", str(tmp_path / "progress"), load, NOW)
    assert seen == [("20240615#1LUB.CSV", "1", "สถานี 7"), ("20240616#1LUB.CSV", "2", "สถานี 7")]


REPORT = "Title\r\n\r\na\r\nb\r\n\r\n\tG/L Acc.\t Text\tDocument.No.\r\n\t-\t-\t-\r\n\t1000\tหนึ่ง\t 5\r\n\t\ttotal\t\r\n\t2000\tสอง\t6\r\nsum\r\nend\r\n"


def test_report_from_utf16(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(REPORT.encode("utf-16"))
    texts = reports.read_texts(spark, str(tmp_path))
    got = reports.report_rows(reports.report_lines(texts, skip=5, after_header=1, trailer=2), ["Text", "G_L Acc", "DocumentNo", "Absent"], required="DocumentNo")
    assert rows_of(got) == [("a.txt", 7, "หนึ่ง", "1000", " 5", None), ("a.txt", 9, "สอง", "2000", "6", None)]


def test_report_columns_are_found_by_name_in_each_file(frame):
    texts = frame("f string, text string", ("x", "A\tB\n1\t2"), ("y", "B\tA\n1\t2\n"), ("z", "A\n"))
    got = reports.report_rows(reports.report_lines(texts, skip=0), ["A", "B"])
    assert rows_of(got, "f", "A", "B") == [("x", "1", "2"), ("y", "2", "1")]


def test_match_columns(frame):
    schema = T.StructType([T.StructField("SoldtoPartyKey", T.IntegerType()), T.StructField("Note", T.StringType())])
    assert rows_of(reports.match_columns(frame("`Sold-to party - KEY` string", "7"), schema)) == [(7, None)]
    with pytest.raises(ValueError, match="does not know"):
        reports.match_columns(frame("other int", 1), schema)


def test_write_and_overwrite(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    df = frame("k int, p string", (1, "a"), (2, "b"))
    tables.write(df, path, "overwrite", ["p"])
    tables.overwrite_partitions(frame("k int, p string", (9, "a"), (8, "c")), path, ["p"])
    assert rows_of(tables.by_path(spark, path)) == [(2, "b"), (8, "c"), (9, "a")]
    tables.write(df, path, "overwrite", ["p"])
    assert rows_of(tables.by_path(spark, path)) == [(1, "a"), (2, "b")]


def test_partition_upsert_touches_only_what_it_must(spark, frame, tmp_path):
    path, schema = str(tmp_path / "p"), "k int, v string, p string"
    tables.write(frame(schema, (1, "a", "x y"), (2, "b", "01"), (3, "c", "z+%"), (4, "d", "01"), (9, "n", None)), path, "overwrite", ["p"])
    untouched = {f for f in spark.read.parquet(path).inputFiles() if "p=01" in f}
    source = frame(schema, (1, "A", "new"), (3, "C", "new"), (5, "E", "x y"), (6, "F", None))
    target = tables.by_path(spark, path, source.schema)
    assert rows_of(tables.touched_partitions(target, source, ["k"], ["p"])) == [(None,), ("new",), ("x y",), ("z+%",)]
    tables.upsert_partitions(spark, path, source, ["k"], ["p"], source.schema)
    got = tables.by_path(spark, path, source.schema)
    assert rows_of(got) == [(1, "A", "new"), (2, "b", "01"), (3, "C", "new"), (4, "d", "01"), (5, "E", "x y"), (6, "F", None), (9, "n", None)]
    assert untouched <= set(got.inputFiles())


def test_touched_partitions_prune_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "p")
    tables.write(spark.range(1000).selectExpr("id as k", "id % 50 as p"), path, "overwrite", ["p"])
    part = tables.in_partitions(tables.by_path(spark, path), frame("p int", 3, 4))
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "p#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert part.count() == 40


def test_versions(spark, frame, tmp_path):
    path = str(tmp_path / "v")
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, path)
    tables.write_next(frame("k int", 1, 2), path)
    for _ in range(3):
        tables.write_next(tables.read_current(spark, path).select((F.col("k") + 1).alias("k")), path)
    assert tables.versions(spark, path) == [3, 4]
    (tmp_path / "v" / "version=5").mkdir()  # a job that failed before it finished
    assert rows_of(tables.read_current(spark, path)) == [(4,), (5,)]


def test_truncate_keeps_the_schema(spark, frame, tmp_path):
    df, path = frame("k int, v string", (1, "a")), str(tmp_path / "t")
    tables.write(df, path)
    tables.truncate(spark, path, tables.schema_of(df))
    got = tables.by_path(spark, path)
    assert (got.count(), got.schema.simpleString()) == (0, "struct<k:int,v:string>")


def test_split_is_written_in_one_pass(spark, frame, tmp_path):
    split = lookup(frame("k int", 1, 2), frame("c int, v int", (1, 5)), {"k": "c"}, ["v"], "no")
    tables.write_split(split, str(tmp_path / "s"))
    got = spark.read.parquet(str(tmp_path / "s"))
    assert rows_of(got.filter("rejected = true"), "k", "Error") == [(2, "no")]
    assert rows_of(got.filter("rejected = false"), "k", "v") == [(1, 5)]


def test_catalog_table_and_query(spark, frame):
    spark.sql("drop table if exists millrace_t")
    tables.save_table(frame("k int, p string", (1, "a"), (2, "b")), "millrace_t", bucket_by=(2, ["k"]))
    assert rows_of(tables.by_name(spark, "millrace_t"), "k") == [(1,), (2,)]
    plan = tables.by_name(spark, "millrace_t").groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert rows_of(tables.by_sql(spark, "select k from {x} where p = 'a'", x=tables.by_name(spark, "millrace_t"))) == [(1,)]
    spark.sql("drop table millrace_t")


@pytest.mark.parametrize("name, precision, scale, want", [
    ("StringType", None, None, "string"), ("Datetype", None, None, "date"), ("datetype", None, None, "date"), ("float", None, None, "decimal(38,18)"),
    ("double", "10", "2.0", "decimal(10,2)"), ("short", None, None, "smallint"), ("DecimalType", "36", "", "decimal(36,18)"), ("BinaryType", None, None, "binary"), ("doubletype", None, None, "double")])
def test_type_names(name, precision, scale, want):
    assert tables.type_of(name, precision, scale).simpleString() == want


def test_tables_from_metadata(spark, tmp_path):
    (tmp_path / "meta.csv").write_text("TableName,Place,ColumnName,DataType,Precision,Scale,forPartition\nt,l,k,int,,,0\nt,l,m,decimal,10,2,0\nt,l,p,str,,,1\nu,l,d,DateType,,,0\n")
    meta = tables.metadata(spark, str(tmp_path / "meta.csv"))
    created = tables.create_tables(spark, meta, str(tmp_path / "db"))
    assert {n: s.simpleString() for n, s in created.items()} == {"t": "struct<k:int,m:decimal(10,2),p:string>", "u": "struct<d:date>"}
    assert tables.declared_tables(meta)["t"][1] == ["p"]
    assert tables.by_path(spark, str(tmp_path / "db" / "t"), created["t"]).count() == 0
    with pytest.raises(ValueError, match="unknown type"):
        tables.type_of("blob")


def test_retype(frame):
    assert rows_of(tables.retype(frame("a string", "1", "x"), {"a": "int"})) == [(None,), (1,)]


def test_scratch_is_the_configured_folder(spark, frame):
    assert scratch.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = scratch.materialise(frame("k int", 1), "x")
    assert stored.inputFiles()[0].startswith(spark.conf.get("spark.checkpoint.dir").replace("file://", "file:").replace("file:/", "file:///", 1)[:7])
    assert rows_of(stored) == [(1,)]


def test_cluster_without_shared_folder_is_refused():
    class Context:
        master, applicationId = "spark://host", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session())


def test_upsert_keeps_text_partitions_without_a_schema(spark, frame, tmp_path):
    path = str(tmp_path / "text_parts")
    tables.write(frame("k int, v string, p string", (1, "a", "01"), (2, "b", "02"), (4, "d", "1"), (5, "e", None)), path, "overwrite", ["p"])
    tables.upsert_partitions(spark, path, frame("k int, v string, p string", (1, "A", "01"), (3, "C", "03"), (5, "E", None)), ["k"], ["p"])
    assert rows_of(tables.by_path(spark, path, T.StructType.fromDDL("k int, v string, p string"))) == [(1, "A", "01"), (2, "b", "02"), (3, "C", "03"), (4, "d", "1"), (5, "E", None)]


def test_reports_read_in_many_splits(spark, tmp_path):
    """Two reports of many splits, with blank lines and CRLF: the same lines as when each is one row."""
    for name, n, end in (("a#1.txt", 3000, "\n"), ("b.txt", 2500, "\r\n")):
        body = end.join(["p"] * 5 + ["Text\tG/L Acc.\tDocument.No"] + [""] + [f"row {i}\t{'x' * (i % 50)}\t{i if i % 7 else ''}" if i % 11 else "" for i in range(n)] + ["total", "end"])
        (tmp_path / name).write_bytes((body + (end if n == 3000 else "")).encode())
    whole = reports.report_lines(reports.read_texts(spark, str(tmp_path), "UTF-8"), skip=5, after_header=1, trailer=2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = reports.read_lines(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    split = reports.body_lines(lines, skip=5, after_header=1, trailer=2)
    assert lines.count() > 5000 and {*whole.columns, "Path"} == set(split.columns)
    assert rows_of(split, "FileName", "line_no", F.to_json("cells"), F.to_json("header")) == rows_of(whole, "FileName", "line_no", F.to_json("cells"), F.to_json("header"))

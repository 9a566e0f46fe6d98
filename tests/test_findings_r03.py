"""Findings of round 3: nothing that is small makes the rows it is joined to move, and a line costs no more than its length."""

import time

from pyspark.sql import functions as F

from cases.jobs import FACT, REJECTS, STAGING
from millrace.functions import columns as c
from millrace.plans import pos, pos_files
from millrace.scratch import scratch_path
from millrace.sources import feeds, reports
from tests.conftest import rows_of
from tests.test_plans import fuel, mapping, stations  # noqa: F401


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_path_of_long_parts_is_decoded_in_time(spark):
    paths = spark.range(40, numPartitions=1).select(F.concat(F.repeat(F.lit("x"), 40_000), F.lit("/"), "id", F.lit("%231.CSV?a/b")).alias("p"))
    begun = time.time()
    assert rows_of(paths.select(c.decode_file_name("p")))[0] == ("0#1.CSV",) and time.time() - begun < 8
    plain = spark.createDataFrame([("",), ("a/",), ("a?b/c",), ("a/?b",), (None,), ("/a%23b",)], "p string")
    assert rows_of(plain.select("p", c.decode_file_name("p"))) == [(None, None), ("", ""), ("/a%23b", "a#b"), ("a/", ""), ("a/?b", "b"), ("a?b/c", "a")]


def test_an_empty_store_has_no_size(spark):
    """The first load finds its file keys without moving the raw rows to the tasks of their file names."""
    kept = pos_files.FeedTables(scratch_path(spark, "pos"), STAGING, FACT, REJECTS)
    state = pos_files.current(spark, kept)
    assert state.ledger._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 1000
    assert [f.dataType for f in state.rejects.schema] == [f.dataType for f in REJECTS] and state.rejects.isEmpty()
    rows = spark.range(3).select(*[F.lit("x").alias(n) for n in feeds.layout("FIRSTPRO", "TRN").names], F.lit("f").alias("FileName"), F.lit(1).alias("LoadDateKey"), F.lit(2).alias("LoadTimeKey"))
    assert "SortMergeJoin" not in plan_of(feeds.stage_feed([rows], state.ledger, "TRN"))


def test_rejects_are_not_netted(frame, stations, mapping):  # noqa: F811
    split = pos.load_feed(fuel(frame, {}, {"TransNumber": 6, "StationName": "no"}, {"Volume": "abc", "TransNumber": 7}), "TRN", stations, mapping)
    assert "sum(" in plan_of(split.frame) and "sum(" not in plan_of(split.rejected)
    assert rows_of(split.rejected, "TransNumber", "Error") == [(6, pos.NO_STATION), (7, pos.NO_VOLUME)]
    assert rows_of(split.rejected) == rows_of(split.frame.filter("Error is not null").select(*split.rejected.columns))


def test_only_codes_of_the_station_map_meet_it(frame, stations, mapping):  # noqa: F811
    """Titles decide what no station entry can, and both ways give one row; a code held twice gives two, as before."""
    rows = fuel(frame, {"TransNumber": 1}, {"TransNumber": 2, "Grade": "2", "GradeTitle": "?"}, {"TransNumber": 3, "Grade": None}, {"TransNumber": 4, "Grade": "2", "StationName": "no"})
    twice = mapping.unionByName(mapping.filter("MappingKey = 300").withColumn("MappingKey", F.lit(301)))
    got = pos.load_feed(rows, "TRN", stations, twice).frame
    assert "SortMergeJoin" not in plan_of(pos._find_product(pos.prepare(rows, "TRN").withColumn("__system", F.lit("FIRSTPRO")), pos._known_size(stations), pos.product_maps(twice, pos.RULES["TRN"].product), pos.RULES["TRN"], False).frame)
    assert rows_of(got, "TransNumber", "ProductKey", "Error") == [(1, 100, None), (2, 300, None), (2, 301, None), (3, None, pos.NO_PRODUCT), (4, None, pos.NO_STATION)]


def test_few_changed_keys_do_not_move_the_quarantine(frame, stations, mapping):  # noqa: F811
    rows = pos.prepare(fuel(frame, {}, {"POSCode": "78", "StationName": "Site B", "CustomerCode": "C2", "TransNumber": 2}), "TRN").withColumn("__system", F.lit("FIRSTPRO"))
    marked = pos.touched_by_change(rows, "TRN", (stations.filter("POSCode = '77'"), mapping), (stations, mapping))
    assert "SortMergeJoin" not in plan_of(marked) and rows_of(marked, "TransNumber", "__hit") == [(1, False), (2, True)]


def test_small_splits_do_not_make_as_many_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(["p"] * 5 + ["A\tB"] + [f"row {i}\t{i}" for i in range(40_000)]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        lines = reports.read_lines(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len({name for name in lines.inputFiles() if "/lines-" in name}) <= 32
    body = reports.body_lines(lines)
    assert "SortMergeJoin" not in plan_of(body) and rows_of(body.agg(F.count("*"), F.min("line_no"), F.max("line_no"))) == [(40_000, 6, 40_005)]

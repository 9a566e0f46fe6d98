from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import audit
from millrace.operators.lookup import lookup
from millrace.operators.metrics import Check, checklist, reconcile, run_checklist, table_metrics
from millrace.sources import tables
from tests.conftest import rows_of

NOW = "2024-06-15 08:30:05"


def values(df):
    return {(r["index"], r.groupbyValue): None if r.value is None else float(r.value) for r in df.collect()}


@pytest.fixture
def sales(frame):
    return frame("g string, v double, d string, saledate string, n int", ("a", 0.1, "2024-01-05", "2024-01-05", None), ("a", 0.2, None, "2024-01-05", None), ("b", 5.0, "2024-02-01", "2024-03-01", None),
                 (None, None, "2023-12-31", None, None)).withColumn("d", F.col("d").cast("date"))


def test_every_kind(sales):
    checks = [Check(1, "t", "", "countrow"), Check(2, "t", "g", "distinct"), Check(3, "t", "v", "sum"), Check(4, "t", "v", "min"), Check(5, "t", "v", "max"),
              Check(6, "t", "d", "firstdate"), Check(7, "t", "d", "lastdate"), Check(8, "t", "v", "countnonnull"), Check(9, "t", "", "countby", "g"),
              Check(10, "t", "v", "countdistinctby", "g"), Check(11, "t", "v", "sumby", "g"), Check(12, "t", "", "countby", "saledate"), Check(13, "t", "n", "sum"), Check(14, "t", "n", "max")]
    got = values(table_metrics(sales, checks, NOW))
    assert got == {(1, ""): 4, (2, ""): 2, (3, ""): 5.3, (4, ""): 0.1, (5, ""): 5, (6, ""): 20231231, (7, ""): 20240201, (8, ""): 3,
                   (9, "a"): 2, (9, "b"): 1, (9, None): 1, (10, "a"): 2, (10, "b"): 1, (10, None): 0, (11, "a"): 0.3, (11, "b"): 5, (11, None): None,
                   (12, "20240105"): 2, (12, "20240301"): 1, (12, None): 1, (13, ""): None, (14, ""): None}


def test_empty_table_and_filters(sales):
    checks = [Check(1, "t", "", "countrow"), Check(2, "t", "v", "sum"), Check(3, "t", "", "countby", "g"), Check(4, "t", "g", "distinct")]
    assert values(table_metrics(sales.filter("false"), checks, NOW)) == {(1, ""): 0, (2, ""): None, (4, ""): 0}
    some = [Check(1, "t", "", "countrow", "", "g = 'a'"), Check(2, "t", "", "countrow"), Check(3, "t", "", "countby", "g", "g = 'a'"), Check(4, "t", "v", "sumby", "g")]
    assert values(table_metrics(sales, some, NOW)) == {(1, ""): 2, (2, ""): 4, (3, "a"): 2, (4, "a"): 0.3, (4, "b"): 5, (4, None): None}


def test_shared_filter_reaches_the_scan(sales, tmp_path):
    path = str(tmp_path / "t")
    sales.write.parquet(path)
    stored = sales.sparkSession.read.parquet(path)
    both = [Check(1, "t", "", "countrow", "", "g = 'a'"), Check(2, "t", "v", "sum", "", "g = 'a'")]
    plan = table_metrics(stored, both, NOW)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(g,a)" in plan and "ReadSchema: struct<g:string,v:double>" in plan


def test_values_without_an_exact_sum_spoil_only_their_own_check(frame):
    rows = frame("g string, x double, n bigint", ("a", 1e19, 2 ** 62), ("b", 0.5, 2 ** 62), ("b", 0.25, 1), ("c", float("nan"), 1), ("d", None, None))
    checks = [Check(1, "t", "x", "sum"), Check(2, "t", "x", "sum", "", "x < 1"), Check(3, "t", "", "countrow"), Check(4, "t", "x", "sumby", "g"), Check(5, "t", "n", "sum")]
    got = {(r["index"], r["groupbyValue"]): r["value"] for r in table_metrics(rows, checks, NOW).collect()}
    assert got == {(1, ""): None, (2, ""): Decimal("0.75000"), (3, ""): Decimal("5.00000"), (4, "a"): None, (4, "b"): Decimal("0.75000"), (4, "c"): None,
                   (4, "d"): None, (5, ""): None}


def test_unknown_kind():
    with pytest.raises(ValueError, match="unknown check"):
        Check(1, "t", "v", "median")


def test_checklist_runs_active_checks_over_tables(frame, sales):
    rows = frame("idx int, Table string, Column string, KeyCheck string, groupbyKey string, additionalSQLFilter string, check int",
                 (2, "Sales", None, "countrow", None, None, 1), (1, "sales", "v", "sum", None, "g = 'b'", 1), (3, "sales", "v", "max", None, None, 0), (4, "other", None, "countrow", None, None, 1))
    checks = checklist(rows)
    assert [c.index for c in checks] == [1, 2, 4]
    assert values(run_checklist({"SALES": sales, "other": frame("x int", 1)}, checks, NOW)) == {(1, ""): 5, (2, ""): 4, (4, ""): 1}


def test_reconcile(frame, sales):
    checks = [Check(1, "t", "", "countby", "g"), Check(2, "t", "", "countrow")]
    found = reconcile(table_metrics(sales, checks, NOW), table_metrics(sales.filter("g = 'a'"), checks, NOW))
    assert rows_of(found, "index", "groupbyValue", F.col("difference").cast("double").alias("x"), "agrees") == [
        (1, None, None, False), (1, "a", 0.0, True), (1, "b", None, False), (2, "", 2.0, False)]
    assert reconcile(table_metrics(sales, checks, NOW), table_metrics(sales.filter("g = 'a'"), checks, NOW), tolerance=2).filter("index = 2").first().agrees


def test_audit_row_and_counts(spark, frame):
    row = audit.audit_row(spark, {"PIPELINENAME": "p", "TABLE_NAME": "t"}, datetime(2024, 6, 15, 8, 30), NOW)
    got = audit.with_counts(row, frame("x int", 1), frame("x int", 1, 2)).first()
    assert (got.AUDITKEY, got.STATUS_ACTIVITY, got.COUNTROWSBEFORE, got.COUNTROWSAFTER, got.ERRORCODE) == ("p-t-2024-06-15_08_30_00", "Success", "1", "2", None)
    with pytest.raises(ValueError, match="not audit columns"):
        audit.audit_row(spark, {"X": 1}, NOW, NOW)


def test_audited_run_records_success_and_failure(spark):
    written, clock, counts = [], lambda: datetime(2024, 1, 1), iter([1, 5, 5])
    run = lambda step, **k: audit.run_audited(spark, step, lambda: next(counts), lambda df: written.append(df.first()), {"PIPELINENAME": "p", "TABLE_NAME": "t"}, clock, **k)
    assert run(lambda: None) is True
    with pytest.raises(ZeroDivisionError):
        run(lambda: 1 / 0)
    assert (written[0].COUNTROWSBEFORE, written[0].COUNTROWSAFTER, written[0].STATUS_ACTIVITY) == ("1", "5", "Success")
    assert (written[1].COUNTROWSAFTER, written[1].STATUS_ACTIVITY, written[1].ERRORMESSAGE) == (None, "Fail", "division by zero")
    counts = iter([1])
    assert run(lambda: 1 / 0, raise_error=False) is False


def test_sizes_and_observed_count(frame, tmp_path):
    df = frame("a int, b int", (1, 2), (3, 4))
    assert rows_of(audit.table_sizes({"t": df, "u": df.filter("a > 9")})) == [("t", 2, 2), ("u", 0, 2)]
    watched, seen = audit.counted(df)
    watched.write.parquet(str(tmp_path / "o"))
    assert seen.get == {"rows": 2}


def test_distinct_counts_share_a_scan(spark, tmp_path):
    """Equal values of every type count once, whatever they look like; five counts take one scan."""
    rows = [(0.0, float("nan"), "a", 1, datetime(2024, 10, 27, 0, 30), b"x", [1]), (-0.0, float("nan"), "A", None, datetime(2024, 10, 27, 1, 30), b"x", [1]), (1.5, None, "a ", 1, None, b"", [2])]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "d double, f float, s string, k int, t timestamp, b binary, l array<int>").write.parquet(path)
    df = spark.read.parquet(path)
    names = ["d", "f", "s", "k", "t", "b"]
    found = table_metrics(df, [Check(i, "t", n, "distinct") for i, n in enumerate(names)], "2024-06-15 08:30:05")
    want = df.agg(*[F.count_distinct(n) for n in names]).first()
    assert [int(r.value) for r in found.orderBy("index").collect()] == list(want)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    mixed = table_metrics(df, [Check(1, "t", "l", "distinct"), Check(2, "t", "s", "countdistinctby", "k"), Check(3, "t", "d", "countdistinctby", "k", "s <> 'A'")], "2024-06-15 08:30:05")
    assert rows_of(mixed, "index", "groupbyValue", F.col("value").cast("int").alias("v")) == [(1, "", 2), (2, None, 1), (2, "1", 2), (3, "1", 2)]


def test_counts_come_with_the_write(spark, tmp_path, monkeypatch):
    """Neither the rows nor the two halves of a split are counted by a job of their own."""
    log, path, halves = str(tmp_path / "log"), str(tmp_path / "t"), str(tmp_path / "s")
    moments = iter(datetime(2024, 1, 1, 0, 0, i) for i in range(20))
    step = lambda df, **more: audit.run_observed(spark, df, lambda f: f.write.mode("append").parquet(path), lambda row: row.write.mode("append").parquet(log),
                                                 {"TABLE_NAME": "t", "PIPELINENAME": "p"}, lambda: next(moments), before=audit.last_count(spark, log, "t"), **more)
    monkeypatch.setattr(DataFrame, "count", lambda self: pytest.fail("a count job"))
    assert step(spark.range(10)) and step(spark.range(0)) and step(spark.range(7).selectExpr("id"))
    assert not step(spark.range(5).selectExpr("assert_true(id < 3) as x", "id").select("id", "x"), raise_error=False)
    found = [(r.STATUS_ACTIVITY, r.COUNTROWSBEFORE, r.COUNTROWSAFTER) for r in spark.read.parquet(log).orderBy("STARTTIME").collect()]
    assert found == [("Success", "0", "10"), ("Success", "10", "10"), ("Success", "10", "17"), ("Fail", "17", None)]
    split = lookup(spark.range(6).selectExpr("id as k"), spark.range(2).selectExpr("id as c", "id + 1 as v"), {"k": "c"}, ["v"], "no")
    assert tables.write_split(split, halves) == {"rows": 6, "loaded": 2, "rejected": 4}

import random

from pyspark.sql import functions as F

from millrace.operators.keys import (all_but_latest, allocate_keys, file_keys, flag_latest, highest, latest_per_key, number_rows)
from tests.conftest import rows_of


def test_numbers_are_dense_and_ordered_over_many_tasks(spark, frame):
    values = list(range(5000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, v % 3) for v in values], "v int, w int").repartition(7)
    for tasks in (None, 13):
        got = rows_of(number_rows(df, ["v"], "n", after=10, tasks=tasks), "v", "n")
        assert got == [(v, v + 11) for v in range(5000)]


def test_numbering_a_value_most_rows_share(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("hot"), "id")
    got = number_rows(df, ["hot", "id"], "n", tasks=6)
    assert got.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first()[:] == (3000, 1, 3000)
    ordered = [r.id for r in got.orderBy("n").collect()]
    assert ordered == [r.id for r in df.orderBy("hot", "id").collect()]
    # No task holds the hot value's rows as a whole.
    assert got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 2000


def test_allocation_continues_after_gaps_and_on_an_empty_target(frame):
    df = frame("k int, b string", (7, "x"), (None, "b"), (None, "a"), (3, "y"))
    assert rows_of(allocate_keys(df, "k", ["b"])) == [(3, "y"), (7, "x"), (8, "a"), (9, "b")]
    assert allocate_keys(df, "k", ["b"]).schema["k"].dataType.simpleString() == "int"
    fresh = frame("k int, b string", (None, "q"))
    assert rows_of(allocate_keys(fresh, "k", ["b"])) == [(1, "q")]
    assert rows_of(allocate_keys(fresh, "k", ["b"], existing=df, stage=True)) == [(8, "q")]
    none_new = frame("k int, b string", (1, "z"))
    assert rows_of(allocate_keys(none_new, "k", ["b"])) == [(1, "z")]


def test_highest_of_an_empty_table(frame):
    df = frame("k int", 4)
    assert df.select(highest(df, "k"), highest(df.filter("k < 0"), "k")).first()[:] == (4, 0)


def test_latest_and_all_but_latest(frame):
    df = frame("k string, d int, id int", ("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", None, 4), (None, 1, 5), (None, 2, 6))
    newest = latest_per_key(df, ["k"], [F.col("d").desc(), F.col("id").desc()])
    assert rows_of(newest, "id") == [(3,), (4,), (6,)]
    assert rows_of(all_but_latest(df, ["k"], ["d", "id"]), "id") == [(1,), (2,), (5,)]


def test_latest_flag(frame):
    df = frame("m string, s int, i int, id int, e int",
               ("a", 1, 1, 1, None), ("a", 2, 1, 2, None), ("a", 2, 1, 3, None),   # tie: greatest id
               ("b", 1, 1, 4, None), ("b", 9, 1, 5, 20240101),                       # a closed row is newest
               ("c", None, None, 6, None), (None, 1, 1, 7, None))
    opened = F.col("e").isNull()
    assert rows_of(flag_latest(df, "m", ["s", "i"], "id", "f", opened), "id", "f") == [(1, 0), (2, 0), (3, 1), (4, 0), (5, 0), (6, 1), (7, 1)]
    assert rows_of(flag_latest(df, "m", ["s", "i"], "id", "f", opened, rank_open_only=True), "id", "f")[3:5] == [(4, 1), (5, 0)]


def test_file_keys_are_one_per_name(frame):
    files = frame("FileName string", "b", "a", "b")
    assert rows_of(file_keys(files, frame("FileKey int", 41))) == [("a", 42), ("b", 43)]

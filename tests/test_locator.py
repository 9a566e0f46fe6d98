"""Merges into a partitioned history by its locator, and rewrites that stop half way."""

import pytest
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameWriter

from millrace.sources import journal, locator
from millrace.sources import tables as store
from tests.conftest import rows_of

SCHEMA = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType()), T.StructField("p", T.StringType()), T.StructField("q", T.IntegerType())])


def history(spark, tmp_path, rows, buckets=8):
    kept = locator.History(spark, f"file://{tmp_path}/h", SCHEMA, "k", ["p", "q"], buckets)
    kept.merge(spark.createDataFrame(rows, SCHEMA))
    return kept


def test_a_row_is_found_in_its_old_partition(spark, tmp_path):
    kept = history(spark, tmp_path, [(1, "a", "x", 1), (2, "b", "x", 2), (3, "c", "y", 1), (4, "d", None, 1)])
    stored = store.by_path(spark, kept.path, kept.stored)
    untouched = {f for f in stored.inputFiles() if "/p=x/q=2/" in f}
    kept.merge(spark.createDataFrame([(1, "A", "z", 9), (4, "D", "y", 1), (5, "e", None, None)], SCHEMA))
    assert rows_of(kept.rows()) == [(1, "A", "z", 9), (2, "b", "x", 2), (3, "c", "y", 1), (4, "D", "y", 1), (5, "e", None, None)]
    now = set(store.by_path(spark, kept.path, kept.stored).inputFiles())
    assert untouched <= now and not [f for f in now if "/p=x/q=1/" in f]
    # places that rows have left may be listed, others not
    places = set(rows_of(store.by_path(spark, kept.locator, kept.places), "k", "p", "q"))
    assert {(r[0], r[2], r[3]) for r in rows_of(kept.rows())} < places
    kept.rebuild()
    assert set(rows_of(store.by_path(spark, kept.locator, kept.places), "k", "p", "q")) == {(r[0], r[2], r[3]) for r in rows_of(kept.rows())}


def test_finding_the_partitions_reads_only_the_buckets_of_the_keys(spark, tmp_path):
    kept = history(spark, tmp_path, [(i, "a", "x", i % 3) for i in range(100)], buckets=50)
    found = kept.known_places(spark.createDataFrame([(7, "b", "x", 0)], SCHEMA))
    files = [f for f in found.inputFiles() if "/millrace/" not in f]
    whole = store.by_path(spark, kept.locator, kept.places).inputFiles()
    assert files and all("/locator/" in f for f in files) and len({f.split("/Bucket=")[1].split("/")[0] for f in whole}) > 20
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [Bucket" in plan or "PartitionFilters: [isnotnull(Bucket" in plan
    assert rows_of(found, "k", "p", "q") == [(7, "x", 1)]


class Stop(BaseException):
    pass


def stopped(patch, n):
    """The n-th write, mark, move or delete doesn't happen, nor does anything after it."""
    calls = [0]

    def counted(real):
        def call(*args, **more):
            calls[0] += 1
            if calls[0] == n:
                raise Stop
            return real(*args, **more)
        return call

    for owner, name in ((DataFrameWriter, "parquet"), (journal, "_mark"), (journal, "_move"), (journal, "_delete")):
        patch.setattr(owner, name, counted(getattr(owner, name)))
    return calls


@pytest.mark.parametrize("kind", ["upsert", "history"])
def test_a_stop_at_any_step_is_made_good_by_the_next_run(spark, tmp_path, monkeypatch, kind):
    first = [(1, "a", "x", 1), (2, "b", "x", 2), (3, "c", "y", 1), (4, "d", "w", 4)]
    delta = spark.createDataFrame([(1, "A", "z", 9), (3, "C", "y", 1), (5, "e", None, 1)], SCHEMA)
    want = [(1, "A", "z", 9), (2, "b", "x", 2), (3, "C", "y", 1), (4, "d", "w", 4), (5, "e", None, 1)]
    n, ends = 0, 0
    while not ends:
        n += 1
        place = tmp_path / str(n)
        kept = history(spark, place, first)
        run = (lambda: kept.merge(delta)) if kind == "history" else lambda: store.upsert_partitions(spark, kept.path, delta, ["k"], ["p", "q"], kept.stored)
        with monkeypatch.context() as patch:
            stopped(patch, n)
            try:
                run()
                ends = n
            except Stop:
                pass
        if n % 2:  # a reader that repairs sees the rows before or after, whole
            journal.repair(spark, kept.path)
            assert rows_of(kept.rows()) in (sorted(first), want)
        run()
        assert rows_of(kept.rows()) == want, n
        assert not store.exists(spark, f"{kept.path}/{journal.FOLDER}") or not list((place / "h" / "rows" / journal.FOLDER).iterdir())
    assert ends > 8


def test_rows_of_other_partitions_are_refused(spark, tmp_path, frame):
    path = f"file://{tmp_path}/t"
    store.write(frame("k int, p int", (1, 1), (2, 2)), path, "overwrite", ["p"])
    with pytest.raises(ValueError, match="not to be rewritten"):
        store.rewrite_partitions(spark, path, frame("p int", 1), ["p"], lambda part: part.selectExpr("k", "p + 1 as p"))
    assert rows_of(store.by_path(spark, path, T.StructType.fromDDL("k int, p int"))) == [(1, 1), (2, 2)]

"""Raw files to tables: failed steps and reruns."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from cases.jobs import FACT, REJECTS, STAGING, write_files
from millrace.operators import ledger as ledgers
from millrace.plans import pos, pos_files
from millrace.scratch import scratch_path

NAME = "20250101#1TRN.CSV"
STATIONS = [(1, "C1", "5", "Site 5")], "StationKey int, CustomerCode string, POSCode string, PosName string"
MAPPING = [("FIRSTPRO", "TRANSACTION", "7", "T7", None, 70)], "SourceName string, SourceFile string, SourceKey string, SourceTitle string, StationKey int, MappingKey int"


def _line(receipt, volume, station="5"):
    return f"k|C1|{station}|Site {station}|20250101|1|20250101|10:30|{receipt}|1|2|7|T7|9.5|{volume}|10.00|a|b"


def _load(spark, kept, lines, feed="TRN"):
    files = lines if isinstance(lines, dict) else {NAME: lines}
    rows = spark.createDataFrame([(line, name) for name, own in files.items() for line in own], "value string, FileName string")
    folder = write_files(spark, rows)
    return pos_files.load_files(spark, kept, {ledgers.SYSTEM_A: f"{folder}/*TRN.CSV"}, feed, spark.createDataFrame(*STATIONS), spark.createDataFrame(*MAPPING), "2025-01-02 03:04:05")


def _seen(state):
    fact = sorted((r.ReceiptNumber, float(r.Volume), r.FileKey) for r in state.fact.collect())
    return fact, sorted((r.ReceiptNumber, r.Error) for r in state.rejects.collect()), {r.FileKey: r.LoadStatus for r in state.ledger.collect()}


def test_a_file_sent_again_replaces_its_rows(spark):
    kept = pos_files.FeedTables(scratch_path(spark, "pos"), STAGING, FACT, REJECTS)
    assert _seen(_load(spark, kept, [_line(1, 5), _line(2, 3, "6")])) == ([(1, 5.0, 1)], [(2, pos.NO_STATION)], {1: 1})
    assert _seen(_load(spark, kept, [_line(1, 6)])) == ([(1, 6.0, 2)], [], {1: 4, 2: 1})
    state = pos_files.current(spark, kept)
    assert {r[0] for r in state.fact.select(pos_files.LOAD).distinct().collect()} == {2} and state.stored.count() == 2
    seen = _seen(state)
    done = pos_files.compact(spark, kept)
    assert _seen(done) == seen and done.stored.count() == 1 and done.removed.isEmpty()
    assert _seen(_load(spark, kept, [_line(3, 1)]))[0] == [(3, 1.0, 3)] and not pos_files.store.exists(spark, f"{kept.root}/fact/{pos_files.LOAD}=1")


@pytest.mark.parametrize("step, status", [("clean_staging", ledgers.STAGING_FAILED), ("run_feed", ledgers.LOAD_FAILED), ("overwrite_partitions", ledgers.LOAD_FAILED)])
def test_a_failed_step_leaves_the_tables_and_is_noted(spark, monkeypatch, step, status):
    kept = pos_files.FeedTables(scratch_path(spark, "pos"), STAGING, FACT, REJECTS)
    first = _seen(_load(spark, kept, [_line(1, 5), _line(2, 3, "6")]))

    def fail(*args, **more):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        place = {"clean_staging": pos_files.feeds, "run_feed": pos_files.pos, "overwrite_partitions": pos_files.store}[step]
        patch.setattr(place, step, fail)
        with pytest.raises(RuntimeError, match="lost"):
            _load(spark, kept, [_line(1, 6)])
    fact, rejects, ledger = _seen(pos_files.current(spark, kept))
    assert (fact, rejects, ledger) == (first[0], first[1], {1: 1, 2: status})
    assert _seen(_load(spark, kept, [_line(1, 7)]))[0] == [(1, 7.0, 3)]


class Stop(BaseException):
    """The process is gone: nothing after it runs."""


def stop_at(patch, places, n):
    """The n-th call of the listed functions stops instead of doing its work; gives a counter of the calls."""
    calls = [0]

    def counted(real):
        def call(*args, **more):
            calls[0] += 1
            if calls[0] == n:
                raise Stop
            return real(*args, **more)
        return call

    for owner, name in places:
        patch.setattr(owner, name, counted(getattr(owner, name)))
    return calls


WRITES = [(DataFrameWriter, "parquet"), (pos_files.store, "drop_folder"), (pos_files.store, "commit_version")]


@pytest.mark.parametrize("work", ["load", "compact"])
def test_a_stop_at_any_write_or_delete_loses_nothing(spark, monkeypatch, work):
    """Two files loaded, a third, then the first and the third again: stopped at each write and delete in turn, then run again."""
    kept = pos_files.FeedTables(scratch_path(spark, "pos"), STAGING, FACT, REJECTS)
    a, b, c = ("20250101#1TRN.CSV", "20250102#1TRN.CSV", "20250103#1TRN.CSV")
    _load(spark, kept, {a: [_line(1, 5)], b: [_line(2, 3), _line(9, 3, "6")]})
    _load(spark, kept, {c: [_line(3, 4)]})
    if work == "compact":
        _load(spark, kept, {a: [_line(1, 6)], c: [_line(3, 7)]})
    run = {"load": lambda: _load(spark, kept, {a: [_line(1, 6)], c: [_line(3, 7)]}), "compact": lambda: pos_files.compact(spark, kept)}[work]
    receipts = lambda seen: [r[:2] for r in seen[0]]
    before, after = [(1, 5.0), (2, 3.0), (3, 4.0)], [(1, 6.0), (2, 3.0), (3, 7.0)]
    n = 0
    while True:
        n += 1
        number = pos_files.current(spark, kept).number
        with monkeypatch.context() as patch:
            calls = stop_at(patch, WRITES, n)
            try:
                run()
                break
            except Stop:
                pass
        seen = _seen(pos_files.current(spark, kept))
        assert receipts(seen) in ((before, after) if work == "load" and n > 1 else (before,) if work == "load" else (after,))
        assert {r for r, in [(x[0],) for x in seen[1]]} == {9}
        if pos_files.current(spark, kept).number == number and work == "load" and receipts(seen) == after:
            raise AssertionError("rows changed without a version")
        if receipts(seen) == after and work == "load":  # the version was complete before the stop
            before = after
    assert calls[0] < n and n > 5
    seen = _seen(pos_files.current(spark, kept))
    assert receipts(seen) == after and [r[0] for r in seen[1]] == [9]
    rows = pos_files.current(spark, kept).fact.select("FileKey").distinct()
    assert {seen[2][r[0]] for r in rows.collect()} == {1}


def test_a_batch_handed_over_again_is_loaded_once(spark):
    kept = pos_files.FeedTables(scratch_path(spark, "pos"), STAGING, FACT, REJECTS)
    folder = write_files(spark, spark.createDataFrame([(_line(1, 5), NAME)], "value string, FileName string"))
    rows = pos_files.feeds.read_feed(spark, folder, ledgers.SYSTEM_A, "TRN", "2025-01-02 03:04:05")
    given = (spark, kept, rows, "TRN", spark.createDataFrame(*STATIONS), spark.createDataFrame(*MAPPING), "2025-01-02 03:04:05")
    first = pos_files.load_rows(*given, batch=("s", 4))
    again = pos_files.load_rows(*given, batch=("s", 4))
    assert (again.number, _seen(again)) == (first.number, _seen(first)) == (1, ([(1, 5.0, 1)], [], {1: 1}))
    assert _seen(pos_files.load_rows(*given, batch=("s", 5))) == ([(1, 5.0, 2)], [], {1: 4, 2: 1})


def test_a_stream_that_stops_after_its_load_goes_on(spark, monkeypatch):
    from millrace.streaming import ingest
    kept, progress = pos_files.FeedTables(scratch_path(spark, "pos"), STAGING, FACT, REJECTS), scratch_path(spark, "progress")
    folder = write_files(spark, spark.createDataFrame([(_line(1, 5), NAME)], "value string, FileName string"))
    load = lambda: ingest.load_arrived(spark, kept, {ledgers.SYSTEM_A: folder}, "TRN", spark.createDataFrame(*STATIONS), spark.createDataFrame(*MAPPING),
                                       progress, "2025-01-02 03:04:05")
    real = pos_files.load_rows

    def lost(*args, **more):
        real(*args, **more)
        raise RuntimeError("after the load, before the stream notes the batch")

    with monkeypatch.context() as patch:
        patch.setattr(ingest.pos_files, "load_rows", lost)
        with pytest.raises(Exception, match="before the stream notes"):
            load()
    assert _seen(load()) == ([(1, 5.0, 1)], [], {1: 1}) and pos_files.current(spark, kept).number == 1
    assert _seen(load()) == ([(1, 5.0, 1)], [], {1: 1})  # nothing new has arrived


def test_rows_of_a_load_without_its_state_are_not_read(spark):
    kept = pos_files.FeedTables(scratch_path(spark, "pos"), STAGING, FACT, REJECTS)
    _load(spark, kept, [_line(1, 5)])
    pos_files.store.overwrite_partitions(pos_files.current(spark, kept).fact.withColumn(pos_files.LOAD, F.lit(2)), f"{kept.root}/fact", [pos_files.LOAD])
    assert pos_files.current(spark, kept).fact.count() == 1
    # the load that takes its number starts from an empty partition
    assert _seen(_load(spark, kept, [_line(7, 1, "6")])) == ([], [(7, pos.NO_STATION)], {1: 4, 2: 1})

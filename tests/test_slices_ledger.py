import pytest
from pyspark.sql import functions as F

from millrace.operators import ledger as ledgers
from millrace.operators import slices
from millrace.operators.enrich import backfill, fill_once, first_after, propagate_flag, resolve_attribute
from millrace.operators.merge import s
from tests.conftest import rows_of


def test_slice_replace_keeps_null_slices(frame):
    target = frame("d int, v string", (1, "a"), (2, "b"), (None, "n"))
    got = slices.replace_slice(target, frame("d int, v string", (2, "B"), (3, "C"), (2, "B2")), ["d"])
    assert rows_of(got) == [(None, "n"), (1, "a"), (2, "B"), (2, "B2"), (3, "C")]
    assert rows_of(slices.replace_slice(target, target.filter("d > 9"), ["d"])) == rows_of(target)


@pytest.fixture
def ledger(frame):
    # f was sent twice and loaded once, g once, h is reserved twice
    return frame("FileKey int, FileName string, CategoryName string, SubCategoryName string, LoadDateKey int, LoadTimeKey int, LoadStatus short",
                 (1, "f", "FIRSTPRO", "TRN", 1, 1, 1), (5, "f", "FIRSTPRO", "TRN", 1, 1, None), (2, "g", "FIRSTPRO", "TRN", 1, 1, 2),
                 (3, "h", "FLOWCO", "PAYMENT", 1, 1, None), (4, "h", "FLOWCO", "PAYMENT", 1, 1, None), (6, "i", "FIRSTPRO", "TRN", 1, 1, -99))


def status(df):
    return dict(rows_of(df, "FileKey", "LoadStatus"))


def test_reload_removal_both_ways(frame, ledger):
    fact, rejects = frame("id int, FileKey int", (10, 1), (11, 5), (12, 2), (13, None)), frame("id int, FileKey int", (20, 1), (21, 3))
    names = frame("FileName string", "f", "new")
    after = slices.remove_reloaded(fact, rejects, ledger, names, before_load=False)
    assert (rows_of(after.fact, "id"), rows_of(after.rejects, "id"), rows_of(after.keys)) == ([(11,), (12,), (13,)], [(21,)], [(1,)])
    before = slices.remove_reloaded(fact, rejects, ledger, names)
    assert (rows_of(before.fact, "id"), rows_of(before.rejects, "id"), rows_of(before.keys)) == ([(12,), (13,)], [(21,)], [(1,), (5,)])
    none = slices.remove_reloaded(fact, rejects, ledger, frame("FileName string", "new"))
    assert rows_of(none.fact) == rows_of(fact)


def test_month_to_date(frame):
    ledger = frame("FileKey int, CategoryName string, SubCategoryName string, LoadStatus short", (1, "S", "D", 1), (2, "S", "D", 1), (3, "S", "D", 1), (9, "X", "D", 1))
    fact = frame("FileKey int, DateKey int", (1, 20240131), (2, 20240201), (2, 20240202), (3, 20240201), (3, 20240203), (9, 20240201))
    marked, kept, rejects = slices.supersede_month_to_date(fact, fact, ledger, 3, "S", "D")
    assert status(marked) == {1: 1, 2: 6, 3: 1, 9: 6}
    # Key 9 belongs to another feed: it is marked, as it shares a day, but only this feed's rows are removed.
    assert rows_of(kept, "FileKey") == [(1,), (3,), (3,), (9,)] == rows_of(rejects, "FileKey")
    alone = slices.supersede_month_to_date(fact, fact, ledger, 1, "S", "D")
    assert status(alone[0]) == {1: 1, 2: 1, 3: 1, 9: 1} and alone[1].count() == 6


def test_rows_without_a_day_are_cold(frame):
    df = frame("d int", 20240615, 20240616, None)
    hot, cold = slices.split_hot_cold(df, "d", "2024-06-15 20:00:00", 7)
    assert (rows_of(hot), rows_of(cold)) == ([(20240616,)], [(None,), (20240615,)])
    assert rows_of(slices.split_hot_cold(df, "d", "2024-06-15 20:00:00", 7, legacy=True)[1]) == [(20240615,)]
    yes, no = slices.split_by(df, F.col("d") > 20240615)
    assert (yes.count(), no.count()) == (1, 1)


def test_replay_input_conforms_to_staging(frame, ledger):
    rejects = frame("id int, FileKey int, Error string, StationKey int", (1, 2, "Mismatch", None))
    staging = frame("FileKey int, FileName string, id long", (5, "f", 7))
    assert rows_of(slices.replay_input(rejects, ledger, staging)) == [(2, "g", 1), (5, "f", 7)]


def test_purge(frame):
    assert rows_of(slices.purge_loaded(frame("x int", 1, 2, None), frame("y int", 2, 2), "x", "y")) == [(None,), (1,)]


def test_file_names(frame):
    files = frame("FileName string", "20240203#990000001FREEFLOWCO.CSV", "20240203#99AR_TRANSACTIONS.CSV", "20240203#99CPU.CSV", "20240203#99PMTFLOWCO.CSV")
    assert rows_of(ledgers.parse_file_name(files), "CategoryName", "SubCategoryName") == [
        ("FIRSTPRO", "AR TRANSACTIONS"), ("FLOWCO", "FREE"), ("FLOWCO", "PAYMENT")]


def test_reserve_is_dense_and_typed(frame, ledger):
    files = frame("FileName string, CategoryName string, SubCategoryName string", ("b", "FIRSTPRO", "TRN"), ("a", "FIRSTPRO", "TRN"), ("a", "FIRSTPRO", "TRN"))
    got = ledgers.reserve(ledger, files, "2024-06-15 00:05:07")
    assert got.schema == ledger.schema
    assert rows_of(got, "FileKey", "FileName", "LoadDateKey", "LoadTimeKey", "LoadStatus") == [(7, "a", 20240615, 507, None), (8, "b", 20240615, 507, None)]
    assert rows_of(ledgers.reserve(ledger.filter("FileKey < 0"), files, "2024-06-15"), "FileKey") == [(1,), (2,)]


def test_newest_reserved_key(frame, ledger):
    rows = frame("FileName string, v int", ("f", 1), ("g", 2), ("h", 3))
    assert rows_of(ledgers.attach_key(rows, ledger), "v", "FileKey") == [(1, 5), (2, None), (3, 4)]
    assert rows_of(ledgers.attach_key(rows, ledger, "TRN"), "v", "FileKey") == [(1, 5), (2, None), (3, None)]


def test_status_changes(frame, ledger):
    keys = frame("FileKey int", 1, 2, 3, 6, 99)
    assert status(ledgers.mark_superseded(ledger, keys)) == {1: 4, 2: 2, 3: 4, 4: None, 5: None, 6: 4}
    assert status(ledgers.set_status(ledger, keys, 3)) == {1: 3, 2: 3, 3: 3, 4: None, 5: None, 6: 3}
    assert status(ledgers.edit_one(ledger, 2, {"LoadStatus": 9})) == {1: 1, 2: 9, 3: None, 4: None, 5: None, 6: -99}
    for bad in (77, None):
        with pytest.raises(ValueError, match="exactly one"):
            ledgers.edit_one(ledger if bad else ledger.unionByName(ledger), bad or 2, {"LoadStatus": 9})


def test_all_feeds_in_one_update(frame, ledger):
    key = lambda *k: frame("FileKey int", *k)
    got = ledgers.apply_outcomes(ledger, [ledgers.FeedOutcome(superseded=key(1, 2), loaded=key(5)), ledgers.FeedOutcome(loaded=key(4), failed=key(3, 4))])
    assert status(got) == {1: 4, 2: 2, 3: 3, 4: 3, 5: 1, 6: -99}
    assert ledgers.apply_outcomes(ledger, []) is ledger


def test_replayed_and_seen(frame, ledger):
    staged = frame("FileKey int", 2, 3, 3)
    assert status(ledgers.mark_replayed(ledger, staged, frame("FileKey int", 3, None)))[2] == 1
    assert status(ledgers.mark_replayed(ledger, staged, frame("FileKey int", 3, None)))[3] is None
    assert rows_of(ledgers.seen_before(frame("FileName string", "f", "z"), ledger, "FIRSTPRO", "TRN")) == [("f",)]


def test_fill_once(frame):
    target = frame("c string, x int, y int", ("a", None, None), ("b", 1, 1))
    source = frame("c string, v int", ("a", 7), ("b", 8), ("n", 9))
    assert rows_of(fill_once(target, source, ["c"], "x", {"x": s("v"), "y": s("v")})) == [("a", 7, 7), ("b", 1, 1), ("n", 9, 9)]
    assert rows_of(fill_once(target, source, ["c"], "x", {"x": s("v")}, insert=False)) == [("a", 7, None), ("b", 1, 1)]


def test_first_after_is_strict_and_breaks_ties(frame):
    starts = frame("k string, b int", ("a", 5), ("b", 5), ("c", None), ("d", 1))
    events = frame("k string, m int, id int", ("a", 5, 1), ("a", 9, 3), ("a", 9, 2), ("a", 7, 4), ("b", 4, 5), ("c", 9, 6), ("z", 9, 7))
    assert rows_of(first_after(starts, events, "k", "b", "m", ["m", "id"], ["id"])) == [("a", 4)]
    assert rows_of(first_after(starts, events.filter("id <> 4"), "k", "b", "m", ["m", "id"], ["id"])) == [("a", 2)]


def test_first_after_against_brute_force(spark):
    events = spark.range(2000).select((F.col("id") % 3).cast("string").alias("k"), F.pmod(F.hash("id"), F.lit(500)).alias("m"), "id")
    starts = spark.range(3).select(F.col("id").cast("string").alias("k"), (F.col("id") * 100).alias("b"))
    want = {}
    begins = {r.k: r.b for r in starts.collect()}
    for r in events.collect():
        if r.m > begins[r.k] and (r.k not in want or (r.m, r.id) < want[r.k]):
            want[r.k] = (r.m, r.id)
    got = first_after(starts, events, "k", "b", "m", ["m", "id"], ["id"])
    assert dict(rows_of(got)) == {k: v[1] for k, v in want.items()}


def test_resolve_attribute(frame):
    rows = frame("m string, a string, st string", ("none", None, "x"), ("none ", None, "x"), ("one", "A", "x"), ("one", None, "x"), ("two", "A", "x"), ("two", "B", "x"),
                 ("other", "Z", "x"), ("hidden", "Q", "new"), ("hidden", None, "x"), ("gone", "G", "new"))
    proposals = frame("m string, o int, a string", ("none", 2, "late"), (" none", 1, "first"), ("one", 1, "p"), ("two", 1, "p"), ("hidden", 1, "p"), ("gone", 1, "p"))
    got = resolve_attribute(rows, proposals, "m", "a", ["o"], F.col("st") != "new")
    assert rows_of(got, "m", "a") == [("gone", "G"), ("hidden", "p"), ("hidden", "p"), ("none", "first"), ("none ", "first"), ("one", "A"), ("one", "A"),
                                      ("other", "Z"), ("two", "ERR"), ("two", "ERR")]


def test_flag_and_backfill(frame):
    cards = frame("m string, f string", ("a", None), ("a ", "old"), ("b", "old"), (None, None))
    assert rows_of(propagate_flag(cards, frame("m string", "a", "a", None), "m", "f")) == [(None, None), ("a", "Y"), ("a ", "Y"), ("b", "old")]
    rows = frame("c string, m string, d int", ("a", None, 1), ("a", None, 2), ("b", "keep", 1), ("z", None, 1))
    got = backfill(rows, frame("card string, member string", ("a", "M"), ("b", "N")), {"c": "card"}, "m", "member", F.col("m").isNull() & (F.col("d") == 1))
    assert rows_of(got) == [("a", None, 2), ("a", "M", 1), ("b", "keep", 1), ("z", None, 1)]

import pytest
from pyspark.sql import functions as F

from millrace.operators.lookup import Lookup, assert_unique, enrich, flag_present, lookup, lookup_any, mapping_table
from millrace.operators.totals import join_back, net_refunds, staged_total, value_counts
from tests.conftest import rows_of


@pytest.fixture
def sales(frame):
    return frame("id int, code string, title string, station int",
                 (1, "A", "t", 10), (2, "A", "?", 10), (3, "B", "?", 20), (4, None, "t", 10), (5, "C", None, None))


def test_match_and_reject_are_a_partition_of_the_input(frame, sales):
    split = lookup(sales, frame("k string, v int", ("A", 100)), {"code": "k"}, ["v"], "no code")
    assert rows_of(split.matched, "id", "v") == [(1, 100), (2, 100)]
    assert rows_of(split.rejected, "id", "v", "Error") == [(3, None, "no code"), (4, None, "no code"), (5, None, "no code")]
    assert split.counts(sales).first().asDict() == {"input": 5, "matched": 2, "rejected": 3, "complete": True}


def test_repeated_lookup_key_multiplies_and_is_reported(frame, sales):
    table = frame("k string, v int", ("A", 1), ("A", 2))
    split = lookup(sales, table, {"code": "k"}, ["v"], "no")
    assert split.counts(sales).first().complete is False
    with pytest.raises(ValueError, match="repeated key"):
        lookup(sales, table, {"code": "k"}, ["v"], "no", unique=True)
    assert_unique(table, ["k", "v"])


def test_cascade_uses_the_fallback_only_for_the_unresolved(frame, sales):
    titled = frame("k string, t string, v int", ("A", "t", 1))
    # The fallback holds a resolved row's key twice: that row must not be multiplied by it.
    placed = frame("k string, s int, v int", ("A", 10, 7), ("A", 10, 8), ("B", 20, 9))
    split = lookup_any(sales, [Lookup(titled, {"code": "k", "title": "t"}, ["v"]), Lookup(placed, {"code": "k", "station": "s"}, ["v"])], "no")
    assert rows_of(split.matched, "id", "v") == [(1, 1), (2, 7), (2, 8), (3, 9)]
    assert rows_of(split.rejected, "id") == [(4,), (5,)]


def test_chain_keeps_the_first_reason(frame, sales):
    first = lookup(sales, frame("k string, v int", ("A", 1)), {"code": "k"}, ["v"], "first")
    second = lookup(first.frame, frame("s int, w int", (20, 5)), {"station": "s"}, ["w"], "second")
    assert rows_of(second.rejected, "id", "Error") == [(1, "second"), (2, "second"), (3, "first"), (4, "first"), (5, "first")]
    assert rows_of(second.rejected.filter("id = 3"), "w") == [(None,)]


def test_conditional_lookup(frame, sales):
    split = lookup_any(sales, [Lookup(frame("k string, v int", ("A", 1)), {"code": "k"}, ["v"], when=F.col("title") == "t")], "no")
    assert rows_of(split.matched, "id") == [(1,)]


def test_looked_up_column_replaces_one_of_the_same_name(frame):
    rows = frame("k string, StationKey int", ("A", None), ("Z", 5))
    split = lookup(rows, frame("code string, StationKey int", ("A", 1)), {"k": "code"}, ["StationKey"], "no")
    assert rows_of(split.frame, "k", "StationKey", "Error") == [("A", 1, None), ("Z", None, "no")]


def test_mapping_table_trims_then_deduplicates(frame):
    table = mapping_table(frame("f string, k string", ("x", "a "), ("x", " a"), ("y", "b")), F.col("f") == "x", ["k"])
    assert rows_of(table) == [("a",)]


def test_enrich_and_flag(frame, sales):
    side = frame("k string, name string", ("A", "aa"), ("A", "ab"))
    assert rows_of(enrich(sales, side, {"code": "k"}, {"name": "label"}).filter("id = 1"), "label") == [("aa",), ("ab",)]
    flagged = flag_present(sales, side, {"code": "k"}, "present")
    assert rows_of(flagged, "id", "present") == [(1, 1), (2, 1), (3, 0), (4, 0), (5, 0)]


def test_netting(frame):
    rows = frame("t int, v int, a int", (1, 5, 50), (2, 5, 50), (2, -2, -20), (3, -1, -10), (4, 1, 1), (4, 2, 2), (None, 3, 3), (None, -1, -1), (5, None, 9))
    rows = rows.selectExpr("t", "cast(v as decimal(15,3)) as v", "cast(a as decimal(18,2)) as a")
    net = net_refunds(rows, ["t"], "v", "a")
    assert [(r[0], float(r[1]), float(r[2])) for r in rows_of(net)] == [(None, 2, 2), (1, 5, 50), (2, 3, 30), (4, 3, 3), (4, 3, 3)]
    assert net.schema["v"].dataType.simpleString() == "decimal(15,3)"


def test_netting_of_text_and_of_some_rows(frame):
    rows = frame("t int, sys string, v string, a string", (1, "a", "5", "50"), (1, "a", "-1", "-10"), (1, "b", "-3", "1"), (2, "a", "x", "1"))
    net = net_refunds(rows, ["t", "sys"], "v", "a", where=F.col("sys") == "a", amount_type="decimal(18,2)")
    assert [(r[0], r[1], float(r[2]), float(r[3])) for r in rows_of(net)] == [(1, "a", 4, 40), (1, "b", -3, 1)]


def test_join_back_keeps_every_row(frame):
    rows = frame("k int, v int", (1, 1), (1, 2), (None, 5))
    assert rows_of(join_back(rows, ["k"], {"s": F.sum("v")})) == [(None, 5, 5), (1, 1, 3), (1, 2, 3)]


def test_staged_total_needs_nested_keys(frame):
    rows = frame("s int, d int, t int, a int", (1, 1, 5, 10), (1, 1, 5, 1), (1, 1, 7, 2))
    assert rows_of(staged_total(rows, ["s", "d", "t"], ["s", "d"], "a", "t", "sum", "last")) == [(1, 1, 13, 7)]
    with pytest.raises(ValueError):
        staged_total(rows, ["s", "t"], ["s", "d"], "a", "t", "sum", "last")


def test_value_counts_ignores_null(frame):
    assert rows_of(value_counts(frame("v string", "a", "a", (None,)), "v")) == [("a", 2)]

import random

import pytest

from millrace.operators.merge import insert_only, merge, refresh_keep_keys, s, scd1_current, scd2_status, unseen, upsert_changed, upsert_full, versioned_merge
from millrace.plans.sales import merge_members
from tests.conftest import rows_of


@pytest.fixture
def target(frame):
    return frame("k int, a string, b int, own string", (1, "x", 1, "o"), (2, "x", 1, "o"), (3, None, 1, "o"), (4, "x", 1, "o"), (5, None, 1, "o"), (None, "n", 1, "o"), (8, "x", 1, "o"))


@pytest.fixture
def source(frame):
    # 1 same, 2 changed, 3 NULL to value, 4 value to NULL, 5 NULL against NULL, 6 new, NULL key new, 8 not in source
    return frame("k int, a string, b int", (1, "x", 1), (2, "y", 1), (3, "v", 1), (4, None, 1), (5, None, 1), (6, "z", 2), (None, "m", 9))


def test_full_upsert(target, source):
    got = rows_of(upsert_full(target, source, ["k"]))
    assert got == [(None, "m", 9, None, "INSERT"), (None, "n", 1, "o", "NOT MATCHED"), (1, "x", 1, None, "UPDATED"), (2, "y", 1, None, "UPDATED"),
                   (3, "v", 1, None, "UPDATED"), (4, None, 1, None, "UPDATED"), (5, None, 1, None, "UPDATED"), (6, "z", 2, None, "INSERT"), (8, "x", 1, "o", "NOT MATCHED")]


def test_full_upsert_is_idempotent(target, source):
    keyed = source.filter("k is not null")
    once = upsert_full(target, keyed, ["k"], action=None)
    assert rows_of(upsert_full(once, keyed, ["k"], action=None)) == rows_of(once)


def test_changed_upsert_is_null_safe(target, source):
    got = {r.k: (r.a, r.own, r.action) for r in upsert_changed(target, source.filter("k is not null"), ["k"], ["a", "b"]).collect()}
    assert got == {1: ("x", "o", "SAME"), 2: ("y", "o", "UPDATED"), 3: ("v", "o", "UPDATED"), 4: (None, "o", "UPDATED"), 5: (None, "o", "SAME"),
                   6: ("z", None, "INSERT"), 8: ("x", "o", "NOT MATCHED"), None: ("n", "o", "NOT MATCHED")}


def test_changed_upsert_can_count_two_nulls_as_change(target, source):
    got = upsert_changed(target, source, ["k"], ["a"], null_is_change=True)
    assert rows_of(got.filter("k = 5"), "action") == [("UPDATED",)]


def test_repeated_source_key_is_refused(target, source):
    twice = source.unionByName(source)
    for merged in (upsert_full(target, twice, ["k"]), upsert_changed(target, twice, ["k"], ["a"]),
                   upsert_full(target.filter("k < 0"), twice, ["k"]), merge(target, twice, ["k"], {"b": s("b")}, None)):
        with pytest.raises(Exception, match="repeated key"):
            merged.collect()
    assert upsert_full(target, twice, ["k"], unique=False).count() > upsert_full(target, source, ["k"]).count()


def test_rows_without_a_key_may_repeat(target, source):
    nulls = source.filter("k is null")
    got = upsert_full(target, source.unionByName(nulls).unionByName(nulls), ["k"])
    assert got.filter("k is null and action = 'INSERT'").count() == 3 * nulls.count()


def test_unseen_with_an_empty_target(target, source):
    assert unseen(source, target.filter("k < 0"), {"k": "k"}).count() == 7


def test_refresh_drops_target_only_rows(frame):
    target = frame("id string, key int, v string", ("a", 1, "old"), ("gone", 2, "old"))
    got = refresh_keep_keys(target, frame("id string, v string", ("a", "new"), ("b", "new")), ["id"], "key")
    assert rows_of(got, "id", "key", "v") == [("a", 1, "new"), ("b", None, "new")]


def test_insert_only_cleans_the_target(frame):
    target = frame("k string, n string", ("01", "a"), ("01", "a"), (None, "b"))
    got = insert_only(target, frame("key string, n string", ("1", "a"), ("2", "c"), ("2", "c"), (None, "d")), {"k": "key", "n": "n"}, ("k", 2))
    assert rows_of(got) == [(None, "d"), ("01", "a"), ("02", "c")]


CARD = "num string, status string, a string, sk int, StartDateKey int, StartTimeKey int, EndDateKey int, EndTimeKey int, extra string"


@pytest.fixture
def cards(frame):
    return frame(CARD, ("1", "N", "x", 1, 2020, 0, None, None, "e"), ("2", "N", "x", 2, 2020, 0, None, None, "e"), ("3", None, "x", 3, 2020, 0, None, None, "e"),
                 ("4", "N", "x", 4, 2020, 0, None, None, "e"), ("2", "O", "x", 5, 2010, 0, 2019, 0, "e"), ("6", "N", "x", 6, 2010, 0, 2019, 0, "e"), ("9", "N", "x", 7, 2020, 0, None, None, "e"))


@pytest.fixture
def staged(frame):
    return frame("num string, status string, a string", ("1", "N", "x"), ("2", "A", "y"), ("3", None, "x"), ("4", None, "x"), ("6", "A", "x"), ("7", "N", "q"))


NOW = "2024-06-15 20:30:05"


def test_status_history(cards, staged):
    got = scd2_status(cards, staged, ["num"], "status", NOW, 7)
    shape = rows_of(got, "num", "status", "sk", "StartDateKey", "EndDateKey", "EndTimeKey", "extra", "action")
    assert shape == [
        ("1", "N", 1, 2020, None, None, "e", "SAME"),
        ("2", "A", None, 20240616, None, None, None, "INSERT"), ("2", "N", 2, 2020, 20240616, 33005, "e", "UPDATED"), ("2", "O", 5, 2010, 2019, 0, "e", "NOT MATCHED"),
        ("3", None, None, 20240616, None, None, None, "INSERT"), ("3", None, 3, 2020, 20240616, 33005, "e", "UPDATED"),   # NULL on both sides counts as changed
        ("4", None, None, 20240616, None, None, None, "INSERT"), ("4", "N", 4, 2020, 20240616, 33005, "e", "UPDATED"),
        ("6", "N", 6, 2010, 2019, 0, "e", "NOT MATCHED"), ("9", "N", 7, 2020, None, None, "e", "NOT MATCHED")]
    assert got.filter("EndDateKey is null").groupBy("num").count().filter("count > 1").count() == 0


def test_attribute_overwrite(cards, staged):
    keep = ["sk", "StartDateKey", "StartTimeKey", "EndDateKey", "EndTimeKey"]
    got = scd1_current(cards, staged, ["num"], ["a"], keep, NOW, 7)
    assert rows_of(got, "num", "a", "sk", "status", "extra", "StartDateKey", "action") == [
        ("1", "x", 1, "N", "e", 2020, "NOT MATCHED"), ("2", "x", 5, "O", "e", 2010, "NOT MATCHED"), ("2", "y", 2, "A", None, 2020, "UPDATED"),
        ("3", "x", 3, None, "e", 2020, "NOT MATCHED"), ("4", "x", 4, "N", "e", 2020, "NOT MATCHED"), ("6", "x", 6, "N", "e", 2010, "NOT MATCHED"),
        ("7", "q", None, "N", None, 20240616, "INSERT"), ("9", "x", 7, "N", "e", 2020, "NOT MATCHED")]


def test_attribute_overwrite_fills_absent_text(frame, cards):
    source = frame("num string, status string, a string", ("1", None, None))
    got = scd1_current(cards, source, ["num"], ["a"], ["sk"], NOW, defaults={"a": "NA"})
    assert rows_of(got.filter("num = '1'"), "a", "status", "sk", "StartDateKey", "extra") == [("NA", "NA", 1, None, None)]


def test_member_snapshot(frame):
    members = frame("code string, name string, site string, size int", ("1", "one", "old", 5), ("2", "two", "old", 5))
    rows = frame("party int, day int, place string", (1, 1, "p1"), (1, 2, "p2"), (3, 1, None))
    got = merge_members(members, rows, "code", "party", ["day"], {"site": "place"}, {"name": "NA", "site": "NA", "size": 99})
    assert rows_of(got) == [("1", "one", "p2", 5, "UPDATE"), ("2", "two", "old", 5, "SAME"), ("3", "NA", "NA", 99, "INSERT")]


def test_merge_expression_over_both_sides(target, source):
    from millrace.operators.merge import merge, t
    got = merge(target, source, ["k"], {"b": t("b") + s("b")}, None)
    assert rows_of(got.filter("k = 2"), "b", "a") == [(2, "x")]


@pytest.mark.parametrize("null_is_change", [False, True])
def test_versioned_merge_equals_both_merges(spark, null_is_change):
    """One join gives what closing and opening, then overwriting give one after the other."""
    rng = random.Random(11)
    target_kind = "k string, st string, a string, b int, own string, LoadDay int, StartDateKey int, StartTimeKey int, EndDateKey int, EndTimeKey int, id int"
    pick = lambda *x: rng.choice([*x, None])
    rows = []
    for i in range(60):
        for j in range(rng.randint(0, 3)):
            closed = j > 0 or rng.random() < 0.2
            rows.append((f"k{i}", pick("A", "B"), pick("x", "NA"), pick(1, 2), pick("o"), 1, 20230101 if rng.random() < 0.9 else None, 0, 20230202 if closed else None, 0 if closed else None, len(rows)))
    rows.append((None, "A", "x", 1, "o", 1, 20230101, 0, None, None, -1))
    source = spark.createDataFrame([(f"k{i}", pick("A", "B"), pick("x", "y"), pick(1, 2)) for i in range(20, 80)] + [(None, "A", "q", 5)], "k string, st string, a string, b int")
    target = spark.createDataFrame(rows, target_kind)
    keep = ["StartDateKey", "StartTimeKey", "EndDateKey", "EndTimeKey", "id"]
    more = {"defaults": {"a": "NA"}, "load": ("LoadDay", "LoadClock"), "null_is_change": null_is_change}
    first = scd2_status(target, source, ["k"], "st", "2024-06-15 08:30:05", 7, action=None)
    want = scd1_current(first, source, ["k"], ["a", "b"], keep, "2024-06-15 08:30:05", 7, action=None, **more)
    got = versioned_merge(target, source, ["k"], "st", ["a", "b"], keep, "2024-06-15 08:30:05", 7, **more)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftOuter") == 1

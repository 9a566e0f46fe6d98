from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import columns as c
from millrace.functions import conform
from tests.conftest import rows_of


def one(frame, schema, value, *exprs):
    return tuple(frame(schema, value).select(*exprs).first())


def test_time_keys_drop_leading_zeros(frame):
    ts = F.col("t").cast("timestamp_ntz")
    assert one(frame, "t string", ("2024-02-29 00:05:07",), c.date_key(ts), c.time_key(ts), c.month_key(ts)) == (20240229, 507, 202402)


def test_shift_crosses_midnight_and_year(frame):
    ts = F.col("t").cast("timestamp_ntz")
    assert one(frame, "t string", ("2023-12-31 18:00:00",), c.date_key(c.shift(ts, 7)), c.time_key(c.shift(ts, 7))) == (20240101, 10000)


def test_malformed_text_time_is_null(frame):
    got = one(frame, "t string", ("31/02/2024 00:00:00",), c.date_key(c.parse_time("t", "dd/MM/yyyy HH:mm:ss", 7)))
    assert got == (None,)


def test_stamp_uses_the_given_clock(frame):
    assert one(frame, "x int", (1,), *c.stamp("2024-06-15 20:30:05", 7)) == (20240616, 33005)


@pytest.mark.parametrize("text, want", [("9:30", "93000"), ("12:05", "120500"), (None, None)])
def test_clock_to_key(frame, text, want):
    assert one(frame, "t string", (text,), c.clock_to_key("t")) == (want,)


@pytest.mark.parametrize("text, want", [(None, "999999"), ("", "999999"), ("1", "999999"), ("12", "12")])
def test_text_or_default(frame, text, want):
    assert one(frame, "t string", (text,), c.text_or("t", "999999")) == (want,)


@pytest.mark.parametrize("value, exact, whole", [("0", True, True), ("0.5", False, True), ("-0.9", False, True), ("1", False, False), ("x", False, False), (None, False, False)])
def test_zero_tests(frame, value, exact, whole):
    assert one(frame, "v string", (value,), c.is_zero("v"), c.is_whole_zero("v")) == (exact, whole)


def test_key_parts_and_text(frame):
    assert one(frame, "d int, t int", (20240307, 507), c.year_of_key("d"), c.month_of_key("d"), c.key_text("d", "t")) == (2024, 3, "20240307000507")


def test_recode_keeps_unlisted(frame):
    df = frame("v string", "PMT", "TRN", (None,))
    assert rows_of(df.select(c.recode("v", {"PMT": "PAYMENT"}).alias("v"))) == [(None,), ("PAYMENT",), ("TRN",)]


def test_classification_by_code_or_prefix(frame):
    df = frame("code string, name string", ("7", "x"), ("1", "  ABCD shop"), ("1", "ABC"), (None, None))
    label = c.class_by_code_or_prefix("code", "7", "name", "ABCD", "in", "out")
    assert [r[0] for r in df.select(label).collect()] == ["in", "in", "out", "out"]


def test_file_name_is_decoded(frame):
    assert one(frame, "p string", ("file:/a/b/20240203%2399TRN.CSV",), c.decode_file_name("p")) == ("20240203#99TRN.CSV",)


def test_thai_bytes(frame):
    latin = "สวัสดี 1".encode("iso8859_11").decode("latin-1")
    assert one(frame, "t string", (latin,), c.thai_text("t")) == ("สวัสดี 1",)


SCHEMA = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("a", T.DecimalType(5, 2)), T.StructField("d", T.DateType())])


def test_conform_orders_casts_and_nulls_bad_values(frame):
    df = frame("a string, extra int, b string, d string", ("1.234", 1, "7", "2024-01-01"), ("12345", 1, "x", "2024-13-01"), (" ", 1, "99999999999", None))
    got = conform.conform_table(df, SCHEMA)
    assert got.schema == SCHEMA
    import datetime
    assert rows_of(got) == [(None, None, None), (None, None, None), (7, Decimal("1.23"), datetime.date(2024, 1, 1))]


def test_conform_missing_column(frame):
    df = frame("b int", 1)
    with pytest.raises(ValueError, match="missing"):
        conform.conform_table(df, SCHEMA)
    assert rows_of(conform.conform_table(df, SCHEMA, allow_missing=True)) == [(1, None, None)]


def test_conform_types_keeps_other_columns_and_order(frame):
    got = conform.conform_types(frame("z string, b string", ("q", "3")), SCHEMA)
    assert got.schema.simpleString() == "struct<z:string,b:int>"


def test_fill_by_type_and_refusal(frame):
    df = frame("s string, i int, l bigint, h smallint, f double, m decimal(9,2), d date, t timestamp, n timestamp_ntz", (None,) * 9)
    row = conform.fill_by_type(df).first()
    assert (row.s, row.i, row.l, row.h, row.f, row.m, str(row.d)) == ("", 0, 0, 0, 0.0, Decimal("0.00"), "1970-01-01")
    with pytest.raises(TypeError, match="boolean"):
        conform.fill_by_type(frame("x boolean", (None,)))
    assert rows_of(conform.fill_by_type(frame("x boolean, s string", (None, None)), strict=False)) == [(None, "")]


def test_trim_touches_text_only(frame):
    assert rows_of(conform.trim_text(frame("s string, i int", ("  a ", 1), (None, 2)))) == [(None, 2), ("a", 1)]


def test_union_by_name_skips_none_and_fills_missing(frame):
    got = conform.union_by_name([None, frame("a int", 1), None, frame("b string, a int", ("x", 2))])
    assert rows_of(got, "a", "b") == [(1, None), (2, "x")]
    assert conform.union_by_name([None]) is None


def test_constant_row(frame):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("x", T.StringType())])
    got = conform.constant_row(frame("key int, v string", (1, None), (2, "v")), {"x": "NA", "n": 99}, {"k": F.col("key"), "x": F.col("v")}, schema)
    assert rows_of(got) == [("1", 99, "NA"), ("2", 99, "v")]


def test_distinct_keys(frame):
    got = conform.distinct_keys([frame("k int, x int", (1, 1), (1, 2)), frame("k int", 2, 1)], ["k"])
    assert rows_of(got) == [(1,), (2,)]

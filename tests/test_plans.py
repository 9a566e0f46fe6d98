"""Edge cases of the domain jobs; their results on generated data are checked in test_cases."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ledger import LEDGER
from millrace.plans import cash, loyalty, pos, sales
from tests.conftest import rows_of

NOW = "2024-06-15 08:30:05"


@pytest.fixture
def stations(frame):
    return frame("StationKey int, CustomerCode string, POSCode string, PosName string, SOR string", (1, "C1", "77", "Site A", "s"), (2, "C2", "78", "Site B", "s"))


@pytest.fixture
def mapping(frame):
    return frame("SourceName string, SourceFile string, SourceKey string, SourceTitle string, StationKey int, MappingKey int",
                 ("FIRSTPRO", "TRANSACTION", "1", "G1 ", None, 100), ("FLOWCO", "TRANSACTION", "1", "G1", None, 200), ("FIRSTPRO", "TRANSACTION", "2", None, 1, 300),
                 ("FIRSTPRO", "TRANSACTION", "3", "LUBE", None, 400), ("FIRSTPRO", "METERS", "5", None, 1, 500), ("FIRSTPRO", "METERS", "6", "t", 1, 600),
                 ("FLOWCO", "METERS", "6", "t", 1, 700), ("FLOWCO", "TANKS", "2", None, 1, 800), ("FIRSTPRO", "TANKS", "2", None, 1, 900), ("FIRSTPRO", "AR", "0", "", None, 950))


FUEL = "StationName string, CustomerCode string, POSCode string, CloseDateKey int, TransNumber int, TransDateKey int, TransTime string, Grade string, GradeTitle string, Volume string, Amount string, FileKey int, FileName string"


def fuel(frame, *rows):
    base = ("Si te A", "C1", "77", 20240101, 1, 20240101, "08:30", "1", "G1", "5", "50", 9, "x.CSV")
    names = [part.split()[0] for part in FUEL.split(", ")]
    return frame(FUEL, *[tuple((dict(zip(names, base)) | row)[n] for n in names) for row in rows])


def test_fuel(frame, stations, mapping):
    staged = fuel(frame, {}, {"TransNumber": 2, "Volume": "-1", "Amount": "-10"}, {"TransNumber": 2}, {"TransNumber": 3, "Grade": "3", "GradeTitle": "", "Volume": "0.0", "Amount": "0"},
                  {"TransNumber": 4, "Grade": "2", "GradeTitle": "?"}, {"TransNumber": 5, "FileName": "FLOWCO.CSV", "Volume": "-7"}, {"TransNumber": 6, "StationName": "no"},
                  {"TransNumber": 7, "Grade": "9"}, {"TransNumber": 8, "Grade": "2", "FileName": "FLOWCO.CSV"}, {"TransNumber": 9, "Volume": "abc"})
    split = pos.load_feed(staged, "TRN", stations, mapping)
    assert rows_of(split.matched, "TransNumber", "ProductKey", "StationKey", "Volume", "Amount", "TransTimeKey", "YearKey") == [
        (1, 100, 1, Decimal("5.000"), Decimal("50.00"), "083000", 2024), (2, 100, 1, Decimal("4.000"), Decimal("40.00"), "083000", 2024),
        (3, 400, 1, Decimal("0.000"), Decimal("0.00"), "083000", 2024), (4, 300, 1, Decimal("5.000"), Decimal("50.00"), "083000", 2024),
        (5, 200, 1, Decimal("-7.000"), Decimal("50.00"), "083000", 2024)]
    assert rows_of(split.rejected, "TransNumber", "StationKey", "Error") == [(6, None, pos.NO_STATION), (7, 1, pos.NO_PRODUCT), (8, 1, pos.NO_PRODUCT), (9, 1, pos.NO_VOLUME)]
    staged_once = pos.load_feed(staged, "TRN", stations, mapping, stage=True)
    assert rows_of(staged_once.frame, "TransNumber", "Volume", "Error") == rows_of(split.frame, "TransNumber", "Volume", "Error")


def test_meter_fallbacks_differ_by_system(frame, stations, mapping):
    rows = fuel(frame, {"Grade": "5", "TransNumber": 1}, {"Grade": "6", "TransNumber": 2}, {"Grade": "6", "TransNumber": 3, "FileName": "FLOWCO"}).withColumnRenamed("Grade", "GradeNumber").withColumn("GradeTitle", F.lit("?"))
    split = pos.load_feed(rows, "EOD_METERS", stations, mapping)
    assert rows_of(split.frame, "TransNumber", "ProductKey", "Error") == [(1, 500, None), (2, None, pos.NO_PRODUCT), (3, 700, None)]


def test_tank_noise_and_nameless_stations(frame, stations, mapping):
    readings = {n: F.lit(0) for n in ("OpenVolume", "CloseVolume", "DeliveryVolume")}
    rows = fuel(frame, {"Grade": "2", "TransNumber": 1}, {"Grade": "2", "TransNumber": 2, "FileName": "FLOWCO", "StationName": "??"}, {"Grade": "7", "TransNumber": 3},
                {"Grade": "2", "TransNumber": 4, "StationName": "??"}, {"Grade": None, "TransNumber": 5}).withColumnRenamed("Grade", "GradeNumber").withColumns(readings)
    split = pos.load_feed(rows, "EOD_TANKS", stations, mapping)
    assert rows_of(split.frame, "TransNumber", "StationKey", "ProductKey", "Error") == [(1, 1, 900, None), (3, 1, None, pos.NO_PRODUCT), (5, 1, None, pos.NO_PRODUCT)]
    kept = pos.load_feed(rows, "EOD_TANKS", stations, mapping, drop_noise=F.lit(False))
    assert kept.rejected.count() == 4


def test_feed_with_product_needs_the_mapping(frame, stations):
    with pytest.raises(ValueError, match="product mapping"):
        pos.load_feed(fuel(frame, {}), "TRN", stations)


def test_receivable_blank_code_and_names(frame, stations, mapping):
    rows = fuel(frame, {"Volume": "0.4", "Amount": "0"}).drop("Grade").withColumns({"GradeNumber": F.lit(None).cast("int"), "GradeTitle": F.lit("x"), "LubeCode": F.lit(""), "LBAmount": F.lit(3), "AttendantNumber": F.lit("4")})
    got = pos.load_feed(rows.withColumn("GradeTitle", F.lit("")), "AR_TRANSACTIONS", stations, mapping).frame
    assert rows_of(got, "GradeNumber", "CastLubeCode", "ReGradeTitle", "LubeAmount", "AttendeeNumber", "Error") == [("0", "0", "LUBE", 3, "4", pos.NO_PRODUCT)]


def test_whole_load_replays_and_replaces(frame, stations):
    columns = "StationName string, CustomerCode string, POSCode string, TransTime string, TransNumber int, FileKey int, FileName string"
    staged = frame(columns, ("Site A", "C1", "77", "08:30", 1, 12, "f"), ("nowhere", "C1", "77", "08:30", 2, 12, "f"))
    fact = frame("TransNumber int, StationKey int, FileKey int", (90, 1, 10), (91, 1, 11))
    rejects = frame("StationName string, CustomerCode string, POSCode string, TransTime string, TransNumber int, FileKey int, Error string",
                    ("Site B", "C2", "78", "08:30", 80, 11, "Mismatch StationKey"), ("Site A", "C1", "77", "08:30", 81, 10, "Mismatch StationKey"), ("still", "C2", "78", "08:30", 82, 11, "Mismatch StationKey"))
    ledger = frame_ledger(frame, (10, "f", 1), (11, "g", 1), (12, "f", None))
    batch = pos.run_feed(staged, "LUB", stations, None, fact, rejects, ledger)
    # File f came again: its old fact row 90 and its quarantined row 81 are gone; g's quarantined rows are tried again.
    assert rows_of(batch.fact) == [(1, 1, 12), (80, 2, 11), (91, 1, 11)]
    assert rows_of(batch.rejects, "TransNumber", "FileKey") == [(2, 12), (82, 11)]
    assert dict(rows_of(batch.ledger, "FileKey", "LoadStatus")) == {10: 4, 11: 1, 12: 1}


def frame_ledger(frame, *rows):
    spark_rows = [(k, n, "FIRSTPRO", "LUBE", 1, 1, s) for k, n, s in rows]
    return frame(LEDGER, *spark_rows)


# ---- cash ---------------------------------------------------------------------


def test_dirty_drops_become_null(frame):
    raw = frame(cash.RAW, tuple(["0", "x", "77", "", "", "20240615 083005", "p", "1", "12.345", ""]), tuple(["0", "1", None, "", "", "20240615 083005", "1", "1", "1", ""]))
    row = cash.parse_drops(raw).collect()
    assert len(row) == 1
    assert row[0].asDict() == {"CustomerCode": None, "StationCode": 77, "DropDate": 20240615, "DropTime": 83005, "DropDateTime": "20240615083005", "DropTimeText": "08:30:05",
                               "TranferDate": None, "TranferTime": None, "PacketNumber": None, "CashierCode": 1, "Amount": Decimal("12.35")}


@pytest.mark.parametrize("day, clock, want", [(20240615, "005959", ("2024-06-14", 202406)), (20240615, "010000", ("2024-06-15", 202406)), (20240601, "000000", ("2024-05-31", 202405)), (20240101, "005900", ("2023-12-31", 202312))])
def test_business_day_edges(frame, day, clock, want):
    fact = frame("StationKey int, StationCode int, DropDate int, DropDateTime string, Amount int", (1, 1, day, f"{day}{clock}", 5))
    got = cash.business_day_totals(fact).first()
    assert (str(got.DropDate), got.YearMonth_DropDate, got.Amount) == (*want, 5)


@pytest.mark.parametrize("text, whole, exact", [(" 1,234.50 ", Decimal("1234.00"), Decimal("1234.50")), ("-1,234.00", Decimal("-1234.00"), Decimal("-1234.00")), ("77", None, Decimal("77.00")), ("x.y", None, None), (".5", None, Decimal("0.50"))])
def test_statement_amounts(frame, text, whole, exact):
    assert frame("t string", text).select(cash.statement_amount(F.col("t")), cash.statement_amount(F.col("t"), True)).first()[:] == (whole, exact)


def test_statement_months_are_replaced(frame):
    fact = frame("YearMonth_DocDate string, v int", ("202401", 1), ("202402", 2))
    got = cash.replace_statement_months(fact, frame("YYYYMM_DocDate string, v int, EntryDate string", ("202402", 5, None), ("202403", 6, None)))
    assert rows_of(got) == [("202401", 1), ("202402", 5), ("202403", 6)]


def test_resent_cash_file_is_renumbered_after_the_rest(frame, stations):
    schema = T.StructType([T.StructField(n, T.IntegerType() if n != "FileName" else T.StringType()) for n in ("StationKey", "StationCode", "PacketNumber", "RowNumber", "FileName")])
    fact = frame(schema, (1, 77, 1, 8, "a"), (1, 77, 2, 9, "b"))
    raw = frame("_c0 string, _c1 string, _c2 string, _c3 string, _c4 string, _c5 string, _c6 string, _c7 string, _c8 string, _c9 string, FileName string",
                ("", "1", "77", "", "", "20240615 083005", "7", "1", "1", "20240615 083005", "b"), ("", "1", "5", "", "", "20240615 083005", "3", "1", "1", "20240615 083005", "b"))
    stations = stations.withColumn("CustomerCode", F.lit("1"))
    assert rows_of(cash.load_drops(raw, stations, fact, ["PacketNumber"]), "PacketNumber", "StationKey", "RowNumber", "FileName") == [(1, 1, 8, "a"), (3, None, 9, "b"), (7, 1, 10, "b")]
    assert rows_of(cash.load_drops(raw, stations, fact.filter("false"), ["PacketNumber"]), "RowNumber") == [(1,), (2,)]


# ---- sales --------------------------------------------------------------------


def test_sales_staging(frame):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("DivisionKey", "DistributionChannelKey", "SalesGroupSoldTo")] + [T.StructField("FileKey", T.IntegerType())])
    raw = frame("`Division - Key` string, `Sales group (Sold to)` string", ("2", "Vicinity"), ("12", "North"))
    assert rows_of(sales.stage(raw.withColumnRenamed("Sales group (Sold to)", "Sales Group Sold To"), schema, 5), "DivisionKey", "SalesGroupSoldTo", "FileKey") == [("02", "Metro", 5), ("12", "North", 5)]


def test_product_fan_out_is_kept(frame):
    staged = frame("SoldtoPartyKey int, DivisionKey string, MaterialKey string, CalendarDay date", (1, "2", "M", None), (1, "9", "M", None), (2, "2", "M", None), (1, None, "M", None), (1, "4", "?", None))
    products = frame("SourceName string, SourceFile string, SourceKey string, MappingKey int", ("S", "DailySales", "M", 5), ("S", "DailySales", "M", 6))
    split = sales.load_sales(staged, frame("CustomerCode string, StationKey int", ("1", 10)), products, "S")
    assert rows_of(split.matched, "DivisionKey", "MappingKey") == [("2", 5), ("2", 6), ("9", 0)]
    assert rows_of(split.rejected, "SoldtoPartyKey", "Error") == [(1, sales.NO_DIVISION), (1, sales.NO_PRODUCT), (2, sales.NO_STATION)]
    kept = sales.load_sales(staged, frame("CustomerCode string, StationKey int", ("1", 10)), products, "S", legacy=True)
    assert rows_of(kept.rejected, "Error") == [(sales.NO_PRODUCT,), (sales.NO_STATION,)]


def test_new_station_gets_defaults(frame):
    dim = frame("CustomerCode string, StationKey int, StationName string, OperationStartDateKey int, HighwaySignHeight int, SelfServe string, Rate decimal(7,0), XProvinceKey string", ("1", 5, "one", 1, 1, "y", None, "old"))
    names = [*dict.fromkeys(sales.station_columns("X").values()), "CalendarDay", "SoldtoPartyKey"]
    staged = frame(", ".join(f"{n} {'int' if n.endswith('PartyKey') else 'string'}" for n in names), tuple(7 if n.endswith("PartyKey") else "2024-01-01" if n == "CalendarDay" else None for n in names))
    dim = dim.select("*", *[F.lit(None).cast("string").alias(n) for n in sales.station_columns("X") if n != "XProvinceKey"])
    got = sales.update_stations(dim, staged, "X").filter("CustomerCode = '7'").first()
    assert (got.StationKey, got.StationName, got.OperationStartDateKey, got.HighwaySignHeight, got.SelfServe, got.Rate, got.XProvinceKey) == (None, "NA", 99991231, 99, None, Decimal(0), "NA")


# ---- loyalty ------------------------------------------------------------------


@pytest.mark.parametrize("raw, want", [("POINT_BEFORE_AWARD", "PointBeforeAward"), ("Channel", "Channel"), ("AMOUNT", "Amount"), ("DescriptionComment", "DescriptionComment")])
def test_camel(raw, want):
    assert loyalty.camel(raw) == want


def test_card_columns():
    assert len(loyalty.CARD_COLUMNS) == len(set(loyalty.CARD_COLUMNS)) == 46
    assert len(loyalty.CARD_TRACKED) == 37


def test_point_products_without_merchant(frame):
    cards = frame("CardNum string, CardProfileKey int, EndDateKey int", ("k", 1, None), ("k", 2, 20240101))
    products = frame("PRODUCT_ID string, MappingKey int, ProductGroup string", ("a", 38, "POINT"), ("b", 5, "POINT"), ("c", 6, "FUEL"), ("0", 7, "FUEL"))
    merchants = frame("RowId string, MerchandiseKey int", ("NA", 9), ("r", 1))
    columns = "TXN_ID string, CARD_NUM string, PRODUCT_ID string, MERCHANT_ROW_ID string"
    moments = {n: F.lit("2024-01-01 20:00:00").cast("timestamp_ntz") for n in ("CREATED", "LAST_UPD", "LoadDateTime", "PROCESS_DATE", "TRANS_DATE")}
    raw = frame(columns, ("1", "k", "a", "r"), ("2", "k", "a", None), ("3", "k", "b", "r"), ("4", "k", "c", None), ("5", "k", None, "r"), ("6", "?", "a", "r"), ("7", "k", "z", "r")).withColumns(moments)
    got = loyalty.resolve_transactions(raw, cards, products, merchants)
    assert rows_of(got.frame, "TXN_ID", "CardProfileKey", "MappingKey", "MerchandiseKey", "TransDateKey", "Error") == [
        ("1", 1, 38, 1, 20240102, None), ("2", 1, 38, 9, 20240102, None), ("3", 1, 5, 9, 20240102, None), ("4", 1, 6, None, 20240102, loyalty.NO_MERCHANT),
        ("5", 1, 7, 1, 20240102, None), ("6", None, None, None, 20240102, loyalty.NO_CARD), ("7", 1, None, None, 20240102, loyalty.NO_PRODUCT)]


def test_purchase_products_keep_sql_precedence(frame):
    products = frame("ProductKey int, ProductGroup string, used string", (1, "LUBE", "1"), (2, "LUBE", "0"), (41, "OTHER", "0"), (3, "OTHER", "1"))
    assert rows_of(loyalty.purchase_products(products, "used")) == [(1,), (41,)]


def test_terminals_null_ids(frame):
    now = "2024-01-01 20:00:00"
    columns = "TID string, MID string, TID_Status string, loadDateTime string, LoadDate string, UpdateDate string"

    def make(*rows):
        df = frame(columns, *[(*r, now, now, now) for r in rows])
        return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in ("LoadDate", "UpdateDate")})

    target = make(("a", "m", None), ("b", None, "on"), ("c", "m", "on"))
    source = make(("A", "M", None), ("B", "n", "on"), ("D", None, "on"))
    got = loyalty.update_terminals(target, source, action="action")
    assert rows_of(got, "TID", "MID", "TID_Status", F.date_format("LoadDate", "dd").alias("d"), "action") == [
        ("A", "M", None, "01", "SAME IN MATCHED"), ("B", "N", "on", "02", "UPDATE"), ("C", "M", "on", "01", "SAME IN TARGET"), ("D", None, "on", "02", "INSERT")]


def test_a_merge_of_equal_buckets_exchanges_nothing(spark):
    """A large source too: neither table is dealt out again, only counts of keys are brought together."""
    import uuid

    from millrace.sources import tables
    name, old = f"millrace_{uuid.uuid4().hex}", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = spark.range(5000).selectExpr("id as k", "id % 7 as v")
    tables.save_table(rows.filter("k % 3 <> 0"), name, bucket_by=(8, ["k"]))
    tables.save_table(rows.filter("k % 2 = 0"), f"{name}_d", bucket_by=(8, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = tables.merged_buckets(spark, name, f"{name}_d", ["k"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= 3 and "Exchange hashpartitioning" not in plan
        assert merged.count() == rows.filter("k % 3 <> 0 or k % 2 = 0").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for table in (name, f"{name}_d"):
            spark.sql(f"drop table {table}")

"""Cash pick-up: drops, transfer differences, business-day totals and ledger statements."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import columns as c
from millrace.functions.conform import conform_table
from millrace.operators import slices
from millrace.operators.keys import highest, number_rows
from millrace.operators.lookup import ERROR, Split, enrich
from millrace.operators.totals import day_with_cutoff, staged_total

RAW = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(10)])
NO_ASSIGNMENT, NO_STATION = "MismatchAssignment", "Mismatch StationKey"


def _moment(text: str) -> tuple[Column, Column]:
    """Date part and time part of ``yyyyMMdd HHmmss`` text, empty if it has another shape."""
    return (F.regexp_extract(text, r"([0-9]+) [0-9]+", 1), F.regexp_extract(text, r"[0-9]+ ([0-9]+)", 1))


def clock_text(digits: Column) -> Column:
    """``HHmmss`` to ``HH:mm:ss``."""
    return F.concat_ws(":", *[F.substring(digits, start, 2) for start in (1, 3, 5)])


def parse_drops(raw: DataFrame) -> DataFrame:
    """Typed cash drops; rows without a station code are left out."""
    drop_date, drop_time = _moment("_c5")
    transfer_date, transfer_time = _moment("_c9")
    lineage = [name for name in raw.columns if name not in RAW.names]
    return raw.filter(F.col("_c2").isNotNull()).select(
        F.col("_c1").try_cast("int").alias("CustomerCode"),
        F.col("_c2").try_cast("int").alias("StationCode"),
        drop_date.try_cast("int").alias("DropDate"),
        drop_time.try_cast("int").alias("DropTime"),
        c.without("_c5", " ").alias("DropDateTime"),
        clock_text(F.trim(F.regexp_replace("_c5", r".* ", ""))).alias("DropTimeText"),
        transfer_date.try_cast("int").alias("TranferDate"),
        transfer_time.try_cast("int").alias("TranferTime"),
        F.col("_c6").try_cast("int").alias("PacketNumber"),
        F.col("_c7").try_cast("int").alias("CashierCode"),
        F.col("_c8").try_cast("decimal(10,2)").alias("Amount"),
        *lineage,
    )


def load_drops(raw: DataFrame, stations: DataFrame, fact: DataFrame, within_file: Sequence[str] = ()) -> DataFrame:
    """Fact after replacing the incoming files' rows; new rows continue its numbering.

    Rows are numbered by file name, then ``within_file``, then all their values,
    so that the order is total.
    """
    side = stations.select(F.col("CustomerCode").try_cast("int").alias("cust"), F.col("POSCode").try_cast("int").alias("pos"),
                           "StationKey", "SOR")
    drops = enrich(parse_drops(raw), side, {"CustomerCode": "cust", "StationCode": "pos"},
                   {"StationKey": "StationKey", "SOR": "SOR"})
    kept = slices.without_keys(fact, drops, ["FileName"])
    order = dict.fromkeys(["FileName", *within_file, *drops.columns])
    numbered = number_rows(drops, list(order), "RowNumber", highest(kept, "RowNumber"))
    return kept.unionByName(conform_table(numbered, fact.schema, allow_missing=True))


def transfer_difference(fact: DataFrame, after: int = 10000) -> DataFrame:
    """Per station and day: drops transferred the same day after 01:00, and the latest drop time."""
    same_day = fact.filter((F.col("TranferDate") == F.col("DropDate")) & (F.col("DropTime") > after))
    day = ["StationKey", "StationCode", "TranferDate"]
    return staged_total(same_day, [*day, "DropTime", "DropDate"], day, "Amount", "DropTime", "Amount", "TimeDrop")


def business_day_totals(fact: DataFrame, cutoff: str = "0100") -> DataFrame:
    """Cash per station and business day; drops before 01:00 belong to the day before."""
    clock = F.substring(F.col("DropDateTime").cast("string"), 9, 4)
    day = day_with_cutoff(F.col("DropDate"), clock, cutoff)
    dated = fact.withColumn("__day", day).withColumn("YearMonth_DropDate", c.month_key("__day"))
    return dated.groupBy(
        "StationKey", "StationCode", F.col("__day").alias("DropDate"), "YearMonth_DropDate"
    ).agg(F.sum("Amount").alias("Amount"))


@dataclass(frozen=True)
class StatementRule:
    """Which lines of a statement count, and what its columns are called."""

    keep: Column
    number: str
    check_assignment: bool
    loaded_at: str = "ETL_Date"


# The two ledger accounts: one keeps lines whose text names the pick-up service,
# the other keeps lines with an account and checks their assignment.
def pickup_statement(text: str = "CPICK") -> StatementRule:
    return StatementRule(F.col("Text").contains(text), "DOC_Number", False)


def account_statement() -> StatementRule:
    return StatementRule(F.length("G_L") >= 1, "DOC_No", True, "ETL_DATE")


def statement_amount(text: Column, exact: bool = False) -> Column:
    """Whole units of an amount with thousands separators; text without decimals is no amount."""
    trimmed = F.trim(text)
    if exact:
        return c.without(trimmed, ",").try_cast("decimal(18,2)")
    whole = F.regexp_replace(F.regexp_extract(trimmed, r"^([^.]+)\..*", 1), r"[.,]", "")
    return whole.try_cast("decimal(18,2)")


def normalise_statement(rows: DataFrame, rule: StatementRule, stations: DataFrame, as_of,
                        exact: bool = False, legacy: bool = False) -> Split:
    """Statement lines with station, date keys and amount.

    The assignment starts with the station number and ends with the date.  Lines
    of unknown stations and dates of the wrong length are rejects.  ``legacy``
    leaves lines of unknown stations out of both halves.
    """
    document = F.try_to_timestamp(F.trim("Doc Date"), F.lit("dd.MM.yyyy"))
    kept = rows.filter(rule.keep)
    renamed = kept.select(
        *[name for name in kept.columns if name not in ("DocumentNo", "Ty", "Doc Date", "Assignment", "Amount in doc curr")],
        F.col("Ty").alias("Type"),
        F.trim("DocumentNo").alias(rule.number),
        F.right("Assignment", F.lit(8)).alias("AssignmentDateKey"),
        F.left("Assignment", F.lit(5)).try_cast("int").alias("StationCode"),
        F.date_format(document, "yyyyMMdd").alias("DOC_Date"),
        F.date_format(document, "yyyyMM").alias("YYYYMM_DocDate"),
        statement_amount(F.col("Amount in doc curr"), exact).alias("Amount_DOC_Curr"),
        c.as_timestamp(as_of).alias(rule.loaded_at),
    )
    side = stations.select(F.col("POSCode").try_cast("int").alias("pos"), "StationKey", "CustomerCode")
    placed = enrich(renamed, side, {"StationCode": "pos"}, {"StationKey": "StationKey", "CustomerCode": "CustomerCode"})
    known = F.col("StationKey").isNotNull()
    if legacy:
        placed = placed.filter(known)
    reason = F.when(~known, NO_STATION)
    if rule.check_assignment:
        reason = reason.when(F.length("AssignmentDateKey") != 8, NO_ASSIGNMENT)
    return Split(placed.withColumn(ERROR, reason))


def replace_statement_months(fact: DataFrame, staged: DataFrame) -> DataFrame:
    """Replace the document months a statement covers."""
    months = staged.withColumnRenamed("YYYYMM_DocDate", "YearMonth_DocDate")
    return slices.replace_slice(fact, conform_table(months, fact.schema, allow_missing=True), ["YearMonth_DocDate"])

"""Raw point-of-sale feeds: headerless ``|``-separated text, one layout per system and feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import decode_file_name, stamp, thai_text
from millrace.functions.conform import conform_table, fill_by_type, trim_text, union_onto
from millrace.operators import ledger as ledgers
from millrace.operators.ledger import SYSTEM_A, SYSTEM_B

# Column order of the raw files of each system and feed.  Names are positional, there is no header.
_A = {
    "TRN": """
        KeyID CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber Dispenser
        Hose Grade GradeTitle UnitPrice Volume Amount AttendeeNumber ChiefNumber""",
    "LUB": """
        KeyID CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber LubeCode
        LubeName UnitPrice Quantity Amount""",
    "AR_TRANSACTIONS": """
        KeyID CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber Dispenser
        Hose GradeNumber GradeTitle GradePrice Volume Amount LubeCode UnitPrice Quantity LBAmount PMCode ARNumber ARName
        LicensePlate DocCode ODOMeter AttendantNumber DONumber""",
    "DSC": """
        KeyId CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber DCCode
        DCAmount""",
    "EOD_TANKS": """
        KeyID CustomerCode POSCode StationName StartDateKey TankNumber GradeNumber GradeTitle OpenVolume CloseVolume
        DeliveryVolume EndDateKey""",
    "PMT": """
        KeyID CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber PMCode
        ReceiveAmount ARNumber LPNumber DocCode PAY_Date PAY_Time End_Date End_Time""",
    "EOD_METERS": """
        KeyId CustomerCode POSCode StationName CloseDateKey TankNumber DispenserNumber HoseNumber ShiftNumber
        GradeNumber GradeTitle GradePrice StartVolume EndVolume StartAmount EndAmount TestVolume UsName""",
    "POINTS": """
        KeyID CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber PMCode
        Terminal_ID Merchant_Name Batch_Number Card_Trace_Number Card_Number Available_Balance Collect_Point
        Redeem_Point Collect_TimeStemp""",
    "REFUND": """
        KeyID CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber Volume
        Amount Vat""",
    "FREE": """
        KeyID CustomerCode POSCode StationName EOD_Date ReceiptNumber TransDateKey TransTime TransNumber FreeItemNo
        FreeItemName FreeQTY FreeTopupQTY FreeMemberQTY FreeRemainQTY ReceiptItemQTY MemberCard LoyaltyRedeemQTY Rate
        AccrualPoint LoyaltyProductCode LoyaltyProductName Promotion""",
}
_B = {
    "TRN": """
        KeyID CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber Dispenser
        Hose Grade GradeTitle UnitPrice Volume Amount AttendeeNumber ChiefNumber""",
    "LUB": """
        KeyID CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber LubeCode
        LubeName UnitPrice Quantity Amount""",
    "AR_TRANSACTIONS": """
        KeyID CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber Dispenser
        Hose GradeNumber GradeTitle GradePrice Volume Amount LubeCode UnitPrice Quantity LBAmount PMCode ARNumber ARName
        LicensePlate DocCode ODOMeter AttendantNumber DONumber""",
    "DSC": """
        KeyId CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber DCCode
        DCAmount""",
    "EOD_TANKS": """
        KeyID CustomerCode POSCode StationName StartDateKey TankNumber GradeNumber GradeTitle OpenVolume CloseVolume
        DeliveryVolume EndDateKey""",
    "PMT": """
        KeyID CustomerCode POSCode StationName CloseDateKey TransNumber TransDateKey TransTime ReceiptNumber PMCode
        ReceiveAmount ARNumber LPNumber DocCode""",
    "EOD_METERS": """
        KeyId CustomerCode POSCode StationName CloseDateKey ShiftNumber DispenserNumber HoseNumber TankNumber
        GradeNumber GradeTitle GradePrice StartVolume EndVolume StartAmount EndAmount TestVolume UsName""",
    "FREE": """
        KeyID CustomerCode POSCode StationName EOD_Date ReceiptNumber TransDateKey TransTime TransNumber FreeItemNo
        FreeItemName FreeQTY FreeTopupQTY FreeMemberQTY FreeRemainQTY ReceiptItemQTY MemberCard LoyaltyRedeemQTY Rate
        AccrualPoint LoyaltyProductCode LoyaltyProductName Promotion DeliveryId""",
}
LAYOUTS = {SYSTEM_A: {feed: text.split() for feed, text in _A.items()}, SYSTEM_B: {feed: text.split() for feed, text in _B.items()}}
FEEDS = tuple(LAYOUTS[SYSTEM_A])
LINEAGE = [
    T.StructField("FileName", T.StringType()),
    T.StructField("LoadDateKey", T.IntegerType()),
    T.StructField("LoadTimeKey", T.IntegerType()),
]


def layout(system: str, feed: str) -> T.StructType:
    """Raw schema of a feed: every column is text."""
    return T.StructType([T.StructField(name, T.StringType()) for name in LAYOUTS[system][feed]])


def staging_schema(feed: str) -> T.StructType:
    """Raw columns of both systems plus lineage, all raw columns as text."""
    names = dict.fromkeys([*LAYOUTS[SYSTEM_A][feed], *LAYOUTS[SYSTEM_B].get(feed, [])])
    return T.StructType([*[T.StructField(n, T.StringType()) for n in names], *LINEAGE])


def _raw_options(thai: bool, sep: str) -> dict[str, str]:
    return {"sep": sep, "encoding": "ISO-8859-1" if thai else "UTF-8"}


def with_lineage(raw: DataFrame, as_of, hours: int = 0, thai: bool = True) -> DataFrame:
    """Decoded columns plus the file each row came from and the load keys."""
    day, clock = stamp(as_of, hours)
    columns = [thai_text(F.col(f"`{c}`")).alias(c) if thai else F.col(f"`{c}`") for c in raw.columns]
    return raw.select(*columns, decode_file_name("_metadata.file_path").alias("FileName"),
                      day.alias("LoadDateKey"), clock.alias("LoadTimeKey"))


def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, as_of, hours: int = 0,
                   sep: str = "|", thai: bool = True) -> DataFrame:
    """Headerless text in a declared schema.

    The files are read byte for byte and Thai text is decoded afterwards, so no
    session setting is needed.  No row at all gives an empty frame of the same
    schema.
    """
    raw = spark.read.schema(schema).options(**_raw_options(thai, sep)).csv(paths)
    return with_lineage(raw, as_of, hours, thai)


def stream_delimited(spark: SparkSession, path: str, schema: T.StructType, as_of, hours: int = 0,
                     sep: str = "|", thai: bool = True) -> DataFrame:
    """The same rows as a file stream, which reads each arriving file once."""
    raw = spark.readStream.schema(schema).options(**_raw_options(thai, sep)).csv(path)
    return with_lineage(raw, as_of, hours, thai)


def read_feed(spark: SparkSession, paths: str | Sequence[str], system: str, feed: str, as_of, hours: int = 0) -> DataFrame:
    return read_delimited(spark, paths, layout(system, feed), as_of, hours)


def stage_feed(frames: Sequence[DataFrame], ledger: DataFrame, feed: str, schema: T.StructType | None = None) -> DataFrame:
    """Both systems' raw rows on one staging schema, with their reserved file key."""
    staged = union_onto(schema or staging_schema(feed), frames)
    return ledgers.attach_key(staged, ledger, ledgers.FEED_LABELS.get(feed, feed))


def clean_staging(staged: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Typed, NULL-free and trimmed staging rows, as the lookups expect them."""
    typed = staged if schema is None else conform_table(staged, schema, allow_missing=True)
    cleaned = trim_text(fill_by_type(typed, strict=False))
    return cleaned.withColumn("CustomerCode", F.col("CustomerCode").cast("string"))


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path, decoded name and size of the non-empty files; their content is not read."""
    files = spark.read.format("binaryFile").load(paths).select("path", "length")
    return files.withColumn("FileName", decode_file_name("path"))


def _plain_path(path: str) -> Column:
    """A path without URL encoding and with one slash after the scheme, as the two listings differ in both."""
    decoded = F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"^(\w+):/+", "$1:/")


def empty_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path and decoded name of the zero-byte files.

    A scan never visits a file without bytes, so they are the listed files the
    scan does not return.  The listing is the one Spark plans the scan from.
    """
    found = spark.read.format("binaryFile").load(paths)
    listed = spark.createDataFrame([(path,) for path in found.inputFiles()], "path string")
    listed = listed.withColumn("__plain", _plain_path("path"))
    scanned = found.select(F.regexp_replace("path", r"^(\w+):/+", "$1:/").alias("__plain"))
    return listed.join(scanned, "__plain", "left_anti").select("path", decode_file_name("path").alias("FileName"))


def incoming_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Names, systems and feeds of the non-empty files, ready for the ledger."""
    return ledgers.parse_file_name(list_files(spark, paths).select("FileName").distinct())

"""The file ledger: which file has which key, and how its load went.

Columns: FileKey, FileName, CategoryName, SubCategoryName, LoadDateKey,
LoadTimeKey, LoadStatus.  Key sets are always frames, never driver lists.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import recode, stamp
from millrace.functions.conform import conform_table, union_by_name
from millrace.operators.keys import highest, latest_per_key, number_rows

LEDGER = T.StructType([
    T.StructField("FileKey", T.IntegerType()),
    T.StructField("FileName", T.StringType()),
    T.StructField("CategoryName", T.StringType()),
    T.StructField("SubCategoryName", T.StringType()),
    T.StructField("LoadDateKey", T.IntegerType()),
    T.StructField("LoadTimeKey", T.IntegerType()),
    T.StructField("LoadStatus", T.ShortType()),
])

PARTITIONS = ("SubCategoryName", "CategoryName", "LoadStatus")

# Load states.  NULL means the key is reserved.
LOADED = 1
STAGING_FAILED = 2
LOAD_FAILED = 3
SUPERSEDED = 4
REPLACED_BY_NEWER_MONTH = 6
CLEANUP_FAILED = 9
MAIN_STEP_FAILED = -99
# The daily-sales load writes the number of superseded files for a main step that failed.
SALES_STEP_FAILED = 4
# Only files in these states, or reserved ones, can be superseded.
SUPERSEDABLE = [LOADED, LOAD_FAILED, 5, MAIN_STEP_FAILED]

# Feed codes in file names that the ledger spells differently.
FEED_LABELS = {
    "PMT": "PAYMENT",
    "LUB": "LUBE",
    "AR_TRANSACTIONS": "AR TRANSACTIONS",
    "DSC": "DISCOUNT",
    "EOD_METERS": "METERS",
    "EOD_TANKS": "TANKS",
}
SYSTEM_A, SYSTEM_B = "FIRSTPRO", "FLOWCO"


def parse_file_name(files: DataFrame, name: str = "FileName", drop: Sequence[str] = ("CPU",)) -> DataFrame:
    """System and feed from ``<digits>#<digits><FEED>[system B].CSV``; one feed is left to its own job."""
    stem = F.regexp_extract(name, r"^[\d#]+([^/?]+)\.CSV", 1)
    is_b = stem.contains(SYSTEM_B)
    feed = F.when(is_b, F.regexp_extract(stem, f"(.*){SYSTEM_B}", 1)).otherwise(stem)
    return (
        files.withColumn("CategoryName", F.when(is_b, SYSTEM_B).otherwise(SYSTEM_A))
        .withColumn("SubCategoryName", feed)
        .filter(~F.col("SubCategoryName").isin(list(drop)))
        .withColumn("SubCategoryName", recode("SubCategoryName", FEED_LABELS))
    )


def reserve(ledger: DataFrame, files: DataFrame, as_of, hours: int = 0) -> DataFrame:
    """New ledger rows, one per distinct file name, with the next keys in name order.

    ``files`` holds FileName, CategoryName and SubCategoryName.
    """
    names = files.select("FileName", "CategoryName", "SubCategoryName").distinct()
    day, clock = stamp(as_of, hours)
    numbered = number_rows(names, ["FileName", "CategoryName", "SubCategoryName"], "FileKey", highest(ledger, "FileKey"))
    rows = numbered.withColumns({"LoadDateKey": day, "LoadTimeKey": clock, "LoadStatus": F.lit(None).cast("short")})
    return conform_table(rows, ledger.schema)


def append(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    return ledger.unionByName(conform_table(rows, ledger.schema, allow_missing=True))


def new_rows(keys: DataFrame, category: str, subcategory: str, status: int, as_of, hours: int = 0) -> DataFrame:
    """Ledger rows for files (FileKey, FileName) of one feed in one state."""
    day, clock = stamp(as_of, hours)
    return conform_table(keys.select(
        "FileKey", "FileName",
        F.lit(category).alias("CategoryName"), F.lit(subcategory).alias("SubCategoryName"),
        day.alias("LoadDateKey"), clock.alias("LoadTimeKey"), F.lit(status).alias("LoadStatus"),
    ), LEDGER)


def attach_key(staging: DataFrame, ledger: DataFrame, subcategory: str | None = None,
               category: str | None = None) -> DataFrame:
    """Give staging rows the newest reserved key of their file name."""
    reserved = ledger.filter(F.col("LoadStatus").isNull())
    if subcategory is not None:
        reserved = reserved.filter(F.col("SubCategoryName") == subcategory)
    if category is not None:
        reserved = reserved.filter(F.col("CategoryName") == category)
    newest = latest_per_key(reserved, ["FileName"], [F.col("FileKey").desc()]).select("FileName", F.col("FileKey").cast("int"))
    return staging.drop("FileKey").join(newest, "FileName", "left")


def attach_name(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Give rows the file name of their key."""
    return df.drop("FileName").join(ledger.select("FileKey", "FileName"), "FileKey", "left")


def set_columns(ledger: DataFrame, keys: DataFrame, changes: dict[str, Column | object],
                only: Column | None = None, key: str = "FileKey") -> DataFrame:
    """Change columns of the rows whose key is listed (and that meet ``only``)."""
    listed = keys.select(F.col(key).alias("__listed")).distinct()
    joined = ledger.join(listed, F.col(key) == F.col("__listed"), "left")
    hit = F.col("__listed").isNotNull()
    if only is not None:
        hit = hit & F.coalesce(only, F.lit(False))
    return joined.withColumns({
        name: F.when(hit, (value if isinstance(value, Column) else F.lit(value)).cast(ledger.schema[name].dataType))
        .otherwise(F.col(name))
        for name, value in changes.items()
    }).select(*ledger.columns)


def set_status(ledger: DataFrame, keys: DataFrame, status: int) -> DataFrame:
    return set_columns(ledger, keys, {"LoadStatus": status})


def edit_one(ledger: DataFrame, file_key: int, changes: dict[str, object]) -> DataFrame:
    """Change one row; refuse a key that is missing or occurs twice."""
    rows = ledger.filter(F.col("FileKey") == file_key).count()
    if rows != 1:
        raise ValueError(f"{rows} ledger rows have FileKey {file_key}, expected exactly one")
    same = F.col("FileKey") == file_key
    return ledger.withColumns({
        name: F.when(same, F.lit(value).cast(ledger.schema[name].dataType)).otherwise(F.col(name))
        for name, value in changes.items()
    })


def mark_superseded(ledger: DataFrame, keys: DataFrame, status: int = SUPERSEDED) -> DataFrame:
    """Supersede listed files, but only those loaded, failed or reserved."""
    can = F.col("LoadStatus").isin(SUPERSEDABLE) | F.col("LoadStatus").isNull()
    return set_columns(ledger, keys, {"LoadStatus": status}, only=can)


def mark_replayed(ledger: DataFrame, staged: DataFrame, rejects: DataFrame, status: int = LOADED) -> DataFrame:
    """Files whose replayed rows have all left the quarantine count as loaded."""
    still = rejects.select("FileKey").distinct()
    done = staged.select("FileKey").distinct().join(still, "FileKey", "left_anti")
    return set_status(ledger, done, status)


def seen_before(names: DataFrame, ledger: DataFrame, category: str | None = None,
                subcategory: str | None = None) -> DataFrame:
    """Incoming names the ledger already knows."""
    known = ledger
    if category is not None:
        known = known.filter(F.col("CategoryName") == category)
    if subcategory is not None:
        known = known.filter(F.col("SubCategoryName") == subcategory)
    return names.select("FileName").distinct().join(known.select("FileName"), "FileName", "left_semi")


@dataclass(frozen=True)
class FeedOutcome:
    """What one feed's load reports: keys superseded, loaded and failed."""

    superseded: DataFrame | None = None
    loaded: DataFrame | None = None
    failed: DataFrame | None = None


def apply_outcomes(ledger: DataFrame, outcomes: Sequence[FeedOutcome]) -> DataFrame:
    """One ledger update for all feeds: superseded, then loaded, then failed.

    The three key sets are unioned into one frame with the last state per key, so
    the ledger is joined once whatever the number of feeds.
    """
    def tagged(frames: Sequence[DataFrame | None], rank: int) -> DataFrame | None:
        keys = union_by_name([f.select("FileKey") if f is not None else None for f in frames], False)
        return None if keys is None else keys.select("FileKey", F.lit(rank).alias("__rank"))

    events = union_by_name([
        tagged([o.superseded for o in outcomes], 0),
        tagged([o.loaded for o in outcomes], 1),
        tagged([o.failed for o in outcomes], 2),
    ], False)
    if events is None:
        return ledger
    final = events.groupBy(F.col("FileKey").alias("__key")).agg(F.max("__rank").alias("__rank"))
    joined = ledger.join(final, F.col("FileKey") == F.col("__key"), "left")
    can = F.col("LoadStatus").isin(SUPERSEDABLE) | F.col("LoadStatus").isNull()
    status = (
        F.when(F.col("__rank") == 2, LOAD_FAILED).when(F.col("__rank") == 1, LOADED)
        .when((F.col("__rank") == 0) & can, SUPERSEDED).otherwise(F.col("LoadStatus"))
    )
    return joined.withColumn("LoadStatus", status.cast(ledger.schema["LoadStatus"].dataType)).select(*ledger.columns)

"""Daily sales workbook: staging, fact, small dimensions, station dimension, month-to-date reloads."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import columns as c
from millrace.functions.conform import conform_table, constant_row
from millrace.operators import ledger as ledgers
from millrace.operators import slices
from millrace.operators.keys import latest_per_key
from millrace.operators.lookup import ERROR, Lookup, Split, lookup, lookup_any, mapping_table
from millrace.operators.merge import insert_only, merge, s, unseen
from millrace.scratch import materialise
from millrace.sources import tables as store
from millrace.sources.reports import match_columns

NO_STATION, NO_PRODUCT, NO_DIVISION = "Mismatch StationKey", "Mismatch ProductKey", "Mismatch DivisionKey"
# Divisions whose materials are looked up, and the labels of two regions.
OIL_DIVISIONS = ["02", "04"]
METRO = ["Bangkok", "Vicinity"]
# Names of the fact's columns where they differ from the workbook's.
RENAMES = {
    "Int_Date": "DateKey",
    "MappingKey": "ProductKey",
    "AccountGroupCustomerGroup1KeyNotCompounded": "AccountGroupCustomerGroup1Key",
    "ProvinceKeyNotCompounded": "ProvinceKey",
    "TransportationZoneKeyNotCompounded": "TransportationZoneKey",
}


def stage(raw: DataFrame, schema: T.StructType, file_key: int | None = None,
          sales_group: str = "SalesGroupSoldTo") -> DataFrame:
    """Workbook rows on the staging schema: matched columns, one metro label, padded keys."""
    rows = match_columns(raw, schema)
    changes = {
        sales_group: c.same_or(sales_group, METRO, "Metro"),
        "DivisionKey": F.lpad("DivisionKey", 2, "0"),
        "DistributionChannelKey": F.lpad("DistributionChannelKey", 2, "0"),
    }
    if file_key is not None:
        changes["FileKey"] = F.lit(file_key).cast(schema["FileKey"].dataType)
    return rows.withColumns({name: value for name, value in changes.items() if name in rows.columns})


def load_sales(staged: DataFrame, stations: DataFrame, mapping: DataFrame, source_name: str,
               source_file: str = "DailySales", file_key: int | None = None, legacy: bool = False) -> Split:
    """Sales with station and product keys.

    Only oil divisions need a product; all others get product 0.  Rows without a
    division belong to neither group and are rejects; ``legacy`` leaves them out
    of both sides.
    """
    rows = staged.withColumns({
        "Int_Date": c.date_key("CalendarDay"),
        "CustomerCode": F.col("SoldtoPartyKey").cast("string"),
        **({"FileKey": F.lit(file_key)} if file_key is not None else {}),
    })
    sites = stations.select("CustomerCode", "StationKey").distinct()
    placed = lookup(rows, sites, {"CustomerCode": "CustomerCode"}, ["StationKey"], NO_STATION).frame
    division = F.lpad("DivisionKey", 2, "0")
    if legacy:
        placed = placed.filter(F.col(ERROR).isNotNull() | division.isNotNull())
    is_oil = division.isin(OIL_DIVISIONS)
    products = mapping_table(mapping, (F.col("SourceName") == source_name) & (F.col("SourceFile") == source_file),
                             ["SourceKey", "MappingKey"])
    found = lookup_any(placed, [Lookup(products, {"MaterialKey": "SourceKey"}, ["MappingKey"], when=is_oil)], NO_PRODUCT).frame
    other = F.col("StationKey").isNotNull() & ~is_oil
    return Split(found.withColumns({
        "MappingKey": F.when(other, F.lit(0)).otherwise(F.col("MappingKey")),
        ERROR: F.when(division.isNull() & F.col("StationKey").isNotNull(), F.lit(NO_DIVISION)).when(~other | other.isNull(), F.col(ERROR)),
    }))


def to_tables(split: Split, fact: T.StructType, rejects: T.StructType) -> tuple[DataFrame, DataFrame]:
    loaded = split.matched.withColumnsRenamed(RENAMES)
    return conform_table(loaded, fact, allow_missing=True), conform_table(split.rejected, rejects, allow_missing=True)


@dataclass(frozen=True)
class Loaded:
    """Table contents after a load."""

    fact: DataFrame
    rejects: DataFrame
    ledger: DataFrame


def load_file(staged: DataFrame, stations: DataFrame, mapping: DataFrame, source_name: str, fact: DataFrame,
              rejects: DataFrame, ledger: DataFrame, file_key: int, file_name: str, as_of, hours: int = 0,
              category: str = "SALES", subcategory: str = "DailySales", month_to_date: bool = False) -> Loaded:
    """Append one file's sales and rejects and note it as loaded.

    A month-to-date file supersedes the feed's files that share a day with it.
    """
    split = load_sales(staged, stations, mapping, source_name, file_key=file_key)
    split = split.map(lambda frame: materialise(frame, "sales"))
    new_fact, new_rejects = to_tables(split, fact.schema, rejects.schema)
    fact, rejects = fact.unionByName(new_fact), rejects.unionByName(new_rejects)
    row = staged.sparkSession.createDataFrame([(file_key, file_name)], "FileKey int, FileName string")
    if month_to_date:
        ledger, fact, rejects = slices.supersede_month_to_date(fact, rejects, ledger, file_key, category, subcategory)
    noted = ledgers.new_rows(row, category, subcategory, ledgers.LOADED, as_of, hours)
    return Loaded(fact, rejects, ledgers.append(ledger, noted))


@dataclass(frozen=True)
class SalesTables:
    """Where the stored sales tables are, and their columns."""

    root: str
    staging: T.StructType
    fact: T.StructType
    rejects: T.StructType


def stored(spark: SparkSession, tables: SalesTables) -> Loaded:
    """Tables after the last complete load."""
    done = store.versions(spark, tables.root)

    def read(name: str, schema: T.StructType) -> DataFrame:
        if not done:
            return spark.createDataFrame([], schema)
        return store.by_path(spark, f"{tables.root}/version={done[-1]}/{name}", schema).select(*schema.names)

    return Loaded(read("fact", tables.fact), read("rejects", tables.rejects), read("ledger", ledgers.LEDGER))


def load_workbook(spark: SparkSession, tables: SalesTables, raw: DataFrame, stations: DataFrame, mapping: DataFrame, source_name: str,
                  file_key: int, file_name: str, as_of, hours: int = 0, category: str = "SALES", subcategory: str = "DailySales",
                  month_to_date: bool = False) -> Loaded:
    """Stage and load one workbook's rows into the stored tables and note how far it came.

    The file's state says which step failed: staging (nothing is loaded), the main step (nothing
    is loaded), or the removal of files a month-to-date file supersedes (its own rows are
    loaded, the older ones still there).  Fact, rejects and ledger become one version, so
    a stop leaves them as they were.  The error of a failed step is raised after that.
    """
    before = stored(spark, tables)
    done = store.versions(spark, tables.root)
    fact, rejects, ledger, error = before.fact, before.rejects, before.ledger, None
    state = ledgers.STAGING_FAILED
    try:
        staged = materialise(stage(raw, tables.staging, file_key), "sales_staged")
        state = ledgers.SALES_STEP_FAILED
        split = load_sales(staged, stations, mapping, source_name, file_key=file_key).map(lambda frame: materialise(frame, "sales"))
        new_fact, new_rejects = to_tables(split, tables.fact, tables.rejects)
        fact, rejects = fact.unionByName(new_fact), rejects.unionByName(new_rejects)
        state = ledgers.CLEANUP_FAILED
        if month_to_date:
            kept = slices.supersede_month_to_date(fact, rejects, ledger, file_key, category, subcategory)
            ledger, fact, rejects = (materialise(df, name) for df, name in zip(kept, ("ledger", "fact", "rejects"), strict=True))
        state = ledgers.LOADED
    except Exception as raised:  # noted below, then raised again
        error = raised
    row = ledgers.new_rows(spark.createDataFrame([(file_key, file_name)], "FileKey int, FileName string"), category, subcategory, state, as_of, hours)
    number = (done[-1] if done else 0) + 1
    store.write_together(spark, tables.root, number, {"fact": (fact, ()), "rejects": (rejects, ()), "ledger": (ledgers.append(ledger, row), ledgers.PARTITIONS)})
    store.commit_version(spark, tables.root, number)
    if error is not None:
        raise error
    return stored(spark, tables)


def replay_rejects(stations: DataFrame, mapping: DataFrame, source_name: str, fact: DataFrame, rejects: DataFrame,
                   ledger: DataFrame) -> Loaded:
    """Try quarantined sales again; files with loaded rows and no reject left count as loaded."""
    split = load_sales(rejects.drop(ERROR), stations, mapping, source_name)
    split = split.map(lambda frame: materialise(frame, "replay"))
    new_fact, new_rejects = to_tables(split, fact.schema, rejects.schema)
    return Loaded(fact.unionByName(new_fact), new_rejects, ledgers.mark_replayed(ledger, new_fact, new_rejects))


def station_columns(prefix: str) -> dict[str, str]:
    """Sales columns of the station dimension (prefixed) and the workbook columns they mirror."""
    # How the dimension abbreviates the workbook's names.
    return {
        f"{prefix}SoldtoName": "SoldtoParty",
        f"{prefix}SalesPersonKey": "SalesPersonSoldToKey",
        f"{prefix}ProvinceKey": "ProvinceKeyNotCompounded",
        **{f"{prefix}{name}": name for name in (
            "SalesPersonSoldTo", "SalesGroupSoldToKey", "SalesGroupSoldTo", "BusinessLineKey", "BusinessLine",
            "InvestmentTypeKey", "InvestmentType", "Province", "SalesOfficeSoldToKey", "SalesOfficeSoldTo")},
    }


def station_defaults(schema: T.StructType) -> dict[str, object]:
    """What a new station gets where the workbook knows nothing, by column type."""
    # Unknown text, day, small count, rate.
    by_name = {"HighwaySignHeight": 99, "HighwaySignLabelAmount": 99, "Rate": 0}
    unknown: dict[str, object] = {}
    for field in schema:
        if field.name in by_name:
            unknown[field.name] = by_name[field.name]
        elif field.name in ("SelfServe", "StationKey", "POSCode"):
            continue
        elif isinstance(field.dataType, T.StringType):
            unknown[field.name] = "NA"
        elif isinstance(field.dataType, (T.IntegerType, T.LongType)):
            unknown[field.name] = 99991231
    return unknown


def merge_members(dimension: DataFrame, source: DataFrame, key: str, source_key: str, newest_by: list[str],
                  update: Mapping[str, str], defaults: Mapping[str, object], action: str | None = "status") -> DataFrame:
    """Snapshot merge: the newest source row of each key updates its member or adds a default-filled one."""
    newest = latest_per_key(source, [source_key], [F.col(name).desc() for name in newest_by])
    newest = newest.withColumn(source_key, F.col(source_key).cast(dimension.schema[key].dataType))
    on = {key: source_key}
    kept = merge(dimension, newest, on, {key: s(source_key)} | {mine: s(theirs) for mine, theirs in update.items()},
                 None, labels=("SAME", "UPDATE", "UPDATE", "INSERT"), action=action)
    fresh = constant_row(unseen(newest, dimension, on), defaults,
                         {key: F.col(source_key)} | {mine: F.col(theirs) for mine, theirs in update.items()},
                         dimension.schema)
    return kept.unionByName(fresh.withColumn(action, F.lit("INSERT")) if action else fresh)


def update_stations(dimension: DataFrame, staged: DataFrame, prefix: str, action: str | None = None) -> DataFrame:
    columns = station_columns(prefix)
    order = ["CalendarDay", *[name for name in dict.fromkeys(columns.values())]]
    return merge_members(dimension, staged, "CustomerCode", "SoldtoPartyKey", order, columns,
                         station_defaults(dimension.schema), action)


def update_small_dimension(dimension: DataFrame, staged: DataFrame, name: str, key: str | None = None,
                           pad: bool = True) -> DataFrame:
    """Insert unseen (key, name) pairs.  ``key`` is the staging column if it is called differently."""
    own_key = f"{name}Key"
    return insert_only(dimension, staged, {own_key: key or own_key, name: name}, (own_key, 2) if pad else None)

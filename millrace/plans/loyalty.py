"""Loyalty: merchants, products, cards, card transactions, registrations and point items."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import columns as c
from millrace.functions.conform import conform_table, conform_types, fill_by_type, rename_select, union_by_name
from millrace.operators import enrich as fill
from millrace.operators import slices
from millrace.operators.keys import allocate_keys, flag_latest
from millrace.operators.lookup import ERROR, Split, flag_present, lookup
from millrace.operators.merge import (ACTION, any_differs, merge, refresh_keep_keys, s, upsert_changed, upsert_full,
                                      versioned_merge)
from millrace.plans.steps import Step
from millrace.scratch import materialise

LOCAL_HOURS = 7
RAW_TIME = "dd/MM/yyyy HH:mm:ss"


def camel(name: str) -> str:
    """``POINT_BEFORE_AWARD`` -> ``PointBeforeAward``; mixed-case names stay."""
    return "".join(part.capitalize() for part in name.split("_")) if name.upper() == name else name


# ---- merchants and products ------------------------------------------------------

# Merchant columns that are not spelled alike in staging and dimension.
_MERCHANT_NAMES = {
    "Loc": "LOC", "OuTypeCd": "OU_TYPE_CD", "Mid": "MID", "CustomerCode": "CUSTOMER_NUMBER",
    "MidNameEn": "MID_NAME_EN", "MidNameTh": "MID_NAME_TH", "BusinessUnit": "BUSINESS_UNIT", "MidStatus": "MID_STATUS",
}
_MERCHANT_SAME = ["Merchant_Type", "House_No", "MOO", "Street", "Tumbon", "Amphur", "Country", "Province", "Zipcode",
                  "Region", *[f"Attribute{i:02d}" for i in range(1, 11)], "SOR_N", "ShopCode_Shipto",
                  *[f"Information_{i}" for i in range(1, 4)]]


def update_merchants(dimension: DataFrame, staged: DataFrame, as_of, hours: int = 0,
                     key: str = "MerchandiseKey") -> DataFrame:
    """Merchants with changed ones updated, new ones added and numbered in row-id order."""
    source = staged.select(
        F.trim("ROW_ID").alias("RowId"),
        *[F.col(theirs).alias(mine) for mine, theirs in _MERCHANT_NAMES.items()],
        c.date_key("LAST_UPD").alias("LastUpdDateKey"), c.time_key("LAST_UPD").alias("LastUpdTimeKey"),
        c.date_key("MID_CreateDate").alias("MID_CreateDate"), c.time_key("MID_CreateDate").alias("MID_CreateTime"),
        *_MERCHANT_SAME,
    )
    day, clock = c.stamp(as_of, hours)
    target = dimension.withColumn("RowId", F.trim("RowId"))
    tracked = [name for name in source.columns if name != "RowId"]
    merged = upsert_changed(target, conform_types(source, dimension.schema), ["RowId"], tracked,
                            {"LoadDateKey": day, "LoadTimeKey": clock}, action=None)
    return allocate_keys(merged, key, ["RowId"], existing=dimension, stage=True)


def update_products(dimension: DataFrame, staged: DataFrame, key: str = "ProductKey") -> DataFrame:
    """The staged products with known keys kept and new ones numbered in row-id order."""
    moments = {"CREATED": "Created", "LAST_UPD": "LastUpd", "LoadDateTime": "Load"}
    plain = {name: "rowid" if name == "ROW_ID" else camel(name) for name in staged.columns if name not in moments}
    renamed = staged.select(
        *[(F.trim(old) if new == "rowid" else F.col(old)).alias(new) for old, new in plain.items()],
        *[c.date_key(old).alias(f"{new}DateKey") for old, new in moments.items() if old in staged.columns],
        *[c.time_key(old).alias(f"{new}TimeKey") for old, new in moments.items() if old in staged.columns],
    )
    target = fill_by_type(dimension.filter(F.col(key).isNotNull()), strict=False).withColumn("rowid", F.trim("rowid"))
    schema = T.StructType([field for field in dimension.schema if field.name != key])
    refreshed = refresh_keep_keys(target, conform_table(renamed, schema), ["rowid"], key)
    return allocate_keys(refreshed.select(*dimension.columns), key, ["rowid"], existing=dimension, stage=True)


# ---- cards -----------------------------------------------------------------------

# Card columns whose name is not the camel-case form of the raw name.
_CARD_NAMES = {
    "SAME_PR_FLG": "SamePriceSubmit", "MEM_CLASS": "MemberClass", "MEMBER_ID": "MemberID", "MEMBER_NUM": "MEMBER_NUM",
    "MOBILE_NUMBEROriginal": "MobileNumberOriginal", "EMAIL_ADDROriginal": "EmailAddrOriginal",
}
# Raw card columns in their order.
_CARD_RAW = [
    "CARD_STATUS", "CARD_TYPE", "CARD_SUB_TYPE", "CARD_NUM", "MEMBER_ID", "MOBILE_NUMBER", "FIRST_NAME_ENG",
    "LAST_NAME_ENG", "BIRTH_DATE", "FIRST_NAME_THA", "LAST_NAME_THA", "IDENTIFICATION_NUM", "CAR_MODEL", "PROVINCE",
    "COUNTRY", "DISTRICT", "POSTAL_CODE", "SUB_DISTRICT", "MOO_SOI", "ROAD_STREET", "HOUSE_NO", "CONTACT_STATUS",
    "APPROVAL_STATUS", "SAME_PR_FLG", "MEM_CLASS", "EMAIL_ADDR", "DONATION_FLAG", "DONATION_CODE", "DONATION_NAME",
    "Chanel", "UpdateBy", "MOBILE_NUMBEROriginal", "EMAIL_ADDROriginal", "MEMBER_NUM", "MemberGroup", "RegisChannel",
]
# Integer date and time keys of a card.
_CARD_KEYS = ["LoadDateKey", "LoadTimeKey", "CardIssuedDateKey", "CardIssuedTimeKey", "CardExpireDateKey",
              "CardExpireTimeKey", "JoinDateKey", "JoinTimeKey"]
CARD_COLUMNS = [*[_CARD_NAMES.get(name, camel(name)) for name in _CARD_RAW], "JoinDate", *_CARD_KEYS, "IsTest"]
# A change in these alone is no reason to rewrite a card.
_CARD_UNTRACKED = {"CardStatus", "CardType", "CardSubType", "CardNum", "LoadDateKey", "LoadTimeKey",
                   "CardIssuedDateKey", "CardIssuedTimeKey", "CardExpireTimeKey"}
CARD_TRACKED = [name for name in CARD_COLUMNS if name not in _CARD_UNTRACKED]


def stage_cards(raw: DataFrame, test_cards: DataFrame, hours: int = LOCAL_HOURS, issued: str = "CARD_USSUED_DATE") -> DataFrame:
    """Raw cards with a test-card flag, local times as integer keys and dimension names."""
    flagged = flag_present(raw, test_cards, {"CARD_NUM": "cardnum"}, "IsTest")
    moments = {
        "Load": c.shift("CreatedDateTime", hours),
        "CardIssued": c.parse_time(issued, RAW_TIME, hours),
        "CardExpire": c.parse_time("CARD_EXPIRE_DATE", RAW_TIME, hours),
        "Join": c.parse_time("JoinDate", RAW_TIME, hours),
    }
    keys = [(key(moment).alias(f"{name}{part}Key")) for name, moment in moments.items()
            for part, key in (("Date", c.date_key), ("Time", c.time_key))]
    return flagged.select(
        *[F.col(name).alias(_CARD_NAMES.get(name, camel(name))) for name in _CARD_RAW],
        F.date_format(moments["Join"], "yyyy-MM-dd HH:mm:ss").alias("JoinDate"),
        *keys, "IsTest",
    )


def update_cards(dimension: DataFrame, staged: DataFrame, as_of, hours: int = LOCAL_HOURS,
                 null_is_change: bool = False, rank_open_only: bool = False) -> DataFrame:
    """Card profile after a load.

    A changed status closes the open row and opens a new one; other changes
    overwrite the open row; unseen cards are added.  New rows are numbered in
    card order and the member's newest open card is flagged.
    """
    staged = conform_types(staged, dimension.schema)
    text = [f.name for f in staged.schema if isinstance(f.dataType, T.StringType) and f.name != "CardStatus"]
    keep = ["StartDateKey", "StartTimeKey", "EndDateKey", "EndTimeKey", "CardProfileKey"]
    current = versioned_merge(
        dimension, staged, ["CardNum"], "CardStatus", [n for n in CARD_TRACKED if n in staged.columns], keep, as_of, hours,
        defaults=dict.fromkeys(text, "NA"), load=("LoadDateKey", "LoadTimeKey"), null_is_change=null_is_change)
    order = ["CardNum", "StartDateKey", "StartTimeKey"]
    numbered = allocate_keys(current, "CardProfileKey", order, existing=dimension, stage=True)
    flagged = flag_latest(numbered, "MemberID", ["StartDateKey", "CardIssuedDateKey"], "CardProfileKey",
                          "LastStatusMember", F.col("EndDateKey").isNull(), rank_open_only)
    return conform_table(flagged, dimension.schema)


# ---- transactions ----------------------------------------------------------------

# Transaction columns whose name is not the camel-case form, reasons and defaults.
_TXN_NAMES = {"MEMBER_ID": "MemberID", "X_CO2_TXN": "TotalCO2"} | {
    name: name for name in ("BATCH_NUM", "TRACE_NUM", "SYS_TRACE", "CHANNEL_TYPE")}
_TXN_MOMENTS = {"CREATED": "Created", "LAST_UPD": "LastUpd", "LoadDateTime": "Load", "PROCESS_DATE": "Process",
                "TRANS_DATE": "Trans"}
NO_CARD, NO_PRODUCT, NO_MERCHANT = "Mismatch MembershipKey", "Mismatch ProductKey", "Mismatch MerchandiseKey"
POINT_GROUP, REGISTRATION_PRODUCT = "POINT", 38
UNKNOWN_KEY = 20180101
_TXN_KEYS = ("CardProfileKey", "MerchandiseKey", "ProductKey")


def product_groups(mapping: DataFrame, products: DataFrame, source_name: str, source_file: str = "TRANSACTION") -> DataFrame:
    """Product key and group per product code of one source."""
    codes = mapping.filter((F.col("SourceName") == source_name) & (F.col("SourceFile") == source_file))
    groups = products.select(F.col("ProductKey").alias("__p"), "ProductGroup")
    joined = codes.join(groups, F.col("MappingKey") == F.col("__p"), "left")
    return joined.select(F.col("SourceKey").alias("PRODUCT_ID"), "MappingKey", "ProductGroup").distinct()


def resolve_transactions(raw: DataFrame, cards: DataFrame, products: DataFrame, merchants: DataFrame,
                         hours: int = LOCAL_HOURS) -> Split:
    """Card, product and merchant keys of raw transactions, and their local date and time keys.

    ``products`` comes from :func:`product_groups`.  The chain is one plan: a row
    rejected at one step takes no part in the next.
    """
    opened = cards.filter(F.col("EndDateKey").isNull()).select("CardNum", "CardProfileKey")
    rows = raw.withColumn("PRODUCT_ID_NotNull", F.coalesce("PRODUCT_ID", F.lit("0")))
    split = lookup(rows, opened, {"CARD_NUM": "CardNum"}, ["CardProfileKey"], NO_CARD)
    split = lookup(split.frame, products, {"PRODUCT_ID_NotNull": "PRODUCT_ID"}, ["MappingKey", "ProductGroup"], NO_PRODUCT)
    no_shop = (F.col("ProductGroup") == POINT_GROUP) & (
        (F.col("MappingKey") != REGISTRATION_PRODUCT) | F.col("MERCHANT_ROW_ID").isNull())
    shop = F.when(no_shop, F.lit("NA")).otherwise(F.col("MERCHANT_ROW_ID"))
    sites = merchants.select(F.col("RowId").alias("__row"), "MerchandiseKey")
    split = lookup(split.frame.withColumn("CAST_MERCHANT_ROW_ID", shop), sites, {"CAST_MERCHANT_ROW_ID": "__row"},
                   ["MerchandiseKey"], NO_MERCHANT)
    keys = {f"{new}{part}Key": key(c.shift(old, hours)) for old, new in _TXN_MOMENTS.items()
            for part, key in (("Date", c.date_key), ("Time", c.time_key))}
    return Split(split.frame.withColumns(keys))


def transaction_rows(matched: DataFrame, schema: T.StructType) -> DataFrame:
    """Resolved transactions in the fact's columns, without NULL and with the point balance.

    Absent date and time keys become a fixed day, text ``'NA'``, numbers 0; the
    three surrogate keys are never filled.
    """
    raw = [name for name in matched.columns if name not in _TXN_MOMENTS and name != ERROR]
    names = {name: "ProductKey" if name == "MappingKey" else _TXN_NAMES.get(name, camel(name)) for name in raw}
    wanted = set(schema.names)
    typed = conform_types(rename_select(matched, {old: new for old, new in names.items() if new in wanted}), schema)
    balance = F.col("PointBeforeAward") + F.col("AwardPoint") - F.coalesce("RedeemPoint", F.lit(0))

    def cell(field: T.StructField) -> Column:
        if field.name == "RemainingPoint":
            return balance.cast(field.dataType).alias(field.name)
        column = F.col(field.name)
        if field.name in _TXN_KEYS:
            return column
        if field.name.endswith(("DateKey", "TimeKey")):
            default = F.lit(UNKNOWN_KEY)
        else:
            default = F.lit("NA") if isinstance(field.dataType, T.StringType) else F.lit(0)
        return F.coalesce(column, default.cast(field.dataType)).alias(field.name)

    have = {field.name: field for field in typed.schema}
    filled = typed.select(*[cell(field) for field in schema if field.name in have])
    filled = filled.withColumns({"TransYearKey": c.year_of_key("TransDateKey"), "TransMonthKey": c.month_of_key("TransDateKey")})
    return conform_table(filled, schema, allow_missing=True)


def merge_transactions(fact: DataFrame, today: DataFrame | None, rows: DataFrame, action: str | None = None) -> DataFrame:
    """Fact (cold and hot part together) with known transactions replaced and new ones added."""
    whole = union_by_name([fact, today])
    return upsert_full(whole, rows, ["TxnId"], action=action)


def merge_rejects(rejects: DataFrame, split: Split, fact: DataFrame, key: str = "TXN_ID", fact_key: str = "TxnId") -> DataFrame:
    """Quarantine after a load: changed rejects updated, new ones added, loaded ones purged."""
    text = [f.name for f in rejects.schema if isinstance(f.dataType, T.StringType) and f.name not in (key, ERROR)]
    fresh = conform_table(split.rejected.withColumnRenamed("X_CO2_TXN", "TotalCO2"), rejects.schema, allow_missing=True)
    fresh = fresh.withColumns({name: F.coalesce(F.col(name), F.lit("NA")) for name in text})
    if {"POINT_BEFORE_AWARD", "AWARD_POINT", "REDEEM_POINT", "REMAINING_POINT"} <= set(rejects.columns):
        balance = F.col("POINT_BEFORE_AWARD") + F.col("AWARD_POINT") - F.coalesce("REDEEM_POINT", F.lit(0))
        fresh = fresh.withColumn("REMAINING_POINT", balance.cast(rejects.schema["REMAINING_POINT"].dataType))
    tracked = [name for name in rejects.columns if name != key]
    merged = upsert_changed(rejects, fresh, [key], tracked, action=None)
    return slices.purge_loaded(merged, fact, key, fact_key)


def split_transactions(fact: DataFrame, as_of, hours: int = LOCAL_HOURS) -> tuple[DataFrame, DataFrame]:
    """Today's transactions and older ones."""
    return slices.split_hot_cold(fact, "TransDateKey", as_of, hours)


TXN_PARTITIONS = ("TransYearKey", "TransMonthKey", "TransType", "TransStatus")


# ---- registrations ---------------------------------------------------------------

# Product groups and keys that count as a purchase.
PURCHASE_GROUPS = ["LUBE", "MOGAS", "HSD", "NONOIL", "Mart"]
ALWAYS_PURCHASE = [41]


def register_cards(register: DataFrame, cards: DataFrame, fact: DataFrame, as_of, hours: int = LOCAL_HOURS) -> DataFrame:
    """Fill each card's registration from its first registration transaction, once."""
    day, clock = c.stamp(as_of, hours)
    signed = fact.filter((F.col("ProductKey") == REGISTRATION_PRODUCT) & (F.col("AwardPoint") >= 0))
    signed = signed.select("CardProfileKey", "TxnId", "TransDateKey", "TransTimeKey", "MerchandiseKey", "TerminalId")
    numbers = cards.select("CardProfileKey", "CardNum")
    first = fill.first_per_key(signed.join(numbers, "CardProfileKey"), ["CardNum"], ["TransDateKey", "TransTimeKey", "TxnId"],
                               ["TxnId", "TransDateKey", "TransTimeKey", "MerchandiseKey", "TerminalId"])
    source = cards.select("CardNum").distinct().join(first, "CardNum", "left")
    values = {
        "RegisterationTxnId": s("TxnId"), "RegistrationProcessDateKey": s("TransDateKey"),
        "RegistrationProcessTimeKey": s("TransTimeKey"), "RegisMerchandiseKey": s("MerchandiseKey"),
        "RegisTerminalId": s("TerminalId"), "LastUpdDateKey": day, "LastUpdTimeKey": clock,
    }
    return fill.fill_once(register, source, {"cardnum": "CardNum"}, "RegisterationTxnId", values)


def purchase_products(products: DataFrame, used: str) -> DataFrame:
    """Products that count as a purchase: used ones of some groups, or listed keys."""
    counted = (F.col(used).cast("string") == "1") & F.col("ProductGroup").isin(PURCHASE_GROUPS)
    return products.filter(counted | F.col("ProductKey").isin(ALWAYS_PURCHASE)).select("ProductKey").distinct()


def _processed_accruals(fact: DataFrame) -> DataFrame:
    return fact.filter((F.col("TransType") == "ACCRUAL") & (F.col("TransSubType") == "Product") & (F.col("TransStatus") == "Processed"))


def first_purchases(register: DataFrame, cards: DataFrame, fact: DataFrame, products: DataFrame, as_of,
                    hours: int = 0) -> DataFrame:
    """Fill each registered card's first purchase after its registration, once."""
    day, clock = c.stamp(as_of, hours)
    bought = _processed_accruals(fact).join(products, "ProductKey", "left_semi")
    bought = bought.select("CardProfileKey", "TxnId", "TransDateKey", "TransTimeKey", "MerchandiseKey")
    bought = bought.join(cards.select("CardProfileKey", "CardNum"), "CardProfileKey")
    bought = bought.withColumn("__moment", c.key_text("TransDateKey", "TransTimeKey"))
    starts = register.select(F.col("cardnum").alias("CardNum"),
                             c.key_text("RegistrationProcessDateKey", "RegistrationProcessTimeKey").alias("__begin"))
    first = fill.first_after(starts, bought, "CardNum", "__begin", "__moment", ["__moment", "TxnId"],
                             ["TxnId", "TransDateKey", "TransTimeKey", "MerchandiseKey"])
    values = {
        "FirstTransTxnId": s("TxnId"), "FirstTransProcessDateKey": s("TransDateKey"),
        "FirstTransProcessTimeKey": s("TransTimeKey"), "MerchandiseKey": s("MerchandiseKey"),
        "LastUpdDateKey": day, "LastUpdTimeKey": clock,
    }
    return fill.fill_once(register, first, {"cardnum": "CardNum"}, "FirstTransTxnId", values, insert=False)


def backfill_members(register: DataFrame, cards: DataFrame, as_of, placeholder: str, hours: int = LOCAL_HOURS) -> DataFrame:
    """Member id of registrations changed today that lack one.

    ``placeholder`` is the member id that stands for "no member".
    """
    today, _ = c.stamp(as_of, hours)
    known = cards.filter(F.col("EndDateKey").isNull() & (F.col("MemberID") != placeholder)).select("CardNum", "MemberID")
    only = F.col("RegisterationTxnId").isNotNull() & F.col("MemberID").isNull() & (F.col("LastUpdDateKey") == today)
    return fill.backfill(register, known, {"cardnum": "CardNum"}, "MemberID", "MemberID", only)


# ---- terminals -------------------------------------------------------------------


def update_terminals(dimension: DataFrame, staged: DataFrame, hours: int = LOCAL_HOURS, action: str | None = None) -> DataFrame:
    """Terminals with merchant or status changes applied and new ones added.

    Ids are compared in upper case, an absent id as ``'NA'``; it is NULL again in
    the result.  Changed and new rows carry local times.
    """
    compared = ("TID", "MID", "TID_Status")

    def prepared(df: DataFrame) -> DataFrame:
        upper = df.withColumns({"TID": F.upper("TID"), "MID": F.upper("MID")})
        return upper.withColumns({name: F.coalesce(F.col(name), F.lit("NA")) for name in compared})

    source = staged if "LoadDate" in staged.columns else staged.withColumn("LoadDate", F.col("loadDateTime"))
    source = prepared(source)
    row = {name: s(name) if name in source.columns else F.lit(None) for name in dimension.columns}
    for name in ("LoadDate", "UpdateDate"):
        if name in row and name in source.columns:
            row[name] = c.shift(s(name), hours)
    merged = merge(prepared(dimension), source, ["TID"], row, row, any_differs(["MID", "TID_Status"]),
                   ("SAME IN TARGET", "SAME IN MATCHED", "UPDATE", "INSERT"), action or ACTION)
    restored = merged.withColumns({name: c.to_null(name, "NA") for name in compared})
    return restored if action else restored.drop(ACTION)


# ---- member attributes -----------------------------------------------------------


@dataclass(frozen=True)
class StationLabel:
    """Label of the station a card was registered at: by customer code or name prefix, else the other one."""

    customer_code: str
    prefix: str
    hit: str
    other: str

    def of(self, merchants: DataFrame) -> DataFrame:
        label = c.class_by_code_or_prefix("CustomerCode", self.customer_code, "MidNameEn", self.prefix, self.hit, self.other)
        return merchants.select(F.col("MerchandiseKey").alias("__site"), label.alias("RegisSS"))


def label_candidates(register: DataFrame, cards: DataFrame, merchants: DataFrame, label: StationLabel,
                     placeholder: str, only_register: Column | None = None, only_card: Column | None = None) -> DataFrame:
    """Proposed station label per registered card of an open, active member."""
    active = cards.filter(
        F.col("EndDateKey").isNull() & (F.col("MemberID") != placeholder) & (F.col("CardStatus") != "New"))
    active = active if only_card is None else active.filter(only_card)
    noted = register if only_register is None else register.filter(only_register)
    noted = noted.select(F.col("cardnum").alias("__card"), F.coalesce("RegisMerchandiseKey", F.lit(0)).alias("__at"))
    joined = active.select("CardNum", "MemberID").join(noted, F.col("CardNum") == F.col("__card"))
    return joined.join(label.of(merchants), F.col("__at") == F.col("__site"), "left").select("CardNum", "MemberID", "RegisSS")


def resolve_stations(cards: DataFrame, candidates: DataFrame) -> DataFrame:
    """One registration label for all cards of each member, ``'ERR'`` where cards disagree."""
    return fill.resolve_attribute(cards, candidates, "MemberID", "RegisSS", ["CardNum"], F.col("CardStatus") != "New")


def update_station_labels(cards: DataFrame, register: DataFrame, merchants: DataFrame, placeholder: str, as_of,
                          changed: StationLabel, missing: StationLabel) -> DataFrame:
    """Label members registered today, then members that joined without one."""
    today, _ = c.stamp(as_of)
    first = label_candidates(register, cards, merchants, changed, placeholder, F.col("LastUpdDateKey") == today)
    cards = resolve_stations(cards, first)
    second = label_candidates(register, cards, merchants, missing, placeholder, None,
                              F.col("RegisSS").isNull() & F.col("JoinDateKey").isNotNull())
    return resolve_stations(cards, second)


def flag_members(cards: DataFrame, fact: DataFrame, products: DataFrame, product_key: int, used: str,
                 into: str, value: str = "Y") -> DataFrame:
    """Flag all cards of members with a qualifying, not cancelled transaction of one product."""
    counted = products.filter((F.col(used).cast("string") == "1") & (F.col("ProductKey") == product_key)).select("ProductKey")
    rows = _processed_accruals(fact).filter((F.col("ProductKey") == product_key) & (F.col("CancelledTxnId") == "NA"))
    rows = rows.join(counted, "ProductKey", "left_semi").join(cards.select("CardProfileKey"), "CardProfileKey", "left_semi")
    return fill.propagate_flag(cards, rows, "MemberID", into, value)


# ---- point items -----------------------------------------------------------------


def _items(fact: DataFrame, staged: DataFrame, key: str, renames: dict[str, str], action: str | None) -> DataFrame:
    source = fill_by_type(staged, strict=False).withColumnsRenamed(renames)
    source = conform_table(source, fact.schema)
    return upsert_full(fact, source, [key], ("SAME", "SAME", "UPDATE", "INSERT"), action)


def merge_accrual_items(fact: DataFrame, staged: DataFrame, key: str = "PointItem_RowID", action: str | None = None) -> DataFrame:
    def trimmed(df: DataFrame) -> DataFrame:
        return df.withColumn(key, F.trim(key))

    return _items(trimmed(fact.distinct()), trimmed(staged), key, {"EXPIRATION_DT": "Expiration_Date"}, action)


def merge_redemption_items(fact: DataFrame, staged: DataFrame, key: str = "REDEEM_ROW_ID", action: str | None = None) -> DataFrame:
    dated = staged.withColumn("YearKey", F.lpad(F.date_format("TXN_DT", "yyyy"), 4, "0"))
    return _items(fact, dated, key, {"TXN_DT": "TRANSACTION_DATE"}, action)


# ---- the whole load ----------------------------------------------------------------


@dataclass(frozen=True)
class Arrivals:
    """What a loyalty load takes in; steps whose input is None are left out."""

    merchants: DataFrame | None = None
    products: DataFrame | None = None
    cards: DataFrame | None = None
    test_cards: DataFrame | None = None
    transactions: DataFrame | None = None
    mapping: DataFrame | None = None
    terminals: DataFrame | None = None
    accruals: DataFrame | None = None
    redemptions: DataFrame | None = None


@dataclass(frozen=True)
class Rules:
    """Names and codes of a loyalty programme: the source of its product codes, the member id that stands for none, the
    column of products in use, station labels (of changed and of unlabelled members) and flags (product, column)."""

    source_name: str
    placeholder: str
    used: str
    labels: tuple[StationLabel, StationLabel] | None = None
    flags: tuple[tuple[int, str], ...] = ()


def load_steps(given: Arrivals, rules: Rules, as_of, hours: int = LOCAL_HOURS) -> list[Step]:
    """The steps of a load in their order, over the tables merchants, products, cards, fact, rejects, register, terminals, accruals and redemptions."""
    def transactions(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        split = resolve_transactions(given.transactions, t["cards"], product_groups(given.mapping, t["products"], rules.source_name), t["merchants"], hours)
        split = split.map(lambda frame: materialise(frame, "transactions"))  # read by the fact and the quarantine
        fact = merge_transactions(t["fact"], None, transaction_rows(split.matched, t["fact"].schema))
        return {"fact": fact, "rejects": merge_rejects(t["rejects"], split, transaction_rows(split.matched, t["fact"].schema))}

    def registrations(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        noted = register_cards(t["register"], t["cards"], t["fact"], as_of, hours)
        return {"register": first_purchases(noted, t["cards"], t["fact"], purchase_products(t["products"], rules.used), as_of)}

    def flagged(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        cards = t["cards"]
        for product, into in rules.flags:
            cards = flag_members(cards, t["fact"], t["products"], product, rules.used, into)
        return {"cards": cards.select(*t["cards"].columns)}

    steps = [
        (given.merchants, Step("merchants", lambda t: {"merchants": update_merchants(t["merchants"], given.merchants, as_of, hours)})),
        (given.products, Step("products", lambda t: {"products": update_products(t["products"], given.products)})),
        (given.cards, Step("cards", lambda t: {"cards": update_cards(t["cards"], stage_cards(given.cards, given.test_cards, hours), as_of, hours)})),
        (given.transactions, Step("transactions", transactions)),
        (given.transactions, Step("registrations", registrations)),
        (given.transactions, Step("members", lambda t: {"register": backfill_members(t["register"], t["cards"], as_of, rules.placeholder, hours)})),
        (given.terminals, Step("terminals", lambda t: {"terminals": update_terminals(t["terminals"], given.terminals, hours)})),
        (rules.labels, Step("labels", lambda t: {"cards": update_station_labels(t["cards"], t["register"], t["merchants"], rules.placeholder, as_of, *rules.labels)})),
        (rules.flags or None, Step("flags", flagged)),
        (given.accruals, Step("accruals", lambda t: {"accruals": merge_accrual_items(t["accruals"], given.accruals)})),
        (given.redemptions, Step("redemptions", lambda t: {"redemptions": merge_redemption_items(t["redemptions"], given.redemptions)})),
    ]
    return [step for needed, step in steps if needed is not None]

"""Point-of-sale feeds: staging rows to fact rows and explained rejects.

One plan serves both source systems.  The system is part of the product lookup
key instead of a reason to run the load twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import columns as c
from millrace.functions.conform import conform_table
from millrace.operators import ledger as ledgers
from millrace.operators import slices
from millrace.operators.ledger import SYSTEM_A, SYSTEM_B
from millrace.operators.lookup import ERROR, Lookup, Split, lookup_any, mapping_table
from millrace.operators.totals import net_parts
from millrace.scratch import materialise

IS_B = "IsFlowCo"
NO_STATION, NO_PRODUCT, NO_VOLUME = "Mismatch StationKey", "Mismatch ProductKey", "Mismatch Volume"
PRODUCT = "MappingKey"


@dataclass(frozen=True)
class ProductRule:
    """How a feed finds its product: by code and title, else by code and station."""

    code: str
    title: str
    file: str
    fallback_file: str
    fallback_systems: tuple[str, ...] = (SYSTEM_A, SYSTEM_B)
    untitled_systems: tuple[str, ...] = ()


@dataclass(frozen=True)
class FeedRule:
    """Preparation and lookups of one feed."""

    prepare: Callable[[], dict[str, Column]]
    product: ProductRule | None = None
    renames: Mapping[str, str] = field(default_factory=dict)
    station_by_code_only: tuple[str, ...] = ()


def _named() -> dict[str, Column]:
    return {"ReStationName": c.squeeze("StationName")}


def _timed() -> dict[str, Column]:
    return _named() | {"TransTimeKey": c.clock_to_key("TransTime")}


def _graded(name: str) -> Callable[[], dict[str, Column]]:
    return lambda: _named() | {name: F.col(name).cast("string")}


def _fuel() -> dict[str, Column]:
    empty = c.is_zero("Volume") & c.is_zero("Amount")
    return _timed() | {
        "Grade": F.col("Grade").cast("string"),
        "ReGradeTitle": c.blank_title("GradeTitle", empty, "LUBE"),
        "YearKey": c.year_of_key("TransDateKey"),
    }


def _payment() -> dict[str, Column]:
    """System A fills absent pay and end moments; system B has none."""
    in_a = ~F.col(IS_B)
    paid = c.text_or("PAY_Time", "999999")
    ended = F.when(F.length("End_Time") > 1, c.clock_to_key("End_Time")).otherwise("999999")
    paid_key = c.without(paid, ":")
    return _timed() | {
        "PAY_Date": F.when(in_a, c.text_or("PAY_Date", "00000000")),
        "PAY_Time": F.when(in_a, paid),
        "End_Date": F.when(in_a, c.text_or("End_Date", "00000000")),
        "End_Time": F.when(in_a, ended),
        "PayTimeKey": F.when(in_a, paid_key),
        "Pay_TimeKey": F.when(in_a, paid_key.try_cast("int")),
        "END_TimeKey": F.when(in_a, ended.try_cast("int")),
    }


def _receivable() -> dict[str, Column]:
    title = F.coalesce(F.col("GradeTitle"), F.lit(""))
    empty = c.is_whole_zero("Volume") & c.is_whole_zero("Amount")
    return _timed() | {
        "GradeNumber": F.coalesce(F.col("GradeNumber").cast("string"), F.lit("0")),
        "GradeTitle": title,
        "CastLubeCode": F.when(F.col("LubeCode") == "", "0").otherwise(F.col("LubeCode")),
        "ReGradeTitle": c.blank_title(title, empty, "LUBE"),
    }


def _points() -> dict[str, Column]:
    collected = F.col("Collect_TimeStemp")
    return _timed() | {
        "Collect_Date": F.substring(collected, 1, 8),
        "Collect_Time": F.trim(F.substring_index(collected, " ", -1)),
        "YearKey": c.year_of_key("TransDateKey"),
    }


def _free() -> dict[str, Column]:
    return _named() | {"TransTimeKey": F.rpad(c.without("TransTime", ":"), 6, "0")}


_AS_PRODUCT = {PRODUCT: "ProductKey"}
RULES: dict[str, FeedRule] = {
    "TRN": FeedRule(_fuel,
                    ProductRule("Grade", "ReGradeTitle", "TRANSACTION", "TRANSACTION"), _AS_PRODUCT),
    "PMT": FeedRule(_payment),
    "LUB": FeedRule(_timed),
    "AR_TRANSACTIONS": FeedRule(
        _receivable, ProductRule("GradeNumber", "ReGradeTitle", "AR", "TRANSACTION"),
        {PRODUCT: "GradeKey", "LBAmount": "LubeAmount", "AttendantNumber": "AttendeeNumber"}),
    "DSC": FeedRule(_timed),
    "EOD_METERS": FeedRule(
        _graded("GradeNumber"),
        ProductRule("GradeNumber", "GradeTitle", "METERS", "METERS", untitled_systems=(SYSTEM_A,)), _AS_PRODUCT),
    "POINTS": FeedRule(_points),
    "REFUND": FeedRule(_timed),
    "EOD_TANKS": FeedRule(
        _graded("GradeNumber"),
        ProductRule("GradeNumber", "GradeTitle", "TANKS", "TANKS", fallback_systems=(SYSTEM_A,)), _AS_PRODUCT,
        station_by_code_only=(SYSTEM_B,)),
    "FREE": FeedRule(_free),
}


def prepare(staged: DataFrame, feed: str) -> DataFrame:
    """System flag and the feed's derived columns."""
    flagged = staged.withColumn(IS_B, F.coalesce(F.instr("FileName", SYSTEM_B) > 0, F.lit(False)))
    missing = [n for n in ("PAY_Date", "PAY_Time", "End_Date", "End_Time") if feed == "PMT" and n not in staged.columns]
    flagged = flagged.withColumns({n: F.lit(None).cast("string") for n in missing}) if missing else flagged
    return flagged.withColumns(RULES[feed].prepare())


def _system() -> Column:
    return F.when(F.col(IS_B), SYSTEM_B).otherwise(SYSTEM_A)


def _find_station(rows: DataFrame, stations: DataFrame, rule: FeedRule) -> Split:
    """By squeezed name, station code and customer; some systems send no usable name."""
    named = stations.select("StationKey", "CustomerCode", "POSCode", c.squeeze("PosName").alias("POSName")).distinct()
    full = Lookup(named, {"ReStationName": "POSName", "POSCode": "POSCode", "CustomerCode": "CustomerCode"}, ["StationKey"])
    if not rule.station_by_code_only:
        return lookup_any(rows, [full], NO_STATION)
    coded = stations.select("StationKey", "CustomerCode", "POSCode").distinct()
    by_code = F.col("__system").isin(list(rule.station_by_code_only))
    short = Lookup(coded, {"POSCode": "POSCode", "CustomerCode": "CustomerCode"}, ["StationKey"], when=by_code)
    full = Lookup(full.table, full.on, full.values, when=~by_code)
    return lookup_any(rows, [full, short], NO_STATION)


def product_maps(mapping: DataFrame, rule: ProductRule) -> tuple[DataFrame, DataFrame]:
    """Title map and station map of a feed, both systems together."""
    system, file, station = F.col("SourceName"), F.col("SourceFile"), F.col("StationKey")
    titled = mapping_table(mapping, file == rule.file, ["SourceName", "SourceKey", "SourceTitle", PRODUCT])
    usable = F.when(system.isin(list(rule.untitled_systems)), F.col("SourceTitle").isNull()).otherwise(station.isNotNull())
    placed = mapping_table(
        mapping, (file == rule.fallback_file) & system.isin(list(rule.fallback_systems)) & usable,
        ["SourceName", "SourceKey", "StationKey", PRODUCT],
    )
    return titled, placed


def noise(grade: str = "GradeNumber") -> Column:
    """Empty readings of the grade that no product is kept for."""
    zero = [c.is_zero(name) for name in ("OpenVolume", "CloseVolume", "DeliveryVolume")]
    return F.coalesce(F.col(grade).try_cast("int") == 2, F.lit(False)) & zero[0] & zero[1] & zero[2]


def load_feed(staged: DataFrame, feed: str, stations: DataFrame, mapping: DataFrame | None = None,
              drop_noise: Column | None = None, unique: bool = False, stage: bool = False) -> Split:
    """Prepared, looked-up rows of one feed; ``Error`` tells why a row is rejected.

    ``drop_noise`` replaces the feed's own predicate for rejects not worth keeping.
    ``stage`` writes the looked-up rows once, so that netting and both halves of
    the result read them instead of repeating the lookups.
    """
    rule = RULES[feed]
    rows = prepare(staged, feed).withColumn("__system", _system())
    if rule.product is None:
        split = _find_station(rows, _known_size(stations), rule)
    else:
        if mapping is None:
            raise ValueError(f"feed {feed} needs the product mapping")
        split = _find_product(rows, _known_size(stations), product_maps(mapping, rule.product), rule, unique)
    if stage:
        split = split.map(lambda frame: materialise(frame, feed.lower()))
    return _finish(split, feed, rule, drop_noise)


def _known_size(stations: DataFrame) -> DataFrame:
    """The columns a lookup needs, written once: each branch reads them, and the planner knows their size."""
    return materialise(stations.select("StationKey", "CustomerCode", "POSCode", "PosName").distinct(), "stations")


def _find_product(rows: DataFrame, stations: DataFrame, maps: tuple[DataFrame, DataFrame], rule: FeedRule, unique: bool) -> Split:
    """Station, then product by title, else by station.

    The maps are written once, as ``stations`` are.  The map by station grows with the
    stations and so may have to be shuffled together with the rows; only rows whose code
    it holds at all take part in that join, the others are decided by the title map.
    """
    code, title = rule.product.code, rule.product.title
    titled, placed = materialise(maps[0], "titled"), materialise(maps[1], "placed")
    codes = materialise(placed.select(F.col("SourceKey").alias("__code"), F.col("SourceName").alias("__name")).distinct(), "codes")
    marked = rows.join(codes, (F.col(code) == F.col("__code")) & (F.col("__system") == F.col("__name")), "left")
    by_title = Lookup(titled, {code: "SourceKey", title: "SourceTitle", "__system": "SourceName"}, [PRODUCT])
    by_station = Lookup(placed, {code: "SourceKey", "StationKey": "StationKey", "__system": "SourceName"}, [PRODUCT])
    frames = []
    for part, lookups in ((F.col("__code").isNotNull(), [by_title, by_station]), (F.col("__code").isNull(), [by_title])):
        found = _find_station(marked.filter(part).drop("__code", "__name"), stations, rule)
        frames.append(lookup_any(found.frame, lookups, NO_PRODUCT, unique).frame)
    return Split(frames[0].unionByName(frames[1]))


def _finish(split: Split, feed: str, rule: FeedRule, drop_noise: Column | None) -> Split:
    frame, loaded, others = split.frame, F.col(split.error).isNull(), None
    if feed == "TRN":
        # a fuel line without a number for its volume can't be netted; it waits in the quarantine
        unread = loaded & ~F.col(IS_B) & F.col("Volume").try_cast("decimal(15,3)").isNull()
        frame = frame.withColumn(split.error, F.when(unread, F.lit(NO_VOLUME)).otherwise(F.col(split.error)))
        net, others = net_parts(frame, ["CloseDateKey", "TransNumber", "FileKey"], "Volume", "Amount",
                                where=loaded & ~F.col(IS_B), amount_type="decimal(18,2)")
        net, others = (part.withColumn("Vat", F.lit(None).cast("decimal(18,2)")) for part in (net, others))
        frame = others.unionByName(net)
    if feed == "PMT":
        in_a = ~F.col(IS_B) & loaded
        frame = frame.withColumns({
            "PAY_Time": F.when(in_a, F.col("PayTimeKey")).otherwise(F.col("PAY_Time")),
            "End_Time": F.when(in_a, F.col("END_TimeKey").cast("string")).otherwise(F.col("End_Time")),
        }).drop("PayTimeKey", "END_TimeKey")
    if feed == "EOD_TANKS" or drop_noise is not None:
        predicate = noise() if drop_noise is None else F.coalesce(drop_noise, F.lit(False))
        kept = loaded | ~predicate
        frame, others = frame.filter(kept), None if others is None else others.filter(kept)
    return Split(frame, split.error, others).map(lambda df: df.withColumnsRenamed(dict(rule.renames)).drop("__system"))


def to_tables(split: Split, fact: T.StructType, rejects: T.StructType, feed: str) -> tuple[DataFrame, DataFrame]:
    """Conform both halves to their tables.  Rejects keep the raw column names."""
    back = {new: old for old, new in RULES[feed].renames.items() if old != PRODUCT}
    rejected = split.rejected.withColumnsRenamed(back)
    return conform_table(split.matched, fact, allow_missing=True), conform_table(rejected, rejects, allow_missing=True)


def _changed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys under which two maps differ."""
    return old.subtract(new).unionByName(new.subtract(old)).select(*keys).dropna().distinct()


def touched_by_change(rows: DataFrame, feed: str, old: tuple[DataFrame, DataFrame | None], new: tuple[DataFrame, DataFrame | None]) -> DataFrame:
    """Prepared rows with ``__hit``: whether a lookup key of the row is one under which the (stations, mapping) before and now differ.

    A product found by station is judged by its code alone, as the station may be another one now.
    """
    rule = RULES[feed]
    named = lambda stations: stations.select("StationKey", "CustomerCode", "POSCode", c.squeeze("PosName").alias("POSName")).distinct()
    changed = _changed(named(old[0]), named(new[0]), ["POSName", "POSCode", "CustomerCode"])
    sides = [(changed, {"ReStationName": "POSName", "POSCode": "POSCode", "CustomerCode": "CustomerCode"})]
    if rule.station_by_code_only:
        sides.append((_changed(named(old[0]).drop("POSName"), named(new[0]).drop("POSName"), ["POSCode", "CustomerCode"]), {"POSCode": "POSCode", "CustomerCode": "CustomerCode"}))
    if rule.product is not None:
        before = [materialise(part, "before") for part in product_maps(old[1], rule.product)]
        after = before if new[1] is old[1] else [materialise(part, "after") for part in product_maps(new[1], rule.product)]
        code, title = rule.product.code, rule.product.title
        sides.append((_changed(before[0], after[0], ["SourceKey", "SourceTitle", "SourceName"]), {code: "SourceKey", title: "SourceTitle", "__system": "SourceName"}))
        sides.append((_changed(before[1], after[1], ["SourceKey", "SourceName"]), {code: "SourceKey", "__system": "SourceName"}))
    hit = F.lit(False)
    for i, (keys, on) in enumerate(sides):
        # changed keys are written once: their true size keeps the quarantine out of an exchange if they are few
        side = materialise(keys.select(*[F.col(theirs).alias(f"__k{i}_{j}") for j, theirs in enumerate(on.values())]), "changed")
        rows = rows.join(side, [F.col(mine) == F.col(f"__k{i}_{j}") for j, mine in enumerate(on)], "left")
        hit = hit | F.col(f"__k{i}_0").isNotNull()
    return rows.withColumn("__hit", hit)


@dataclass(frozen=True)
class Replay:
    """Fact rows that a replay adds, the quarantine after it, and the quarantined rows that it looked up again."""

    loaded: DataFrame
    rejects: DataFrame
    tried: DataFrame


def replay_changed(rejects: DataFrame, ledger: DataFrame, feed: str, old: tuple[DataFrame, DataFrame | None], new: tuple[DataFrame, DataFrame | None],
                   staging: T.StructType, fact: T.StructType) -> Replay:
    """Try only those quarantined rows again whose lookup keys have changed between the ``old`` and the ``new`` (stations, mapping).

    All other rows would be rejected as they were, so they stay without being looked up;
    the result is that of a whole replay.
    """
    names = [n for n in ("FileName", "LoadDateKey", "LoadTimeKey") if n in staging.names]
    whole = slices.replay_input(rejects.withColumn("__row", F.struct(*rejects.columns)), ledger, None, names)
    kept = T.StructType([*staging, T.StructField("__row", rejects.schema)])
    rows = prepare(conform_table(whole, kept, allow_missing=True), feed)
    own = F.struct(*staging.names).alias("__own")
    marked = touched_by_change(rows.withColumn("__system", _system()).select("*", own), feed, old, new)
    marked = materialise(marked.select("__own", "__row", "__hit"), "replay")
    tried = marked.filter("__hit").select("__own.*")
    split = load_feed(tried, feed, new[0], new[1], stage=True)
    loaded, again = to_tables(split, fact, rejects.schema, feed)
    rest = marked.filter("not __hit").select("__row.*")
    return Replay(loaded, rest.unionByName(again), tried)


@dataclass(frozen=True)
class Batch:
    """Table contents after a load, the fact rows it adds, and the keys of the files it replaces."""

    fact: DataFrame
    rejects: DataFrame
    ledger: DataFrame
    split: Split
    loaded: DataFrame
    superseded: DataFrame


def run_feed(staged: DataFrame, feed: str, stations: DataFrame, mapping: DataFrame | None, fact: DataFrame,
             rejects: DataFrame, ledger: DataFrame, replay: bool = True) -> Batch:
    """Load one feed: replay its quarantine, remove what re-sent files left, load, update the ledger.

    Quarantined rows join the staging rows and the quarantine starts empty.  A
    file name that arrives again replaces every earlier key of that name.
    """
    names = staged.select("FileName").distinct()
    replayed = staged
    remaining = rejects
    if replay:
        replayed = slices.replay_input(rejects, ledger, staged, [n for n in ("FileName", "LoadDateKey", "LoadTimeKey")
                                                                 if n in staged.columns])
        # The names of replayed files are incoming names too: what they loaded before is replaced
        # only if the file itself came again, so their loaded rows stay.
        remaining = rejects.filter(F.lit(False))
    current = staged.select("FileKey").distinct()
    # few keys, written once: their true size keeps the rows they are taken from out of an exchange by file
    old = materialise(slices.keys_of_names([fact, rejects], ledger, names).join(current, "FileKey", "left_anti"), "superseded")
    if replay:
        replayed = slices.without_keys(replayed, old, ["FileKey"])
    split = load_feed(replayed, feed, stations, mapping, stage=True)
    new_fact, new_rejects = to_tables(split, fact.schema, rejects.schema, feed)
    outcome = ledgers.FeedOutcome(superseded=old, loaded=current)
    new_ledger = ledgers.apply_outcomes(ledger, [outcome])
    if replay:  # files that have left the quarantine by this load are loaded, whatever they were before
        new_ledger = ledgers.mark_replayed(new_ledger, slices.without_keys(rejects, old, ["FileKey"]), new_rejects)
    return Batch(
        fact=slices.without_keys(fact, old, ["FileKey"]).unionByName(new_fact),
        rejects=slices.without_keys(remaining, old, ["FileKey"]).unionByName(new_rejects),
        ledger=new_ledger,
        split=split,
        loaded=new_fact,
        superseded=old,
    )

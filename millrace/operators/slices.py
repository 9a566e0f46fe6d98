"""Replace, remove and replay slices of a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import stamp
from millrace.functions.conform import conform_table, distinct_keys, union_by_name
from millrace.operators.keys import all_but_latest
from millrace.operators.lookup import ERROR


def without_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not listed.  NULL keys are kept: they match nothing."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti").select(*df.columns)


def replace_slice(target: DataFrame, source: DataFrame, on: Sequence[str], allow_missing: bool = False) -> DataFrame:
    """Drop the target's slices that occur in the source, then add the source."""
    return without_keys(target, source, on).unionByName(source, allowMissingColumns=allow_missing)


def superseded_keys(ledger: DataFrame, names: DataFrame, name: str = "FileName", key: str = "FileKey") -> DataFrame:
    """Ledger rows of re-sent file names, except the newest of each name."""
    again = ledger.join(names.select(name).distinct(), name, "left_semi").select(*ledger.columns)
    return all_but_latest(again, [name], [F.coalesce(F.col(key), F.lit(0))])


def keys_of_names(tables: Sequence[DataFrame], ledger: DataFrame, names: DataFrame,
                  name: str = "FileName", key: str = "FileKey") -> DataFrame:
    """File keys in the tables that belong to any of the given file names."""
    wanted = ledger.join(names.select(name).distinct(), name, "left_semi").select(key).distinct()
    return distinct_keys([table.select(key) for table in tables], [key]).join(wanted, key, "left_semi")


@dataclass(frozen=True)
class Removal:
    fact: DataFrame
    rejects: DataFrame
    keys: DataFrame


def remove_reloaded(fact: DataFrame, rejects: DataFrame, ledger: DataFrame, names: DataFrame,
                    before_load: bool = True, name: str = "FileName", key: str = "FileKey") -> Removal:
    """Delete the rows an earlier load of the same files left behind.

    ``before_load`` removes every key of an incoming name that has rows;
    otherwise the newest key per name stays and only older ones are removed.
    """
    if before_load:
        keys = keys_of_names([fact, rejects], ledger, names, name, key)
    else:
        keys = superseded_keys(ledger, names, name, key).select(key)
    return Removal(without_keys(fact, keys, [key]), without_keys(rejects, keys, [key]), keys)


def overlapping_keys(fact: DataFrame, current: Column | int, day: str = "DateKey", key: str = "FileKey") -> DataFrame:
    """Other files that share a day with the current file.

    Both sides are reduced to distinct (file, day) pairs before they meet.
    """
    pairs = fact.select(key, day).distinct()
    days = pairs.filter(F.col(key) == current).select(day)
    return pairs.filter(F.col(key) != current).join(days, day, "left_semi").select(key).distinct()


def supersede_month_to_date(fact: DataFrame, rejects: DataFrame, ledger: DataFrame, current: Column | int,
                            category: str, subcategory: str, status: int = 6,
                            day: str = "DateKey", key: str = "FileKey") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mark files overlapping the current one and remove their rows.

    Returns ledger, fact and rejects.  As the ledger is the record of what is
    superseded, files it already marks are removed as well.
    """
    older = overlapping_keys(fact, current, day, key).select(F.col(key).alias("__older"))
    joined = ledger.join(older, F.col(key) == F.col("__older"), "left")
    kind = ledger.schema["LoadStatus"].dataType
    marked = joined.withColumn(
        "LoadStatus",
        F.when(F.col("__older").isNotNull(), F.lit(status).cast(kind)).otherwise(F.col("LoadStatus")),
    ).select(*ledger.columns)
    gone = marked.filter(
        (F.col("CategoryName") == category) & (F.col("SubCategoryName") == subcategory) & (F.col("LoadStatus") == status)
    )
    return marked, without_keys(fact, gone, [key]), without_keys(rejects, gone, [key])


def replay_input(rejects: DataFrame, ledger: DataFrame, staging: DataFrame | None = None,
                 columns: Sequence[str] = ("FileName",), key: str = "FileKey", error: str = ERROR) -> DataFrame:
    """Quarantined rows with their file's ledger columns, appended to the staging rows.

    The quarantine is empty afterwards; the load writes what is still rejected.
    """
    old = rejects.drop(error, *columns).join(ledger.select(key, *columns), key, "left")
    return old if staging is None else union_by_name([staging, conform_table(old, staging.schema, allow_missing=True)], False)


def purge_loaded(rejects: DataFrame, fact: DataFrame, reject_id: str, fact_id: str) -> DataFrame:
    """Drop quarantined rows whose id has reached the fact."""
    return without_keys(rejects, fact.select(F.col(fact_id).alias(reject_id)), [reject_id])


def split_hot_cold(df: DataFrame, day: str, as_of, hours: int = 0, legacy: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows from today on, and all others: rows before today and rows without a day.

    ``legacy`` leaves rows without a day out of both.
    """
    today, _ = stamp(as_of, hours)
    before = F.col(day) < today
    return df.filter(F.col(day) >= today), df.filter(before if legacy else before | F.col(day).isNull())


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows meeting a condition and rows failing it; undecided (NULL) rows are in neither."""
    return df.filter(condition), df.filter(~condition)

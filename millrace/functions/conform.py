"""Bring frames to a declared schema and clean their values.

Each function builds one projection, however many columns it touches.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import recode


def try_cast_columns(df: DataFrame, types: Mapping[str, T.DataType | str]) -> DataFrame:
    """Cast several columns; text that does not fit becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def derive(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add or replace several columns at once."""
    return df.withColumns(dict(exprs))


def cast_to(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast only where the types differ, so equal types leave the plan alone."""
    return column if source == target else column.try_cast(target)


def conform_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns the schema knows; keep all others and the order."""
    wanted = {field.name: field.dataType for field in schema}
    return df.select(*[
        cast_to(F.col(f"`{field.name}`"), field.dataType, wanted.get(field.name, field.dataType))
        .alias(field.name)
        for field in df.schema
    ])


def conform_table(df: DataFrame, schema: T.StructType, allow_missing: bool = False) -> DataFrame:
    """Exactly the schema's columns, types and order."""
    have = {field.name: field.dataType for field in df.schema}
    missing = [field.name for field in schema if field.name not in have]
    if missing and not allow_missing:
        raise ValueError(f"columns missing from the frame: {missing}")
    return df.select(*[
        (cast_to(F.col(f"`{field.name}`"), have[field.name], field.dataType)
         if field.name in have else F.lit(None).cast(field.dataType)).alias(field.name)
        for field in schema
    ])


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, T.StringType)


def trim_text(df: DataFrame) -> DataFrame:
    """Trim every text column."""
    return df.select(*[
        F.trim(F.col(f"`{field.name}`")).alias(field.name) if _is_text(field.dataType)
        else F.col(f"`{field.name}`")
        for field in df.schema
    ])


# What an absent value of each type is loaded as.
TYPE_DEFAULTS: dict[type[T.DataType], object] = {
    T.StringType: "",
    T.ShortType: 0,
    T.IntegerType: 0,
    T.LongType: 0,
    T.DoubleType: 0.0,
    T.DecimalType: 0,
    T.DateType: "1970-01-01",
    T.TimestampType: "1970-01-01 00:00:00",
    T.TimestampNTZType: "1970-01-01 00:00:00",
}


def fill_by_type(df: DataFrame, defaults: Mapping[type[T.DataType], object] = TYPE_DEFAULTS,
                 strict: bool = True) -> DataFrame:
    """Replace NULL by the default of the column's type.

    With ``strict`` a type without a default is refused, otherwise left alone.
    """
    def filled(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if type(field.dataType) not in defaults:
            if strict:
                raise TypeError(f"no fill value for {field.dataType.simpleString()} ({field.name})")
            return column
        default = F.lit(defaults[type(field.dataType)]).cast(field.dataType)
        return F.coalesce(column, default).alias(field.name)

    return df.select(*[filled(field) for field in df.schema])


def fill_text(df: DataFrame, default: str = "NA") -> DataFrame:
    """Replace NULL text by one label; other types stay as they are."""
    return fill_by_type(df, {T.StringType: default}, strict=False)


def fill_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a default per column."""
    kinds = {field.name: field.dataType for field in df.schema}
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value).cast(kinds[name]))
        for name, value in defaults.items()
    })


def nulls_from(df: DataFrame, sentinels: Mapping[str, object]) -> DataFrame:
    """Turn a sentinel per column back into NULL."""
    return df.withColumns({name: F.nullif(F.col(name), F.lit(value)) for name, value in sentinels.items()})


def rename_select(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Pick and rename columns in one projection."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def recode_columns(df: DataFrame, mapping: Mapping[str, str], columns: Iterable[str]) -> DataFrame:
    """Recode the values of several columns with one dictionary."""
    return df.withColumns({name: recode(name, mapping) for name in columns})


def constant_row(df: DataFrame, defaults: Mapping[str, object], values: Mapping[str, Column],
                 schema: T.StructType) -> DataFrame:
    """New dimension members: given values where known, otherwise defaults, otherwise NULL."""
    def cell(field: T.StructField) -> Column:
        default = F.lit(defaults.get(field.name)).cast(field.dataType)
        if field.name in values:
            return F.coalesce(values[field.name].cast(field.dataType), default).alias(field.name)
        return default.alias(field.name)

    return df.select(*[cell(field) for field in schema])


def union_by_name(frames: Iterable[DataFrame | None], allow_missing: bool = True) -> DataFrame | None:
    """Union any number of frames by column name; ``None`` members are skipped."""
    present = [frame for frame in frames if frame is not None]
    if not present:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), present)


def union_onto(schema: T.StructType, frames: Sequence[DataFrame]) -> DataFrame | None:
    """Union frames of different width on one declared schema."""
    return union_by_name([conform_table(frame, schema, allow_missing=True) for frame in frames], False)


def distinct_keys(frames: Iterable[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The distinct keys that occur in any of the frames.

    Each frame is reduced before the union, so only distinct keys are shuffled.
    """
    return union_by_name([frame.select(*keys).distinct() for frame in frames], False).distinct()

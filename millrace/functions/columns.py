"""Column expressions shared by the loading jobs.  All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col_of(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_timestamp(as_of: datetime | str | Column) -> Column:
    """The caller's clock as a column; jobs never read the wall clock."""
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp_ntz")


def shift(ts: ColumnOrName, hours: int) -> Column:
    """Move a timestamp to local time."""
    return col_of(ts) + F.expr(f"INTERVAL {int(hours)} HOURS")


def date_key(ts: ColumnOrName) -> Column:
    """``yyyyMMdd`` as an integer."""
    return F.date_format(col_of(ts), "yyyyMMdd").try_cast("int")


def time_key(ts: ColumnOrName) -> Column:
    """``HHmmss`` as an integer, so leading zeros are lost: 00:05:07 is 507."""
    return F.date_format(col_of(ts), "HHmmss").try_cast("int")


def month_key(ts: ColumnOrName) -> Column:
    """``yyyyMM`` as an integer."""
    return F.date_format(col_of(ts), "yyyyMM").try_cast("int")


def stamp(as_of: datetime | str | Column, hours: int = 0) -> tuple[Column, Column]:
    """Date key and time key of the job's clock, moved to local time."""
    local = shift(as_timestamp(as_of), hours)
    return date_key(local), time_key(local)


def parse_time(text: ColumnOrName, pattern: str, hours: int = 0) -> Column:
    """Text to local timestamp; text that does not fit the pattern gives NULL."""
    return shift(F.try_to_timestamp(col_of(text), F.lit(pattern)), hours)


def year_of_key(key: ColumnOrName) -> Column:
    return F.floor(col_of(key).try_cast("bigint") / 10000)


def month_of_key(key: ColumnOrName) -> Column:
    return F.floor(col_of(key).try_cast("bigint") / 100) % 100


def key_text(key_date: ColumnOrName, key_time: ColumnOrName) -> Column:
    """Date and time key as sortable text: ``yyyyMMdd`` + six-digit time."""
    return F.concat(col_of(key_date).cast("string"), F.lpad(col_of(key_time).cast("string"), 6, "0"))


def without(text: ColumnOrName, part: str) -> Column:
    """Remove every occurrence of a literal; cheaper than a regular expression."""
    return F.replace(col_of(text), F.lit(part), F.lit(""))


def squeeze(name: ColumnOrName) -> Column:
    """Remove every blank."""
    return without(name, " ")


def clock_to_key(text: ColumnOrName) -> Column:
    """``HH:mm`` text to ``HHmm00`` text."""
    return F.concat(without(text, ":"), F.lit("00"))


def text_or(text: ColumnOrName, default: str, longer_than: int = 1) -> Column:
    """Keep text longer than a length, else the default (also for NULL)."""
    value = col_of(text)
    return F.when(F.length(value) > longer_than, value).otherwise(F.lit(default))


def to_null(value: ColumnOrName, sentinel: object) -> Column:
    """Turn a sentinel back into NULL."""
    return F.nullif(col_of(value), F.lit(sentinel))


def recode(value: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep all others."""
    if not mapping:
        return col_of(value)
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), col_of(value)), col_of(value))


def same_or(value: ColumnOrName, members: list[str], label: str) -> Column:
    """Give several values one label."""
    column = col_of(value)
    return F.when(column.isin(members), F.lit(label)).otherwise(column)


def class_by_code_or_prefix(code: ColumnOrName, code_value: str, name: ColumnOrName,
                            prefix: str, hit: str, other: str) -> Column:
    """One of two labels from an exact code or the start of a trimmed name."""
    starts = F.substring(F.trim(col_of(name)), 1, len(prefix)) == prefix
    return F.when((col_of(code) == code_value) | starts, F.lit(hit)).otherwise(F.lit(other))


def is_zero(value: ColumnOrName) -> Column:
    """Zero as a number; dirty text is not zero."""
    return F.coalesce(col_of(value).try_cast("double") == 0, F.lit(False))


def is_whole_zero(value: ColumnOrName) -> Column:
    """Zero once the fraction is cut off."""
    return F.coalesce(F.abs(col_of(value).try_cast("double")) < 1, F.lit(False))


def blank_title(title: ColumnOrName, empty: Column, label: str) -> Column:
    """Label rows without a title that also carry no quantity."""
    value = col_of(title)
    return F.when((value == "") & empty, F.lit(label)).otherwise(value)


def decode_file_name(path: ColumnOrName) -> Column:
    """Last path part with its ``#`` restored (paths arrive URL-encoded).

    A part is tried only from its start and only as a whole, so the time for a path grows with its length, not with the square of its parts' lengths.
    """
    return F.replace(F.regexp_extract(col_of(path), r"(?<![^/?])([^/?]++)(?:\?.*)?$", 1), F.lit("%23"), F.lit("#"))


# The Thai single-byte charset puts U+0E01..U+0E3A and U+0E3F..U+0E5B
# at the bytes 0xA1..0xDA and 0xDF..0xFB.
_THAI_BYTES = [*range(0xA1, 0xDB), *range(0xDF, 0xFC)]
_THAI_FROM = "".join(chr(byte) for byte in _THAI_BYTES)
_THAI_TO = "".join(chr(byte - 0xA1 + 0x0E01) for byte in _THAI_BYTES)


def thai_text(latin: ColumnOrName) -> Column:
    """Thai text from a column that was read byte by byte as ISO-8859-1; plain ASCII, where every character is one byte, is left as it is."""
    text = col_of(latin)
    return F.when(F.octet_length(text) != F.length(text), F.translate(text, _THAI_FROM, _THAI_TO)).otherwise(text)


"""Statement reports: text with a preamble, a header line, tab-separated rows and a trailer."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import decode_file_name, without
from millrace.functions.conform import conform_table
from millrace.scratch import materialise


#: Bytes of reports whose lines one task writes.
TASK_BYTES = 64 << 20


def read_texts(spark: SparkSession, paths: str | Sequence[str], charset: str = "UTF-16") -> DataFrame:
    """One row per file: its name and whole text."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(decode_file_name("path").alias("FileName"), F.decode("content", charset).alias("text"))


def clean_header(cell: Column) -> Column:
    """Header name without dots and outer blanks; ``G/L`` becomes ``G_L``."""
    return F.trim(F.replace(without(cell, "."), F.lit("G/L"), F.lit("G_L")))


def report_lines(texts: DataFrame, text: str = "text", skip: int = 5, after_header: int = 0,
                 trailer: int = 0) -> DataFrame:
    """Body lines of each report with its header.

    ``skip`` lines of preamble come before the header, ``after_header`` lines
    follow it without being data, and the last ``trailer`` lines are totals.
    Adds ``header`` (cleaned names), ``line_no`` (0-based in the file) and ``cells``.
    """
    rest = [c for c in texts.columns if c != text]
    # One line break at the very end closes the last line and does not open another.
    body = F.regexp_replace(F.regexp_replace(F.col(text), r"\r\n?", "\n"), r"\n\z", "")
    split = texts.select(*rest, F.split(body, "\n", -1).alias("__lines"))
    header = F.transform(F.split(F.get("__lines", F.lit(skip)), "\t", -1), clean_header)
    lines = split.select(*rest, header.alias("header"), F.size("__lines").alias("__n"),
                         F.posexplode("__lines").alias("line_no", "__line"))
    kept = lines.filter((F.col("line_no") > skip + after_header) & (F.col("line_no") < F.col("__n") - trailer))
    return kept.select(*rest, "header", "line_no", F.split("__line", "\t", -1).alias("cells"))


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path, FileName, ``line_no`` (0-based in the file), ``line`` and ``lines`` (of the file) of UTF-8 or single-byte reports of any size.

    A file is read in as many splits as it has, never as one row.  A line's number is its place in
    its split plus the lines of the splits before it: one small row for each split.  The lines are
    written once, so that both readings of them have the same splits.  UTF-16 has no
    byte that only ends lines; such reports are read whole by :func:`read_texts`.

    A task writes the lines of many splits, about ``TASK_BYTES`` of them, so that small splits do not make as many tasks and files.
    """
    size = spark.read.format("binaryFile").load(paths).agg(F.sum("length")).first()[0] or 0
    raw = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__place"),
        F.col("value").alias("line"))
    lines = materialise(raw.coalesce(max(size // TASK_BYTES + 1, 4 * spark.sparkContext.defaultParallelism)), "lines")
    splits = lines.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first"))
    # a file's splits in order: a row for each, so no window holds lines
    order = Window.partitionBy("__file").orderBy("__block")
    before = materialise(splits.select("__file", "__block", "__first", (F.sum("__n").over(order) - F.col("__n")).alias("__before"),
                                       F.sum("__n").over(Window.partitionBy("__file")).alias("lines")), "splits")
    placed = lines.join(before, ["__file", "__block"])
    return placed.select(F.col("__file").alias("Path"), decode_file_name("__file").alias("FileName"), (F.col("__before") + F.col("__place") - F.col("__first")).cast("int").alias("line_no"), "line",
                         F.col("lines").cast("int").alias("lines"))


def body_lines(lines: DataFrame, skip: int = 5, after_header: int = 0, trailer: int = 0, line: str = "line") -> DataFrame:
    """What :func:`report_lines` gives, from the numbered lines of :func:`read_lines`; a file's header is one small row joined to its lines.

    The headers are written once, so that the planner knows how few they are and does not gather the lines of a file to meet its header.
    """
    rest = [c for c in lines.columns if c not in (line, "line_no", "lines")]
    header = lines.filter(F.col("line_no") == skip).select(*[F.col(c).alias(f"__{c}") for c in rest], F.transform(F.split(line, "\t", -1), clean_header).alias("header"))
    header = materialise(header, "headers")
    kept = lines.filter((F.col("line_no") > skip + after_header) & (F.col("line_no") < F.col("lines") - trailer))
    joined = kept.join(header, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in rest], "left")
    return joined.select(*rest, "header", "line_no", F.split(line, "\t", -1).alias("cells"))


def report_rows(lines: DataFrame, columns: Sequence[str], required: str | None = None) -> DataFrame:
    """Named cells of body lines; columns are found by header name in each report.

    An empty cell is NULL.  Lines whose ``required`` cell is NULL (blank and
    total lines) are left out.
    """
    rest = [c for c in lines.columns if c not in ("header", "cells")]

    def cell(name: str) -> Column:
        place = F.array_position("header", F.lit(name)).cast("int") - 1
        return F.nullif(F.when(place >= 0, F.get("cells", place)), F.lit("")).alias(name)

    rows = lines.select(*rest, *[cell(c) for c in columns])
    return rows if required is None else rows.filter(F.col(required).isNotNull())


def normalised(name: str) -> str:
    return re.sub(r"[^a-zA-Z0-9]", "", name).lower()


def match_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rename columns by their letters and digits alone, ignoring case, and conform them."""
    wanted = {normalised(name): name for name in schema.names}
    unknown = [c for c in df.columns if normalised(c) not in wanted]
    if unknown:
        raise ValueError(f"columns the staging table does not know: {unknown}")
    renamed = df.select(*[F.col(f"`{c}`").alias(wanted[normalised(c)]) for c in df.columns])
    return conform_table(renamed, schema, allow_missing=True)

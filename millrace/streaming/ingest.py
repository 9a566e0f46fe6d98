"""Incremental ingest: load the files that arrived since the last run."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from millrace.plans import pos_files
from millrace.sources.feeds import layout, stream_delimited


def ingest_new_files(spark: SparkSession, path: str, system: str, feed: str, progress: str,
                     load: Callable[[DataFrame, int], None], as_of, hours: int = 0) -> None:
    """Hand every new file's rows to ``load(rows, batch)`` and stop when none is left.

    ``progress`` is the stream's checkpoint folder on shared storage: after a
    failure the interrupted batch is handed over again under the same number, so
    ``load`` should replace what that batch wrote, as the slice operators do.
    """
    rows = stream_delimited(spark, path, layout(system, feed), as_of, hours)
    writer = rows.writeStream.foreachBatch(load).option("checkpointLocation", progress).trigger(availableNow=True)
    query = writer.start()
    query.awaitTermination()
    if (error := query.exception()) is not None:
        raise error


def load_arrived(spark: SparkSession, tables: pos_files.FeedTables, paths: Mapping[str, str], feed: str, stations: DataFrame, mapping: DataFrame | None,
                 progress: str, as_of, hours: int = 0) -> pos_files.State:
    """Load the files of a feed (``paths``: a folder or glob by system) that arrived since the last call, and return the tables.

    Each system is a stream of its own.  The number of a batch is kept with the rows it
    loaded, in one version, so a batch that is handed over again after a stop is loaded once.
    """
    for system, path in paths.items():
        def load(rows: DataFrame, batch: int, stream: str = f"{feed} {system}") -> None:
            pos_files.load_rows(rows.sparkSession, tables, rows, feed, stations, mapping, as_of, hours, (stream, batch))

        ingest_new_files(spark, path, system, feed, f"{progress}/{system}", load, as_of, hours)
    return pos_files.current(spark, tables)

"""Point-of-sale files of one feed: from the raw files of both systems to fact, quarantine and ledger on disk.

The fact is partitioned by the load that wrote a row.  A load writes its own partition
and nothing else of the fact; quarantine, ledger, the keys of superseded files and the
loads that no longer count are written after it, as one version.  Readers take the partitions
that the newest complete version counts and leave out the rows of superseded files, so a load
is whole or has changed nothing, wherever it stops, and is simply run again.

``compact`` takes the superseded rows off the disk later: the rows that stay are written as
the partition of a load of its own, a version counts that partition instead of the old
ones, and only then do the old ones go.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.conform import distinct_keys
from millrace.operators import ledger as ledgers
from millrace.operators.slices import without_keys
from millrace.plans import pos
from millrace.scratch import drop_frame, materialise
from millrace.sources import feeds
from millrace.sources import tables as store

LOAD = "LoadKey"
#: Keys of files whose rows in the fact no longer count; loads whose partitions no longer count; the newest batch of each stream.
REMOVED = T.StructType([T.StructField("FileKey", T.IntegerType())])
DEAD = T.StructType([T.StructField(LOAD, T.IntegerType())])
BATCHES = T.StructType([T.StructField("Stream", T.StringType()), T.StructField("Batch", T.LongType())])


@dataclass(frozen=True)
class FeedTables:
    """Where the tables of a feed are kept, and their columns."""

    root: str
    staging: T.StructType
    fact: T.StructType
    rejects: T.StructType

    @property
    def stored_fact(self) -> T.StructType:
        return T.StructType([*self.fact, T.StructField(LOAD, T.IntegerType())])


@dataclass(frozen=True)
class State:
    """Tables after the last complete load; ``fact`` has the load of each row, ``stored`` the superseded rows too."""

    number: int
    fact: DataFrame
    rejects: DataFrame
    ledger: DataFrame
    stored: DataFrame
    removed: DataFrame
    dead: DataFrame
    batches: DataFrame


def current(spark: SparkSession, tables: FeedTables) -> State:
    done = store.versions(spark, f"{tables.root}/state")
    number = done[-1] if done else 0
    state = f"{tables.root}/state/version={number}"

    def read(path: str, schema: T.StructType) -> DataFrame:
        if not number:  # no rows, and the planner knows it
            return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        return store.by_path(spark, path, schema).select(*schema.names)

    removed, dead = read(f"{state}/removed", REMOVED), read(f"{state}/dead", DEAD)
    # partition values of loads, so that their folders are never listed
    stored = read(f"{tables.root}/fact", tables.stored_fact).filter((F.col(LOAD) <= number) & ~F.col(LOAD).isin(_loads(dead)))
    return State(number, without_keys(stored, removed, ["FileKey"]), read(f"{state}/rejects", tables.rejects), read(f"{state}/ledger", ledgers.LEDGER),
                 stored, removed, dead, read(f"{state}/batches", BATCHES))


def _loads(dead: DataFrame) -> list[int]:
    return [row[0] for row in dead.select(LOAD).distinct().collect()]


def load_files(spark: SparkSession, tables: FeedTables, paths: Mapping[str, str | Sequence[str]], feed: str,
               stations: DataFrame, mapping: DataFrame | None, as_of, hours: int = 0) -> State:
    """Load the files of one feed (``paths``: by system) and return the tables afterwards.

    Every file name gets a new key; what an earlier file of the name left behind no longer
    counts, and the quarantine is tried again.  A step that fails leaves fact and
    quarantine as they were, notes the files as failed in that step, and raises its error.
    """
    listed = [path for given in paths.values() for path in ([given] if isinstance(given, str) else given)]
    raw = lambda: [feeds.read_feed(spark, path, system, feed, as_of, hours) for system, path in paths.items()]
    return _load(spark, tables, feeds.incoming_files(spark, listed), raw, feed, stations, mapping, as_of, hours)


def load_rows(spark: SparkSession, tables: FeedTables, rows: DataFrame, feed: str, stations: DataFrame, mapping: DataFrame | None, as_of,
              hours: int = 0, batch: tuple[str, int] | None = None) -> State:
    """Load rows that were read already (raw columns and lineage), as ``load_files`` does their files.

    ``batch`` names a stream and the number of its batch.  The number is part of the version
    that counts the rows, so a batch that is handed over again changes nothing.
    """
    if batch is not None:
        before = current(spark, tables)
        if not before.batches.filter((F.col("Stream") == batch[0]) & (F.col("Batch") >= batch[1])).isEmpty():
            return before
    read = materialise(rows, "batch")
    files = ledgers.parse_file_name(read.select("FileName").distinct())
    done = _load(spark, tables, files, lambda: [read], feed, stations, mapping, as_of, hours, batch)
    drop_frame(read)
    return done


def _load(spark, tables, files, raw, feed, stations, mapping, as_of, hours, batch=None) -> State:
    before = current(spark, tables)
    number = before.number + 1
    label = ledgers.FEED_LABELS.get(feed, feed)
    fresh = materialise(ledgers.reserve(before.ledger, files.filter(F.col("SubCategoryName") == label), as_of, hours), "reserved")
    ledger = ledgers.append(before.ledger, fresh)
    folder = f"{tables.root}/fact/{LOAD}={number}"
    failing, written = ledgers.STAGING_FAILED, [fresh]
    try:
        staged = materialise(feeds.clean_staging(feeds.stage_feed(raw(), ledger, feed), tables.staging), "staged")
        written.append(staged)
        failing = ledgers.LOAD_FAILED
        left = _drop_dead(spark, tables, before)
        store.drop_folder(spark, folder)  # what a load that broke off may have left
        batch_of = pos.run_feed(staged, feed, stations, mapping, before.fact.select(*tables.fact.names), before.rejects, ledger)
        store.overwrite_partitions(batch_of.loaded.withColumn(LOAD, F.lit(number)), f"{tables.root}/fact", [LOAD])
        noted = before.batches
        if batch is not None:
            noted = noted.filter(F.col("Stream") != batch[0]).unionByName(spark.createDataFrame([batch], BATCHES))
        done = {"rejects": batch_of.rejects, "ledger": batch_of.ledger, "removed": distinct_keys([before.removed, batch_of.superseded], ["FileKey"]),
                "dead": left, "batches": noted}
        _write(spark, tables, number, done)
    except Exception:
        # the partition is not counted by the version that notes the failure, whether or not it can be dropped
        dead = distinct_keys([before.dead, spark.createDataFrame([(number,)], DEAD)], [LOAD])
        _write(spark, tables, number, {"rejects": before.rejects, "ledger": ledgers.set_status(ledger, fresh, failing), "removed": before.removed,
                                       "dead": dead, "batches": before.batches})
        store.commit_version(spark, f"{tables.root}/state", number)
        raise
    store.commit_version(spark, f"{tables.root}/state", number)
    drop_frame(*written, batch_of.split.frame)  # staged and looked-up rows are in the tables now
    return current(spark, tables)


def compact(spark: SparkSession, tables: FeedTables) -> State:
    """Write the partitions that hold superseded rows anew without them; a stop leaves the tables as they were or as they will be.

    The old partitions are removed by the load or compaction after this one, so readers of
    the version before are not disturbed.
    """
    before = current(spark, tables)
    number = before.number + 1
    left = _drop_dead(spark, tables, before)
    touched = materialise(before.stored.join(before.removed, "FileKey", "left_semi").select(LOAD).distinct(), "touched")
    loads = _loads(touched)
    store.drop_folder(spark, f"{tables.root}/fact/{LOAD}={number}")
    if loads:
        store.overwrite_partitions(before.fact.filter(F.col(LOAD).isin(loads)).withColumn(LOAD, F.lit(number)), f"{tables.root}/fact", [LOAD])
    _write(spark, tables, number, {"rejects": before.rejects, "ledger": before.ledger, "removed": before.removed.limit(0),
                                   "dead": left.unionByName(touched), "batches": before.batches})
    store.commit_version(spark, f"{tables.root}/state", number)
    drop_frame(touched)
    return current(spark, tables)


def _drop_dead(spark: SparkSession, tables: FeedTables, state: State) -> DataFrame:
    """Remove the partitions that no longer count; gives those that are still there."""
    left = []
    for load in _loads(state.dead):
        folder = f"{tables.root}/fact/{LOAD}={load}"
        store.drop_folder(spark, folder)
        if store.exists(spark, folder):
            left.append((load,))
    return spark.createDataFrame(left, DEAD)


def _write(spark: SparkSession, tables: FeedTables, number: int, frames: Mapping[str, DataFrame]) -> None:
    kept = {"ledger": ledgers.PARTITIONS}
    store.write_together(spark, f"{tables.root}/state", number, {name: (df, kept.get(name, ())) for name, df in frames.items()})

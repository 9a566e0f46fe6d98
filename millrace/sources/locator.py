"""Merges into a long partitioned history that read only the partitions a delta touches.

Beside the history lies a locator: the key and the partition of every row, dealt into
buckets by a hash of the key.  A delta reads the locator's buckets of its own keys to learn
which partitions hold them, and then only those partitions and the ones its rows go to.

The locator may list a partition that a row has left, never miss one that has it: the
delta's places are added before the history is rewritten, and the history is rewritten
through its journal, so a merge that stopped is simply run again.  ``rebuild`` writes the
locator anew from the key and partition columns of the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.conform import distinct_keys
from millrace.operators.merge import upsert_full
from millrace.scratch import drop_frame, materialise
from millrace.sources import tables as store

BUCKET = "Bucket"
BUCKETS = 1024


class History:
    """A partitioned table with its locator, below one folder."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, partition_by: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.key, self.partition_by, self.buckets = spark, root, schema, key, list(partition_by), buckets
        # partition columns of a folder come last
        inner = [f for f in schema if f.name not in self.partition_by]
        self.stored = T.StructType(inner + [schema[name] for name in self.partition_by])
        self.places = T.StructType([schema[key], *[schema[name] for name in self.partition_by], T.StructField(BUCKET, T.IntegerType())])

    @property
    def path(self) -> str:
        return f"{self.root}/rows"

    @property
    def locator(self) -> str:
        return f"{self.root}/locator"

    def rows(self) -> DataFrame:
        if not store.exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return store.by_path(self.spark, self.path, self.stored).select(*self.schema.names)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _places_of(self, df: DataFrame) -> DataFrame:
        return df.select(self.key, *self.partition_by).filter(F.col(self.key).isNotNull()).withColumn(BUCKET, self._bucket())

    def known_places(self, delta: DataFrame) -> DataFrame:
        """Places the locator lists for the delta's keys; only the buckets of those keys are read."""
        if not store.exists(self.spark, self.locator):
            return self.spark.createDataFrame([], self.places)
        keys = self._places_of(delta).select(self.key, BUCKET).distinct()
        listed = store.by_path(self.spark, self.locator, self.places).select(*self.places.names)
        return store.in_partitions(listed, keys.select(BUCKET).distinct()).join(keys, [self.key, BUCKET], "left_semi").select(*self.places.names)

    def merge(self, delta: DataFrame) -> None:
        """Full-row upsert by the key: a known row is replaced, wherever it lies, others are added."""
        delta = materialise(delta.select(*self.schema.names), "delta")
        known = materialise(self.known_places(delta), "places")
        own = self._places_of(delta)
        same = [own[c].eqNullSafe(known[c]) for c in self.places.names]
        store.write(own.join(known, same, "left_anti"), self.locator, "append", [BUCKET])
        touched = materialise(distinct_keys([known, delta], self.partition_by), "touched")
        if store.exists(self.spark, self.path):
            store.rewrite_partitions(self.spark, self.path, touched, self.partition_by,
                                     lambda part: upsert_full(part.select(*self.stored.names), delta, [self.key], action=None), self.stored)
        else:
            store.write(upsert_full(self.rows(), delta, [self.key], action=None), self.path, "overwrite", self.partition_by)
        drop_frame(delta, known, touched)

    def rebuild(self) -> None:
        """The locator without places that rows have left."""
        fresh = materialise(self._places_of(self.rows()).distinct(), "locator")
        store.write(fresh, self.locator, "overwrite", [BUCKET])
        drop_frame(fresh)

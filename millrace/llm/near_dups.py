"""Near copies among documents: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

Signatures.  Each shingle of a document walks through a random permutation of the
signature's slots; in round j it offers the value j + r, r uniform below 1, to the
slot it stands on.  A value of an earlier round is smaller than any later one, so a
slot is settled in the first round that reaches it, and a document stops as soon as
all its slots are settled: after few rounds where it has many shingles.

Links.  Documents of equal shingle sets are one class from the start.  Classes that
agree in all values of a band share a bucket.  First all members of a bucket are
compared with its hub, the member that shares most places with others.  Then, in
buckets whose members still lie in different groups, those outside the largest group
visit all members: buckets with the same largest group are one arena, its members are
dealt into chunks, and a visitor is compared with a whole chunk by an inverted index,
so that only links leave the task, never pairs.  No two members of a bucket stay
uncompared unless they are in one group already, and a bucket of many copies costs
its size, not its square.  Each comparison counts the common shingles of full sets.

Groups.  Smallest label of the neighbours, then label of the label, until nothing
changes; always as joins over tables in the shared folder.

Defined results: texts that are null, empty or white space have no shingle and are
linked with nothing; a row without a key is in no group (component null, not kept);
rows that repeat a key share its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.runtime import Workspace, flat_bytes, ship, slices
from millrace.llm.shingles import mix, ranges, shingle_hashes

#: Bands and rows of a band: a pair at 0.8 shares no bucket with probability 3e-6.
BANDS, ROWS = 24, 4
#: Members of an arena that a visitor is compared with at once.
CHUNK = 256
_PART = 1 << 20
_EMPTY = np.uint64((1 << 64) - 1)
_GOLD = 0x9E3779B97F4A7C15


def signatures(hashes: np.ndarray, at: np.ndarray, slots: int = BANDS * ROWS) -> np.ndarray:
    """SuperMinHash signature of each text's shingles (rows without shingles stay unset)."""
    n = len(at) - 1
    out = np.full(n * slots, _EMPTY, np.uint64)
    owner = np.repeat(np.arange(n), np.diff(at))
    items = hashes
    place = np.broadcast_to(np.arange(slots, dtype=np.uint8), (len(items), slots)).copy()
    row = np.arange(len(items))
    for j in range(slots):
        if not len(items):
            break
        random = mix(items + np.uint64((_GOLD * (j + 1)) & ((1 << 64) - 1)))
        k = j + (((random & np.uint64(0xFFFFFF)) * np.uint64(slots - j)) >> np.uint64(24)).astype(np.int64)
        slot = place[row, k]
        place[row, k] = place[:, j]
        key = owner * slots + slot
        value = np.uint64(j << 40) | (random >> np.uint64(24))
        better = value < out[key]
        np.minimum.at(out, key[better], value[better])
        open_text = (out.reshape(n, slots) == _EMPTY).any(axis=1)
        alive = open_text[owner]
        if not alive.all():
            items, owner, place = items[alive], owner[alive], place[alive]
            row = np.arange(len(items))
    return out.reshape(n, slots)


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band, different between bands."""
    rows = signature.shape[1] // bands
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(mix(np.arange(bands, dtype=np.uint64) + np.uint64(77)), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix(key ^ parts[:, :, r]) * np.uint64(_GOLD)
    return key


def _described(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Of each row: set size, a 128-bit key of the set, and the band keys."""
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_shingles", "set_a", "set_b", "bands"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in slices(whole, text, _PART):
                hashes, at = shingle_hashes(*flat_bytes(part.column(1)), width)
                sets = [np.unique(hashes[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                counts = np.array([len(s) for s in sets])
                ends = np.concatenate(([0], np.cumsum(counts)))
                items = np.concatenate(sets)
                sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(items + np.uint64(c))))) for c in (11, 23)]
                keys = band_keys(signatures(items, ends)).view(np.int64)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1) * BANDS, pa.int32()), pa.array(keys.ravel(), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), *[pa.array((s[ends[1:]] - s[ends[:-1]]).view(np.int64)) for s in sums], bands],
                    names=names)

    return docs.select(key, text).mapInArrow(batches, f"`{key}` {kind}, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>")


def _sets(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """The distinct shingle hashes of each row."""
    kind = docs.schema[key].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in slices(whole, text, _PART):
                hashes, at = shingle_hashes(*flat_bytes(part.column(1)), width)
                sets = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                ends = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
                shingles = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets), pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), shingles], names=["rep", "shingles"])

    return docs.select(key, text).mapInArrow(batches, f"rep {kind}, shingles array<bigint>")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough.  A ``b`` of many pairs has its set copied for each CHUNK of them, so that no task has them all."""
    copies = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("copies"))
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("set_a"))
    right = (sets.select(F.col("rep").alias("b"), F.col("shingles").alias("set_b")).join(copies, "b")
             .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))).drop("copies"))
    dealt = pairs.join(copies.filter("copies > 1"), "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), F.coalesce("copies", F.lit(1))).alias("copy"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    both = F.size("set_a") + F.size("set_b") - common
    return dealt.join(left, "a").join(right, ["b", "copy"]).filter(100 * common >= percent * both).select("a", "b").distinct()


def _visited(visitors: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of a visitor and a member of the same place whose full sets are alike enough; both have (place, rep)."""
    kind = sets.schema["rep"].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, own, held, index = None, [], [], None
        for part in parts:
            left, right = [], []
            rows = zip(*[part.column(i).to_pylist() for i in range(3)], part.column(3), strict=True)
            for at, visits, rep, shingles in rows:
                found = shingles.values.to_numpy(zero_copy_only=False)
                if at != place:
                    place, own, held, index = at, [], [], None
                if not visits:
                    own.append(rep)
                    held.append(found)
                    continue
                if not own:
                    continue
                if index is None:
                    sizes = np.array([len(x) for x in held])
                    flat = np.concatenate(held)
                    order = np.argsort(flat, kind="stable")
                    keys, first, times = np.unique(flat[order], return_index=True, return_counts=True)
                    index = sizes, np.repeat(np.arange(len(own)), sizes)[order], keys, first, times
                sizes, owner, keys, first, times = index
                spot = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                spot = spot[keys[spot] == found]
                common = np.bincount(owner[ranges(first[spot], times[spot])], minlength=len(own))
                for i in np.flatnonzero(100 * common >= percent * (sizes + len(found) - common)).tolist():
                    if own[i] != rep:
                        left.append(min(own[i], rep))
                        right.append(max(own[i], rep))
            kinds = part.schema.field(2).type
            yield pa.RecordBatch.from_arrays([pa.array(left, kinds), pa.array(right, kinds)], names=["a", "b"])

    both = members.select("place", F.lit(False).alias("visits"), "rep").union(visitors.select("place", F.lit(True).alias("visits"), "rep"))
    rows = both.join(sets, "rep").select("place", "visits", "rep", "shingles")
    return rows.repartition("place").sortWithinPartitions("place", "visits").mapInArrow(batches, f"a {kind}, b {kind}").distinct()


def connected(edges: DataFrame, work: Workspace) -> DataFrame:
    """``node`` and ``label``, the smallest node of its connected component, for each end of an edge (a, b)."""
    both = work.put(edges.union(edges.select("b", "a")).distinct().toDF("node", "next"), "graph")
    labels = work.put(both.groupBy("node").agg(F.least("node", F.min("next")).alias("label")), "labels0")
    step = 0
    while True:
        step += 1
        offered = both.join(labels.toDF("next", "offer"), "next").groupBy("node").agg(F.min("offer").alias("offer"))
        nearer = labels.join(offered, "node", "left").select("node", "label", F.least("label", F.coalesce("offer", "label")).alias("new"))
        jump = labels.toDF("new", "far")
        found = nearer.join(jump, "new", "left").select("node", "label", F.least("new", F.coalesce("far", "new")).alias("new"))
        moved = work.put(found, f"labels{step % 2 + 1}")
        changed = not moved.filter("new <> label").isEmpty()
        labels = moved.select("node", F.col("new").alias("label"))
        if not changed:
            return labels


def components(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's key, n_shingles (its set's size), component_id (smallest key of its group) and kept (it is that key).

    Documents are linked when 100 * common >= percent * all shingles of both.
    """
    spark = ship(docs.sparkSession)
    work = Workspace(spark, "near")
    rows = work.put(_described(docs, key, text, width), "described")
    own = ["n_shingles", "set_a", "set_b"]
    classes = work.put(
        rows.filter(F.col("n_shingles") > 0).filter(F.col(key).isNotNull()).groupBy(*own)
        .agg(F.min(key).alias("rep"), F.first("bands").alias("bands")), "classes")
    members = classes.select("rep", F.explode("bands").alias("bucket"))
    met = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = work.put(members.join(met, "bucket"), "shared")
    degree = shared.groupBy("rep").agg(F.sum("size").alias("degree"))
    wanted = work.put(degree, "wanted")
    sets = work.put(_sets(docs.select(key, text).join(wanted, F.col(key) == F.col("rep"), "left_semi"), key, text, width), "sets")
    hubs = shared.join(wanted, "rep").groupBy("bucket").agg(F.max_by("rep", F.struct("degree", F.xxhash64("rep"), "rep")).alias("hub"))
    pairs = shared.join(hubs, "bucket").filter("rep <> hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    edges = work.put(_linked(pairs, sets, percent), "edges")
    labels = work.put(connected(edges, work), "groups0")
    here = work.put(shared.join(labels, F.col("rep") == F.col("node"), "left").select("bucket", "rep", F.coalesce("label", "rep").alias("label")), "here")
    # buckets in several groups, each with its largest group
    per = here.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("m"))
    arenas = per.groupBy("bucket").agg(F.max_by("label", F.struct("m", "label")).alias("arena"), F.count(F.lit(1)).alias("groups")).filter("groups > 1")
    inside = work.put(here.join(arenas.select("bucket", "arena"), "bucket").select("arena", "rep", "label").distinct(), "inside")
    # members and strays are both dealt into chunks; a place is a chunk of members with a chunk of strays
    is_stray = (F.col("label") != F.col("arena")).cast("int")
    chunks = inside.groupBy("arena").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"), F.ceil(F.sum(is_stray) / CHUNK).alias("guests"))
    dealt = inside.join(chunks, "arena").filter("guests > 0")
    place = lambda i, j: F.concat_ws("-", "arena", i, j).alias("place")
    own_chunk = lambda seed, n: F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    strays = dealt.filter("label <> arena").select("arena", "rep", own_chunk(1, "guests").alias("j"), each("chunks").alias("i"))
    hosts = dealt.select("arena", "rep", own_chunk(2, "chunks").alias("i"), each("guests").alias("j"))
    more = work.put(_visited(strays.select(place("i", "j"), "rep"), hosts.select(place("i", "j"), "rep"), sets, percent), "more")
    if not more.isEmpty():
        at = labels.toDF("_n", "_l")
        lifted = (more.join(at.toDF("a", "_a"), "a", "left").join(at.toDF("b", "_b"), "b", "left")
                  .select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).filter("a <> b").distinct())
        merged = work.put(connected(work.put(lifted, "lifted"), work).toDF("label", "top"), "merged")
        fresh = merged.join(labels.select("label"), "label", "left_anti").toDF("node", "label")
        labels = work.put(labels.join(merged, "label", "left").select("node", F.coalesce("top", "label").alias("label")).union(fresh), "groups1")
    top = classes.select(*own, "rep").join(labels, F.col("rep") == F.col("node"), "left").select(*own, F.coalesce("label", "rep").alias("rep"))
    top = work.put(top, "groups")
    work.drop(*[name for name in work.paths if name not in ("described", "groups")])
    component = F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col(key))
    return (rows.select(key, *own).join(top, own, "left")
            .select(key, "n_shingles", F.when(F.col(key).isNotNull(), component).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False))))


def first_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents with the smallest key of their group, and all rows without a key; columns as they were."""
    others = components(docs, width, percent).filter(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)

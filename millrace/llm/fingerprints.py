"""Threshold-scaled fingerprints of documents.

A fingerprint keeps every five-word shingle hash below a fixed fraction of the
64-bit range, so the fingerprint of a union is the union of fingerprints, and the
share of a small document inside a large one can be estimated whatever their sizes.
The fraction is large, as a text of few shingles has few hashes below it: the estimate's
error falls with the root of their number (README has it by length).
A text none of whose hashes lies below keeps its smallest hash instead, so that it
differs from other such texts; with another's kept hashes it has nothing in common, so
its likeness to those is 0 whatever they share.  A merge drops such a stand-in as soon as a
kept hash is there.

Defined results: null and empty texts, and texts of white space only, have the
empty fingerprint; likeness is 1 for two empty fingerprints, 0 for one; a text of any length is read
whole; rows that repeat a key follow one another in the order of a hash of their texts (rows of one key, and those without, lie in one
block); an empty table gives an empty one.  ``fingerprint`` gives the hashes as an array of long; the text form of the query
takes 16 digits for each, about as much as the text itself at SCALE 2.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.runtime import flat_bytes, ship, slices
from millrace.llm.shingles import shingle_hashes

WIDTH = 5
#: One hash in so many is kept.
SCALE = 2
#: Rows in a block of neighbouring documents, and the most blocks (their first ids are known to every task).
BLOCK_ROWS, MAX_BLOCKS = 512, 65_536
_PART = 2 << 20


def sketches(texts: pa.Array, scale: int = SCALE, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted fingerprint of each text."""
    hashes, at = shingle_hashes(*flat_bytes(texts), width)
    below = hashes < np.uint64((1 << 64) // scale if scale > 1 else (1 << 64) - 1)
    kept = np.concatenate(([0], np.cumsum(below)))[at]
    chosen = hashes[below]
    out = []
    for i in range(len(at) - 1):
        part = np.unique(chosen[kept[i]:kept[i + 1]])
        if not len(part) and at[i + 1] > at[i]:
            part = hashes[at[i]:at[i + 1]].min(keepdims=True)
        out.append(part)
    return out


def merged(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The fingerprint of two documents' shingles together."""
    both = np.union1d(a, b)
    below = both[both < np.uint64((1 << 64) // scale)]
    return below if len(below) else both[:1]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common shingles among all shingles of both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has too; 1 for an empty ``a``."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def to_text(sketch: Iterable[int]) -> str:
    """Sixteen hexadecimal digits for each hash, in order."""
    return np.asarray(sketch, dtype=">u8").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), dtype=">u8").astype(np.uint64)


def fingerprint(docs: DataFrame, text: str = "text", into: str = "fingerprint", scale: int = SCALE) -> DataFrame:
    """``docs`` with its fingerprint as a sorted array of signed 64-bit hashes; a column of that name is replaced."""
    ship(docs.sparkSession)
    keep = [*[c for c in docs.columns if c not in (into, text)], text]
    source = docs.select(*[f"`{c}`" for c in keep])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in slices(whole, text, _PART):
                made = pa.array([s.astype(np.int64).tolist() for s in sketches(part.column(len(keep) - 1), scale)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*keep, into])

    return source.mapInArrow(batches, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema] + [f"`{into}` array<bigint>"]))


def with_neighbour(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The texts dealt into blocks of neighbouring keys, in order within a task, each block followed by the row after it.

    Columns: block, guest (that following row), key, text.  The first row of all
    follows the last block.  A null key counts as smaller than all others; rows of
    equal keys stand in the order of a hash of their texts.  The bounds of the
    blocks are keys at even ranks, found in one pass over the key column.
    """
    least = -(1 << 63)
    rows = docs.select(F.col(key), F.col(text), F.coalesce(F.col(key).cast("bigint"), F.lit(least)).cast("double").alias("_at"))
    n = rows.count()
    blocks = min(MAX_BLOCKS, max(1, n // BLOCK_ROWS))
    found = rows.stat.approxQuantile("_at", [i / blocks for i in range(blocks)], 1 / (4 * blocks)) if n else []
    smallest = rows.agg(F.min("_at")).first()[0] if n else float(least)
    bounds = sorted({smallest, *found})
    splits = [-float("inf"), *bounds, float("inf")]  # nothing lies before the smallest key
    dealt = Bucketizer(splits=splits, inputCol="_at", outputCol="_block", handleInvalid="error").transform(rows)
    block = F.col("_block").cast("int") - 1
    opens = F.col("_at") == F.element_at(F.lit(bounds), block + 1)
    before = F.when(block == 0, F.lit(len(bounds) - 1)).otherwise(block - 1)
    own = F.struct(block.alias("block"), F.lit(False).alias("guest"))
    places = F.when(opens, F.array(own, F.struct(before.alias("block"), F.lit(True).alias("guest")))).otherwise(F.array(own))
    spread = dealt.select(F.explode(places).alias("_p"), key, text).select("_p.block", "_p.guest", key, text)
    return spread.repartition("block").sortWithinPartitions("block", "guest", F.col(key).asc_nulls_first(), F.xxhash64(text))


def edited_fingerprints(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness; one row for each document.

    The edited text has its last floor(n / 4) code points replaced by the first as
    many (or all) of the next document's text in ascending doc_id, which for the
    last document is the first.
    """
    ship(docs.sparkSession)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "kept_hashes", "contained_edited"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row whose next one has not come yet: block, key, text, sketch
        for whole in parts:
            for part in slices(whole, "text", _PART):
                blocks, guests, keys = (part.column(i).to_pylist() for i in range(3))
                texts = [x or "" for x in part.column(3).to_pylist()]
                prints = sketches(part.column(3), scale)
                ready = []
                for block, guest, key, text, sketch in zip(blocks, guests, keys, texts, prints, strict=True):
                    if held is not None and held[0] == block:
                        ready.append((*held[1:], text, sketch))
                        held = None if guest else (block, key, text, sketch)
                    elif not guest:
                        held = (block, key, text, sketch)
                if not ready:
                    continue
                changed = [t[:len(t) - len(t) // 4] + after[:len(t) // 4] for _, t, _, after, _ in ready]
                new = sketches(pa.array(changed, pa.large_string()), scale)
                rows = [(k, len(t), hashlib.sha256(e.encode("utf-8")).hexdigest(), to_text(s), to_text(c), likeness(s, c),
                         likeness(s, following), len(s), containment(s, c))
                        for (k, t, s, _, following), e, c in zip(ready, changed, new, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*rows, strict=True), TYPES, strict=True)], names=names)

    return with_neighbour(docs).mapInArrow(batches, (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, kept_hashes bigint, contained_edited double"))


TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.float64()]

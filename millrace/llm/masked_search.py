"""Ranked lexical search of a query set over all documents, by presence masks.

A term is a longest run of letters, digits and characters beyond ASCII, A-Z in lower case.  A term
weighs ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))``; a document of n terms has
``m = 75 + (25 n N) div L``, and each query term adds ``w * ((10^9 tf) div (1000 tf + 12 m))``.

Texts are read once: each document leaves the terms that a query may hold (a bitmap of
fixed size, of the hashes of all query terms, tells which; the join on terms later drops the
others) with their counts.  Document frequencies come from that table.  Queries are then dealt
into blocks of bounded size; each block is sent to all tasks and reads the table once.

In a task, documents are taken in blocks.  Each query term has a bitmap over a block's
documents.  For a query, the bitmaps of its terms are turned into each document's mask of matched terms;
documents are grouped by mask, and a mask's highest possible score is the sum over its terms of
the weight times the best part any document of the block has.  Masks are evaluated by
descending highest score, some at a time, until the next one is below the k-th score met by this task so
far: what is left can't enter.  A mask that could just equal it is evaluated, as a tie goes to the smaller key.
Each task hands on its k best of each query.

Defined results: null and empty texts match nothing and count in neither N nor L; a null key ranks after all
others of its score; query rows that repeat in key and text count once, other texts of one key are queries of their own; queries without
known terms have no rows; very long texts are counted in pieces; empty tables give an empty one; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.runtime import Workspace, ship, slices
from millrace.llm.terms import LETTERS_AND_DIGITS, count_terms

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bits of the bitmap of query terms, a power of two.
FILTER = 1 << 20
#: Query terms in a block of queries that is sent to the tasks, about.
BLOCK_TERMS = 20_000
#: Documents in a block of a task, and bytes of text read at once.
DOCUMENTS, BATCH = 4096, 1 << 20


def matching_terms(docs: DataFrame, bits: bytes, text: str, key: str) -> DataFrame:
    """(doc_id, n, terms, counts) of each document with a term: those of its terms that are in the bitmap."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in slices(whole, "body", BATCH):
                keys, sizes, terms, counts = [], [], [], []
                for k, body in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    found = count_terms(body.as_buffer().to_pybytes() if body.is_valid else b"", LETTERS_AND_DIGITS)
                    if found:
                        own = [t for t in found if bits[(h := zlib.crc32(t) & (FILTER - 1)) >> 3] >> (h & 7) & 1]
                        keys.append(k)
                        sizes.append(found.total())
                        terms.append(own)
                        counts.append([found[t] for t in own])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, part.schema.field(0).type), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                     pa.array(counts, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"doc_id {kind}, n bigint, terms array<string>, counts array<bigint>")


@dataclass
class Best:
    """The k best documents of a query so far, as (-score, key is null, key)."""

    k: int
    rows: list[tuple] = field(default_factory=list)

    @property
    def least(self) -> int:
        """Scores below this can't enter; a score of 0 never does."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, keys: list) -> None:
        some = np.flatnonzero(scores >= self.least)
        self.rows = sorted([*self.rows, *[(-int(scores[i]), keys[i] is None, keys[i] or 0) for i in some]])[:self.k]


class Documents:
    """A block of documents: entries (term, count) by document, and a bitmap of documents for each term that occurs."""

    def __init__(self, part: pa.RecordBatch, places: dict[str, int], n_docs: int, n_terms: int):
        self.keys = part.column(0).to_pylist()
        listed, size = part.column(2), len(self.keys)
        coded = listed.flatten().dictionary_encode()
        place = np.array([places.get(t, -1) for t in coded.dictionary.to_pylist()], np.int64)
        term = place[coded.indices.to_numpy()] if len(place) else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(size), np.diff(listed.offsets.to_numpy()))
        tf = part.column(3).flatten().to_numpy()
        m = np.array([75 + 25 * n * n_docs // n_terms for n in part.column(1).to_pylist()], np.int64)
        known = term >= 0
        self.term, doc, tf = term[known], doc[known], tf[known]
        self.part = 10**9 * tf // (1000 * tf + 12 * m[doc])
        self.at = np.searchsorted(doc, np.arange(size + 1))
        self.terms, row = np.unique(self.term, return_inverse=True)
        self.best = np.zeros(len(self.terms), np.int64)
        np.maximum.at(self.best, row, self.part)
        self.bitmaps = np.zeros((len(self.terms), (size + 7) // 8), np.uint8)
        order = np.argsort(row, kind="stable")
        starts = np.searchsorted(row[order], np.arange(len(self.terms) + 1))
        for first in range(0, len(self.terms), 1024):
            last = min(first + 1024, len(self.terms))
            some = order[starts[first]:starts[last]]
            flags = np.zeros((last - first, size), bool)
            flags[row[some] - first, doc[some]] = True
            self.bitmaps[first:last] = np.packbits(flags, axis=1)

    def masks(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct masks of matched terms (one row of bits each) and each document's mask."""
        size = len(self.keys)
        packed = np.packbits(np.unpackbits(self.bitmaps[rows], axis=1, count=size), axis=0)
        wide = np.zeros((size, -(-len(packed) // 8) * 8), np.uint8)
        wide[:, :len(packed)] = packed.T
        words = wide.view(np.uint64)
        group = np.zeros(size, np.int64)
        for j in range(words.shape[1]):
            own = np.unique(words[:, j], return_inverse=True)[1]
            group = np.unique(group * size + own, return_inverse=True)[1]
        first = np.zeros(int(group.max()) + 1, np.int64)
        first[group] = np.arange(size)
        return np.unpackbits(packed[:, first], axis=0, count=len(rows)).T, group

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores; ``weights`` has an entry for each term of the query block."""
        lengths = self.at[docs + 1] - self.at[docs]
        starts = np.concatenate(([0], np.cumsum(lengths)))
        entry = np.arange(starts[-1]) + np.repeat(self.at[docs] - starts[:-1], lengths)
        sums = np.concatenate(([0], np.cumsum(weights[self.term[entry]] * self.part[entry])))
        return sums[starts[1:]] - sums[starts[:-1]]

    def search(self, terms: np.ndarray, values: np.ndarray, best: Best, weights: np.ndarray) -> int:
        """Add this block's documents to ``best``; gives the number of masks that were evaluated."""
        there = np.isin(terms, self.terms)
        rows = np.searchsorted(self.terms, terms[there])
        highest = values[there] * self.best[rows]
        if int(highest.sum()) < best.least:
            return 0
        masks, group = self.masks(rows)
        bound = masks.astype(np.int64) @ highest
        order = np.argsort(-bound, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by_mask = np.argsort(place[group], kind="stable")  # documents by descending bound of their mask
        ends = np.cumsum(np.bincount(place[group], minlength=len(order)))
        weights[terms] = values
        done, step = 0, 4
        while done < len(order) and bound[order[done]] >= best.least:
            stop = min(done + step, int(np.searchsorted(-bound[order], -best.least, "right")))
            docs = by_mask[ends[done - 1] if done else 0:ends[stop - 1]]
            best.add(self.scores(docs, weights), [self.keys[i] for i in docs])
            done, step = stop, 2 * step
        weights[terms] = 0
        return done


def _found(table: DataFrame, block: list, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): each task's k best of each query of a block."""
    names = sorted({t for row in block for t in row.terms})
    places = {t: i for i, t in enumerate(names)}
    plan = [(row.item, np.array([places[t] for t in row.terms], np.int64), np.array(row.values, np.int64)) for row in block]
    sent = table.sparkSession.sparkContext.broadcast((places, plan))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, plan = sent.value
        best = [Best(k) for _ in plan]
        weights = np.zeros(len(places), np.int64)
        kind = None
        for whole in parts:
            kind = whole.schema.field(0).type
            for at in range(0, whole.num_rows, DOCUMENTS):
                docs = Documents(whole.slice(at, DOCUMENTS), places, n_docs, n_terms)
                for (_, terms, values), own in zip(plan, best, strict=True):
                    docs.search(terms, values, own, weights)
        if kind is not None:
            rows = [(item, None if null else key, -score) for (item, _, _), own in zip(plan, best, strict=True) for score, null, key in own.rows]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.int64())],
                                             names=["item", "doc_id", "score"])

    return table.mapInArrow(batches, f"item bigint, doc_id {table.schema['doc_id'].dataType.simpleString()}, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 20, text: str = "text", key: str = "doc_id", query: str = "text", query_key: str = "item_id") -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents of each query, with a score above 0."""
    spark = ship(docs.sparkSession)
    work = Workspace(spark, "search")
    asked = work.put(items.select(F.col(f"`{query_key}`").alias("item_id"), F.col(f"`{query}`").alias("body")).distinct().withColumn("item", F.monotonically_increasing_id()), "queries")
    lower = F.translate("body", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    asked_terms = asked.select("item", F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))
    bits = bytearray(FILTER // 8)
    # at most FILTER numbers, however many queries there are
    for (h,) in asked_terms.select((F.crc32("term") % FILTER).cast("int").alias("h")).distinct().collect():
        bits[h >> 3] |= 1 << (h & 7)

    table = work.put(matching_terms(docs, bytes(bits), text, key), "terms")
    n_docs, n_terms = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = table.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")))
    weighted = asked_terms.join(held, "term").select("item", "term", (F.col("times") * weight).alias("value")).filter("value > 0")
    plans = work.put(weighted.groupBy("item").agg(F.collect_list("term").alias("terms"), F.collect_list("value").alias("values")), "plans")
    total = plans.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = -(-total // BLOCK_TERMS)
    found = [_found(table, plans.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect(), n_docs, n_terms, k) for b in range(blocks)]
    if not found:
        return spark.createDataFrame([], f"item_id {asked.schema['item_id'].dataType.simpleString()}, rank int, doc_id {table.schema['doc_id'].dataType.simpleString()}, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

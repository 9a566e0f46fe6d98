"""Exact search for the highest inner products by a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it.  By the triangle
inequality a vector x of a pivot's cell is at least |d(q, p) - d(x, p)| away from a
query q, so its inner product is at most (|q|^2 + |x|^2 - that^2) / 2.  Cells are cut
into annuli of about equal numbers of rows (and annuli of equal distances by a hash),
a query visits the annuli whose bound reaches the least score it needs, and inside
one it expands from its own distance outwards, stripe by stripe, until the bound
falls below its k-th score.

Pivots are chosen from at most SAMPLE vectors; the same sample gives each query its
first bound.  Every vector is indexed, and the result is exact whatever the sample.

Defined results: vectors that are null or hold null or non-finite components take no
part, as rows without an id; shorter vectors count as followed by zeros; ties go to
the smaller id; a query has all candidates if there are fewer than k.  Rows that repeat an id
are candidates of their own; as queries they are one, whose candidates are ranked with the scores of all its rows.
An empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.runtime import Workspace, ship

#: Bound of the sample that pivots come from, and the most pivots and annuli (their bounds are known to every task).
SAMPLE, PIVOTS, ANNULI = 2048, 64, 16_384
#: Rows of an annulus, and rows of a stripe.
LEAST_ROWS, MOST_ROWS, STRIPE = 256, 8192, 512


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of 64-bit integers, padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    within = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[owner, within] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in floating point where every sum fits, else in integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x, y = a.astype(np.float64), b.astype(np.float64)
    return np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T))


def spread_out(sample: np.ndarray, n: int) -> np.ndarray:
    """Pivots: each next one is the farthest from those before, moved to the mean of its nearest rows."""
    chosen = [0]
    near = distances(sample, sample[:1])[:, 0]
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(sample, sample[chosen[-1:]])[:, 0])
    owner = distances(sample, sample[chosen]).argmin(1)
    return np.array([np.rint(sample[owner == i].mean(0)) if (owner == i).any() else sample[c] for i, c in enumerate(chosen)]).astype(np.int64)


def reach(score_needed: np.ndarray, q_norm: np.ndarray, x_norm: np.ndarray | float) -> np.ndarray:
    """How far |d(q, p) - d(x, p)| may be for a score to be reached; a little more, for rounding."""
    return np.sqrt(np.maximum(0, q_norm + x_norm - 2 * score_needed)) * (1 + 1e-9) + 1e-3


def scaled(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * component) as whole numbers, of the vectors that take part."""
    x = F.col("v")
    whole = vectors.select(F.col(key).cast("bigint").alias("id"), F.transform(vector, lambda c: c.cast("double")).alias("v")).filter(x.isNotNull() & F.col("id").isNotNull())
    sound = whole.filter(~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    return sound.select("id", F.transform(x, lambda c: F.floor(c * scale)).alias("v"))


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k highest scores; queries are the ids divisible by ``every``."""
    spark = ship(vectors.sparkSession)
    work = Workspace(spark, "topk")
    rows = scaled(vectors, key, vector, scale)
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    share = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < 1e6 * SAMPLE / max(1, n)
    drawn = rows.filter(share).limit(SAMPLE).collect() or rows.limit(1).collect()
    drawn.sort(key=lambda r: r["id"])
    known = np.array([r["id"] for r in drawn], np.int64)
    sample = matrix(pa.array([r["v"] for r in drawn], pa.list_(pa.int64())), width)
    pivots = spread_out(sample, max(1, min(PIVOTS, int(n ** 0.5) // 8))) if len(sample) else np.zeros((1, width), np.int64)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), width)
            far = distances(x, pivots)
            cell = far.argmin(1) if len(x) else np.zeros(0, np.int64)
            norm = (x.astype(np.float64) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(x)), cell]), pa.array(norm)],
                                             names=["id", "v", "cell", "far", "norm"])

    index = work.put(rows.mapInArrow(keyed, "id bigint, v array<bigint>, cell int, far double, norm double"), "index")
    size = max(MOST_ROWS if n > MOST_ROWS * 64 else LEAST_ROWS, min(MOST_ROWS, n // 64), n // ANNULI)
    # bounds of annuli: distances at even ranks of each cell
    per_cell = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    parts = {r["cell"]: max(1, -(-r["n"] // size)) for r in per_cell.collect()}
    most = max(parts.values(), default=1)
    cuts = index.groupBy("cell").agg(F.percentile_approx("far", [i / most for i in range(1, most)] or [0.5], 10_000).alias("cuts")).collect()
    bounds = {r["cell"]: sorted({r["cuts"][round(i * most / parts[r["cell"]]) - 1] for i in range(1, parts[r["cell"]])}) for r in cuts}
    table = F.lit(None).cast("array<double>") if not bounds else F.element_at(F.create_map(*[x for c, b in bounds.items() for x in (F.lit(c), F.lit(b).cast("array<double>"))]), F.col("cell"))
    ring = F.size(F.filter(table, lambda b: b <= F.col("far")))
    ringed = index.withColumn("ring", ring)
    # annuli of more rows than that (equal distances) are cut by a hash; a small table, whose true size decides how it is joined
    crowd = ringed.groupBy("cell", "ring").agg(F.ceil(F.count(F.lit(1)) / size).alias("cuts")).filter("cuts > 1")
    crowd = work.put(crowd, "crowd")
    salt = F.coalesce(F.pmod(F.xxhash64("id"), F.col("cuts")), F.lit(0)).cast("int")
    place = F.concat_ws("-", "cell", "ring", "salt").alias("place")
    placed = ringed.join(crowd, ["cell", "ring"], "left").withColumn("salt", salt).select(place, "cell", "id", "v", "far", "norm")
    found = placed.groupBy("place").agg(F.first("cell").alias("cell"), F.min("far").alias("a"), F.max("far").alias("b"), F.max("norm").alias("norm")).collect()
    found.sort(key=lambda r: r["place"])
    names = [r["place"] for r in found]
    of_cell, near, outer, heavy = (np.array([r[c] for r in found], t) for c, t in (("cell", np.int64), ("a", float), ("b", float), ("norm", float)))

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once for each annulus that it has to visit, with the score it needs."""
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                q, ids = matrix(batch.column(1), width), batch.column(0).to_numpy()
                score = products(q, sample).astype(float)
                score[ids[:, None] == known[None]] = -np.inf
                need = np.sort(score, 1)[:, -k] if score.shape[1] >= k else np.full(len(q), -np.inf)
                far = distances(q, pivots)[:, of_cell]
                norm = (q.astype(float) ** 2).sum(1)
                gap = np.maximum(0, np.maximum(near[None] - far, far - outer[None]))
                a, b = np.nonzero(gap <= reach(need[:, None], norm[:, None], heavy[None]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[j] for j in b], pa.string()), pa.array(np.ones(len(a), np.int32)), pa.array(ids[a]), batch.column(1).take(pa.array(a)),
                     pa.array(far[a, b]), pa.array(norm[a]), pa.array(need[a])], names=["place", "kind", "id", "v", "far", "norm", "need"])

    schema = "place string, kind int, id bigint, v array<bigint>, far double, norm double, need double"
    queries = index.filter(F.pmod("id", F.lit(every)) == 0).select("id", "v").mapInArrow(sent, schema)
    both = placed.select("place", F.lit(0).alias("kind"), "id", "v", "far", "norm", F.lit(0.0).alias("need")).unionByName(queries)

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come annulus by annulus: its vectors by distance, then the queries sent to it."""
        place, parts, ready = None, [], None
        for batch in batches:
            # cut where the annulus or the kind of row changes
            places, kinds = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cut = [0] + [i for i in range(1, len(places)) if places[i] != places[i - 1] or kinds[i] != kinds[i - 1]] + [len(places)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if lo == hi:
                    continue
                piece = batch.slice(lo, hi - lo)
                if places[lo] != place:
                    place, parts, ready = places[lo], [], None
                if kinds[lo] == 0:
                    parts.append((piece.column(2).to_numpy(), matrix(piece.column(3), width), piece.column(4).to_numpy(), piece.column(5).to_numpy()))
                elif parts:
                    ready = ready or [np.concatenate(x) for x in zip(*parts, strict=True)]
                    yield _expand(piece, *ready, width, k)

    best = both.repartition("place").sortWithinPartitions("place", "kind", "far").mapInArrow(visited, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _expand(queries: pa.RecordBatch, ids, vectors, far, norm, width: int, k: int) -> pa.RecordBatch:
    """The k best rows of one annulus for each query sent to it, from the query's distance outwards."""
    out_q, out_id, out_score = [], [], []
    heavy = float(norm.max())
    q = matrix(queries.column(3), width)
    for query, own, at, q_norm, need in zip(q, queries.column(2).to_numpy(), queries.column(4).to_numpy(), queries.column(5).to_numpy(), queries.column(6).to_numpy(), strict=True):
        best_ids, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        low = high = int(np.searchsorted(far, at))
        open_low, open_high = low > 0, high < len(far)
        while open_low or open_high:
            within = reach(np.float64(need), q_norm, heavy)
            # the nearer side first
            if open_high and (not open_low or far[high] - at <= at - far[low - 1]):
                if far[high] - at > within:
                    open_high = False
                    continue
                span = slice(high, min(len(far), high + STRIPE))
                high = span.stop
                open_high = high < len(far)
            else:
                if at - far[low - 1] > within:
                    open_low = False
                    continue
                span = slice(max(0, low - STRIPE), low)
                low = span.start
                open_low = low > 0
            score = products(query[None], vectors[span])[0]
            other = ids[span] != own
            best_ids, best = np.concatenate((best_ids, ids[span][other])), np.concatenate((best, score[other]))
            if len(best) > k:
                keep = np.lexsort((best_ids, -best))[:k]
                best_ids, best = best_ids[keep], best[keep]
            if len(best) == k:
                need = max(need, float(best.min()))
        out_q.append(np.full(len(best), own))
        out_id.append(best_ids)
        out_score.append(best)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (out_q, out_id, out_score)], names=["query_id", "vec_id", "score"])

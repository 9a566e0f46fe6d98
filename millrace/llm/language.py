"""Language of texts by a byte convolutional network, trained here in numpy.

Every byte has a small embedding; filters of widths 2, 3 and 4 slide over a window of
fixed length, the largest answer of each filter in the window feeds a softmax over
the languages.  A text is predicted from all its windows: their probabilities are
averaged, weighted by the bytes they hold.

The network is fitted on the driver on about PER_LANGUAGE labelled rows of each
language, chosen by a hash of key and text, and TRAIN_WINDOWS windows of each, at places of the whole
text that a hash gives; it is a few thousand numbers, whatever the table's size.  Every label that
is not null is learned, whatever its name.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so
is every text if there is no labelled row; a text of any length is read whole; rows that repeat give equal rows (and
teach once); of languages with equal sums the first in order is taken; an empty table gives an empty one; columns other
than doc_id, text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.runtime import flat_bytes, is_held_out, ship, slices

#: Bound of the training sample: rows of each language, and windows of each row.
PER_LANGUAGE, TRAIN_WINDOWS = 1200, 3
#: Bytes of a window.
WINDOW = 128
#: Filters of each width, and the embedding's size.
FILTERS, EMBEDDING = {2: 8, 3: 12, 4: 12}, 6
EPOCHS, STEP, BATCH, SEED = 6, 0.01, 64, 7
UNKNOWN = "und"
_WIDEST = max(FILTERS)
_PART = 1 << 20


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of each text as rows of bytes padded with 0, the text of each, and the bytes it holds."""
    lengths = np.diff(offsets)
    counts = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[owner] + within * WINDOW
    held = np.minimum(WINDOW, offsets[owner + 1] - start)
    place = start[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < held[:, None]
    out = np.where(inside, data[np.minimum(place, max(0, len(data) - 1))], 0).astype(np.uint8) if len(owner) else np.zeros((0, WINDOW), np.uint8)
    return out, owner, held


class Network:
    """Embedding, one bank of filters (narrow ones have zeros behind them), and the softmax layer."""

    def __init__(self, languages: list[str], rng: np.random.Generator):
        n = sum(FILTERS.values())
        self.languages = languages
        mask = np.concatenate([np.repeat((np.arange(_WIDEST) < w).astype(np.float32), EMBEDDING)[:, None].repeat(c, 1) for w, c in FILTERS.items()], 1)
        self.mask = mask
        self.weights = [
            rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
            (rng.normal(0, 0.3, (_WIDEST * EMBEDDING, n)) * mask).astype(np.float32), np.zeros(n, np.float32),
            rng.normal(0, 0.2, (n, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)]

    def pooled(self, x: np.ndarray, places: bool = False):
        """Largest answer of each filter in each window; with ``places`` also where, and the padded input."""
        embedding, filters, bias = self.weights[:3]
        padded = np.concatenate((x, np.zeros((len(x), _WIDEST - 1), np.uint8)), 1)
        flat = embedding[padded].reshape(len(x), -1)
        span = _WIDEST * EMBEDDING
        patches = np.lib.stride_tricks.sliding_window_view(flat, span, axis=1)[:, ::EMBEDDING]
        answers = (np.ascontiguousarray(patches).reshape(-1, span) @ filters).reshape(len(x), WINDOW, -1)
        if not places:
            return answers.max(1) + bias
        at = answers.argmax(1)
        return np.take_along_axis(answers, at[:, None, :], 1)[:, 0] + bias, at, padded, patches

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        parts = []
        for i in range(0, len(x), BATCH):
            scores = np.maximum(self.pooled(x[i:i + BATCH]), 0) @ self.weights[3] + self.weights[4]
            e = np.exp(scores - scores.max(1, keepdims=True))
            parts.append(e / e.sum(1, keepdims=True))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)), np.float32)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        embedding, filters, _, dense, offset = self.weights
        raw, at, padded, patches = self.pooled(x, places=True)
        hidden = np.maximum(raw, 0)
        scores = hidden @ dense + offset
        e = np.exp(scores - scores.max(1, keepdims=True))
        error = e / e.sum(1, keepdims=True)
        error[np.arange(len(y)), y] -= 1
        error /= len(y)
        back = (error @ dense.T) * (raw > 0)
        chosen = patches[np.arange(len(x))[:, None], at]  # window, filter, span
        of_filters = np.einsum("bf,bfk->kf", back, chosen) * self.mask
        of_inputs = (back[:, :, None] * filters.T[None]).reshape(len(x), -1, _WIDEST, EMBEDDING)
        seen = padded[np.arange(len(x))[:, None, None], at[:, :, None] + np.arange(_WIDEST)]
        of_embedding = np.zeros_like(embedding)
        np.add.at(of_embedding, seen.ravel(), of_inputs.reshape(-1, EMBEDDING))
        return [of_embedding, of_filters, back.sum(0), hidden.T @ error, error.sum(0)]


def fit(x: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = SEED) -> Network:
    """Adam over shuffled batches of windows; each language has the same weight of windows in an epoch."""
    rng = np.random.default_rng(seed)
    network = Network(languages, rng)
    first = [np.zeros_like(w) for w in network.weights]
    second = [np.zeros_like(w) for w in network.weights]
    most = max(np.bincount(labels, minlength=len(languages)))
    pools = [np.flatnonzero(labels == i) for i in range(len(languages))]
    t = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(np.concatenate([rng.permutation(np.resize(p, most)) for p in pools]))
        rate = STEP * (1 - epoch / EPOCHS)
        for i in range(0, len(order), BATCH):
            pick = order[i:i + BATCH]
            t += 1
            for w, g, a, b in zip(network.weights, network.gradients(x[pick], labels[pick]), first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
    return network


def train(docs: DataFrame) -> Network | None:
    """The network of the documents' languages, learned from rows that are not held out; None without such rows."""
    known = docs.filter(~is_held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    # texts are drawn by a hash of their own too, and equal ones count once, so that keys and texts that repeat can't make the sample grow
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000))
    chance = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, 1e6 * PER_LANGUAGE / n)]), F.col("lang"))
    # windows at hashed places of the whole text
    free = F.greatest(F.char_length("text") - WINDOW, F.lit(0)) + 1
    places = F.array_distinct(F.array(*[F.pmod(F.xxhash64("doc_id", F.lit(i)), free) for i in range(TRAIN_WINDOWS)]))
    rows = (known.filter(draw < chance).select("lang", "doc_id", "text").filter("text <> ''").select("lang", "text", F.explode(places).alias("at"))
            .select("lang", F.substring("text", F.col("at").cast("int") + 1, F.lit(WINDOW)).alias("head")).distinct().toPandas()
            .sort_values(["lang", "head"], ignore_index=True))
    if not len(rows):
        return None
    languages = sorted(counts)
    x, owner, held = windows(*flat_bytes(pa.array(rows["head"], pa.string())))
    # a last window of a few bytes says little
    enough = (held >= 32) | np.concatenate(([True], owner[1:] != owner[:-1]))
    labels = rows["lang"].map({k: i for i, k in enumerate(languages)}).to_numpy()[owner]
    return fit(x[enough], labels[enough], languages)


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, lang_pred and score of each row's whole text."""
    ship(docs.sparkSession)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in slices(whole, "text", _PART):
                x, owner, held = windows(*flat_bytes(part.column(1)))
                lettered = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                predicted, scores = np.full(part.num_rows, UNKNOWN, object), np.zeros(part.num_rows)
                if network is not None and len(x):
                    sums = np.zeros((part.num_rows, len(network.languages)))
                    for j, column in enumerate((network.probabilities(x) * held[:, None]).T):
                        sums[:, j] = np.bincount(owner, column, part.num_rows)
                    best = sums.argmax(1)
                    predicted[lettered] = np.array(network.languages, object)[best[lettered]]
                    scores[lettered] = (sums.max(1) / np.maximum(sums.sum(1), 1e-9))[lettered]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(predicted, pa.string()), pa.array(np.clip(scores, 0, 1))], names=["doc_id", "lang_pred", "score"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", lettered).mapInArrow(batches, f"doc_id {kind}, lang_pred string, score double")

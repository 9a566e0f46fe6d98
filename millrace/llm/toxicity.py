"""Toxicity of texts: gradient-boosted trees over dense features, with isotonic calibration.

Lexicon.  Words, and word beginnings of 4 to 7 letters, are counted by label over the
training sample; a unit's strength is the log odds of the label among its documents
beyond the base rate, shrunk towards it.  Features of a training row count the units
without that row itself, so that a rare word does not explain its own label.

Features.  Densities and strengths of lexicon hits by kind, hits near a second-person
word, capitals, punctuation and digits, and obfuscated words (signs or digits inside,
letters repeated), which are looked up in their plain form.

The sample has at most TRAIN_ROWS labelled rows, the first in the order of a hash of
their key; the lexicon at most LEXICON units.  Both are bounds, not parts of the
corpus: every document is scored from its whole text.

Defined results: null and empty texts get the score of their (all zero) features;
without any labelled row, or with one label only, the score is the base rate (0
without labels); a text of any length is scored whole; rows that repeat a key are scored each by its own text
(of those in the sample, the one whose text has the smallest hash teaches); equal texts have equal scores; an empty table
gives an empty one; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.runtime import is_held_out, ship

#: Bounds of the training sample and of the lexicon.
TRAIN_ROWS, LEXICON = 30_000, 20_000
#: A unit's least number of toxic documents, and its prior weight in documents.
SUPPORT, PRIOR = 3, 4.0
PREFIXES = (4, 5, 6, 7)
TREES, DEPTH, RATE, BINS, FOLDS = 60, 3, 0.2, 32, 3
NEAR = 5
#: Second-person words of the languages met.
SECOND_PERSON = frozenset("""you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes vous votre vos
tú ti usted ustedes vosotros tus vuestro vuestra""".split())
_LEET = str.maketrans("01345789@$!|", "oieastbgasil")
_INNER = re.compile(r"[^\W_]+")
_REPEAT = re.compile(r"(\w)\1{2,}")
_KEPT = 80_000
_FLUSH = 120_000
_STRONG = 2.0

FEATURES = [
    "log_words", "word_max", "word_top3", "word_density", "word_strong", "prefix_max", "prefix_top3", "prefix_density", "prefix_strong",
    "distinct_strong", "strong_density", "near_second", "second_density", "capital_rate", "capital_words", "punctuation_rate", "shout_rate",
    "digit_rate", "obfuscated_rate", "obfuscated_hits", "repeated_rate", "mean_word"]


def plain(token: str) -> tuple[str, bool, bool]:
    """A token in lower case without signs around it, whether it is obfuscated, and whether letters repeat in it."""
    word = token.lower().strip("\"'.,;:!?()[]{}<>*_-–—…«»“”„¿¡&%#=+/\\|~^`")
    if not word or word.isalpha():
        repeated = bool(_REPEAT.search(word))
        return (_REPEAT.sub(r"\1", word) if repeated else word), False, repeated
    letters = sum(map(str.isalpha, word))
    if letters * 2 < len(word) or "@" in word[1:] and "." in word:
        return "".join(_INNER.findall(word)), False, False
    clear = "".join(_INNER.findall(word.translate(_LEET)))
    return _REPEAT.sub(r"\1", clear), True, bool(_REPEAT.search(word))


def units(word: str) -> list[str]:
    return [word] + [f"{word[:n]}~" for n in PREFIXES if len(word) >= n]


class Features:
    """Dense features of a text, given the counts of the lexicon."""

    def __init__(self, lexicon: dict[str, tuple[int, int]], positives: int, negatives: int):
        self.lexicon, self.positives, self.negatives = lexicon, positives, negatives
        self.young: dict = {}

    def strength(self, counts: tuple[int, int], label: int | None) -> float:
        a, b, p, n = *counts, self.positives, self.negatives
        if label is not None:
            a, p = a - label, p - label
            b, n = b - (1 - label), n - (1 - label)
        base = (p + 0.5) / (p + n + 1)
        rate = (a + PRIOR * base) / (a + b + PRIOR)
        return float(np.log(rate / (1 - rate)) - np.log(base / (1 - base)))

    def about(self, token: str):
        """What a token adds: None for an ordinary word, else word counts, counts of its beginnings, second person, capitals, obfuscated, repeated."""
        word, hidden, repeated = plain(token)
        whole = self.lexicon.get(word)
        begins = [c for n in PREFIXES if len(word) >= n and (c := self.lexicon.get(f"{word[:n]}~"))]
        second = word in SECOND_PERSON
        capital = len(token) > 1 and token.isupper()
        found = (word, whole, begins, second, capital, hidden, repeated) if whole or begins or second or capital or hidden or repeated else None
        if len(self.young) >= _KEPT:
            self.young.clear()
        if len(token) <= 64:
            self.young[token] = found
        return found

    def __call__(self, text: str | None, label: int | None = None) -> list[float]:
        text = text or ""
        tokens = text.split()
        n = max(1, len(tokens))
        known, missing = self.young, object()
        whole, begin, strong, second, places = [], [], [], [], set()
        capitals = obfuscated = hit_hidden = repeats = 0
        for i, token in enumerate(tokens):
            found = known.get(token, missing)
            if found is missing:
                found = self.about(token)
            if found is None:
                continue
            word, w, b, is_second, capital, hidden, repeated = found
            s = self.strength(w, label) if w else 0.0
            q = max((self.strength(c, label) for c in b), default=0.0)
            if w:
                whole.append(s)
            if b:
                begin.append(q)
            if max(s, q) >= _STRONG:
                strong.append(i)
                places.add(word)
                hit_hidden += hidden
            if is_second:
                second.append(i)
            capitals += capital
            obfuscated += hidden
            repeats += repeated
        near = sum(1 for i in strong if (k := bisect_right(second, i + NEAR)) and second[k - 1] >= i - NEAR)
        counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
        size = max(1, int(counts.sum()))
        upper, digits = int(counts[65:91].sum()), int(counts[48:58].sum())
        signs = int(counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum())
        whole.sort(reverse=True)
        begin.sort(reverse=True)
        return [np.log1p(len(tokens)), whole[0] if whole else 0.0, sum(whole[:3]) / 3, sum(x for x in whole if x > 0) / n,
                float(sum(x >= _STRONG for x in whole)), begin[0] if begin else 0.0, sum(begin[:3]) / 3, sum(x for x in begin if x > 0) / n,
                float(sum(x >= _STRONG for x in begin)), float(len(places)), len(strong) / n, near / max(1, len(strong)), len(second) / n, upper / size,
                capitals / n, signs / size, (int(counts[33]) + int(counts[63])) / n, digits / size, obfuscated / n, float(hit_hidden),
                repeats / n, min(40.0, size / n)]


class Trees:
    """Gradient-boosted regression trees of the logistic loss over binned features."""

    def __init__(self, edges: list[np.ndarray], base: float):
        self.edges, self.base, self.trees = edges, base, []

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        # values of a rare feature are mostly equal: its few others get bins of their own
        edges = [np.unique(np.concatenate((e, np.quantile(c[c != 0], np.linspace(0, 1, BINS // 2)[:-1]) - 1e-9 if (c != 0).any() else e))) for e, c in zip(edges, x.T, strict=True)]
        base = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        model = Trees(edges, base)
        binned = model.binned(x)
        score = np.full(len(y), base)
        width = max(len(e) for e in edges) + 1
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            feature, cut, leaves, value = model._grow(binned, g, h, width)
            model.trees.append((feature, cut, value))
            score += value[leaves]
        return model

    @staticmethod
    def _grow(binned, g, h, width):
        node = np.zeros(len(g), np.int64)
        features, cuts = [], []
        for depth in range(DEPTH):
            n = 1 << depth
            best = np.zeros(n)
            feature, cut = np.zeros(n, np.int64), np.full(n, width)
            for f in range(binned.shape[1]):
                key = node * width + binned[:, f]
                sg = np.bincount(key, g, n * width).reshape(n, width).cumsum(1)
                sh = np.bincount(key, h, n * width).reshape(n, width).cumsum(1)
                tg, th = sg[:, -1:], sh[:, -1:]
                gain = sg ** 2 / (sh + 1) + (tg - sg) ** 2 / (th - sh + 1) - tg ** 2 / (th + 1)
                gain[(sh < 1) | (th - sh < 1)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(n), at]
                better = top > best + 1e-12
                best[better], feature[better], cut[better] = top[better], f, at[better]
            features.append(feature)
            cuts.append(cut)
            node = node * 2 + (binned[np.arange(len(g)), feature[node]] > cut[node])
        n = 1 << DEPTH
        value = RATE * np.bincount(node, g, n) / (np.bincount(node, h, n) + 1)
        return features, cuts, node, value

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T, strict=True)], 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self.binned(x)
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for features, cuts, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for feature, cut in zip(features, cuts, strict=True):
                node = node * 2 + (binned[rows, feature[node]] > cut[node])
            score += value[node]
        return score


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the non-decreasing fit of y by score (pool adjacent violators), to be interpolated."""
    order = np.argsort(score, kind="stable")
    xs, start = np.unique(score[order], return_index=True)
    sums, counts = np.add.reduceat(y[order].astype(float), start), np.diff(np.append(start, len(y)))
    blocks: list[list[float]] = []  # sum, count, first, last
    for x, s, c in zip(xs, sums, counts, strict=True):
        blocks.append([s, c, x, x])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s2, c2, _, last = blocks.pop()
            blocks[-1][0] += s2
            blocks[-1][1] += c2
            blocks[-1][3] = last
    points = [(x, b[0] / b[1]) for b in blocks for x in ([b[2], b[3]] if b[3] > b[2] else [b[2]])]
    return np.array([p[0] for p in points]), np.array([p[1] for p in points])


class Model:
    def __init__(self, features: Features | None, trees: Trees | None, curve, rate: float):
        self.features, self.trees, self.curve, self.rate = features, trees, curve, rate

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.rate)
        return np.clip(np.interp(self.trees.margin(np.array([self.features(t) for t in texts])), *self.curve), 0, 1)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled rows that are not held out.  Two passes over the sample's texts: the lexicon, then the features."""
    ship(docs.sparkSession)
    marked = labels.filter(~is_held_out(F.col("doc_id")) & F.col("toxic").isNotNull()).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    # a bounded number of small rows; the hash leaves few more than that for the task that orders them
    near = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(2e6 * TRAIN_ROWS / max(1, marked.count()))
    sample = marked.filter(near).orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(TRAIN_ROWS)
    # of rows that repeat a key one, so that what reaches the driver is bounded too
    texts = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic")
             .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("toxic", "text"))
    counts = texts.mapInArrow(_unit_counts, "unit string, positive bigint, negative bigint").groupBy("unit").agg(
        F.sum("positive").alias("a"), F.sum("negative").alias("b"))
    totals = counts.filter("unit = ''").first()
    p, n = (totals["a"], totals["b"]) if totals else (0, 0)
    if not p or not n:
        return Model(None, None, None, float(bool(p)))
    rate = p / (p + n)
    strong = ((F.col("a") + PRIOR * rate) / (F.col("a") + F.col("b") + PRIOR))
    rows = (counts.filter(f"unit <> '' and a >= {SUPPORT}").filter(strong > min(0.9, 2 * rate))
            .orderBy((strong * F.log1p("a")).desc(), "unit").limit(LEXICON).collect())
    features = Features({r["unit"]: (r["a"], r["b"]) for r in rows}, p, n)

    def described(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            labels_ = part.column(0).to_pylist()
            made = [features(t.as_py(), y) for t, y in zip(part.column(1), labels_, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(labels_, pa.int32()), pa.array(made, pa.list_(pa.float64()))], names=["toxic", "x"])

    table = texts.mapInArrow(described, "toxic int, x array<double>").toPandas()
    order = np.lexsort(np.stack(table["x"].to_list()).T)  # whatever order the rows came in
    x, y = np.stack(table["x"].to_list())[order], table["toxic"].to_numpy()[order].astype(float)
    fold = np.arange(len(y)) % FOLDS
    aside = np.empty(len(y))
    for k in range(FOLDS):
        rest = fold != k
        aside[~rest] = Trees.fit(x[rest], y[rest]).margin(x[~rest]) if (~rest).any() and rest.any() else 0.0
    return Model(features, Trees.fit(x, y), isotonic(aside, y), rate)


def _unit_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a unit, summed within the task; the empty unit counts the documents."""
    held: dict[str, list[int]] = {}

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held)), *[pa.array([v[i] for v in held.values()], pa.int64()) for i in (1, 0)]], names=["unit", "positive", "negative"])
        held.clear()
        return out

    for part in parts:
        for label, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
            found = {""}
            for token in set((text.as_py() or "").split()):
                if word := plain(token)[0]:
                    found.update(units(word))
            for unit in found:
                held.setdefault(unit, [0, 0])[label] += 1
            if len(held) > _FLUSH:
                yield flush()
    if held:
        yield flush()


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of each row's whole text."""
    ship(docs.sparkSession)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(0, part.num_rows, 500):
                few = part.slice(i, 500)
                yield pa.RecordBatch.from_arrays([few.column(0), pa.array(model.scores([t.as_py() for t in few.column(1)]))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(batches, f"doc_id {kind}, score double")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below ``threshold``, columns as they were; judged row by row, so rows without a key or with a repeated one stay apart."""
    ship(docs.sparkSession)
    order = [c for c in docs.columns if c != "text"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(0, part.num_rows, 500):
                few = part.slice(i, 500)
                clean = model.scores([t.as_py() for t in few.column(len(order))]) < threshold
                yield few.filter(pa.array(clean))

    source = docs.select(*[f"`{c}`" for c in order], "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(batches, fields).select(*[f"`{c}`" for c in docs.columns])

"""Token counts of a byte-level BPE vocabulary, without making identifiers.

Each piece that the splitting pattern finds starts as its bytes in a doubly
linked list; a heap holds the known neighbour pairs by (rank, place).  Popping the
lowest pair that still stands, joining it and pushing the two new pairs is repeated
until no pair is known: the count is bytes minus merges.  Counts of pieces and of
space-separated chunks are kept in bounded per-process tables, as words repeat.

Defined results: a null text counts as empty (0 tokens); the vocabulary's special
strings inside a text are one token each, as its library does by default; a text of any length is
counted whole; rows that repeat give equal rows; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from millrace.llm.runtime import ship

#: Fixed value: how byte-level vocabularies split a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries of each generation of a process's tables of counted strings.
KEPT = 250_000
_UNSAFE = re.compile(r"\s |  | \s|\A |\A\s| \Z")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + rest.index(b)) for b in range(256)]


class Counted(dict):
    """Counts of strings in two generations: when the young one is full it becomes the old one, which is dropped."""

    def __init__(self, count):
        super().__init__()
        self.count, self.old = count, {}

    def __missing__(self, text: str) -> int:
        n = self.old.get(text)
        if n is None:
            n = self.count(text)
            if len(text) > 64:
                return n
        if len(self) >= KEPT:
            self.old = dict(self)
            self.clear()
        self[text] = n
        return n


class Merges:
    """Ranks of the pairs of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        vocabulary = model["vocab"]
        self.first = [vocabulary[c] for c in byte_symbols()]
        self.pairs = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs[(vocabulary[left], vocabulary[right])] = (rank, vocabulary[left + right])
        specials = [t["content"] for t in whole.get("added_tokens") or []]
        self.special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.split = regex.compile(PATTERN)
        self.pieces = Counted(self.piece)
        self.chunks = Counted(lambda part: self.chunk(" " + part))

    def piece(self, text: str) -> int:
        """Tokens of one piece."""
        symbols = [self.first[b] for b in text.encode("utf-8", "surrogatepass")]
        n = len(symbols)
        pairs = self.pairs
        heap = [(found[0], i, found[1]) for i in range(n - 1) if (found := pairs.get((symbols[i], symbols[i + 1])))]
        heapq.heapify(heap)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        merges = 0
        while heap:
            _, i, made = heapq.heappop(heap)
            j = right[i]
            if j >= n or symbols[i] < 0:
                continue
            found = pairs.get((symbols[i], symbols[j]))
            if not found or found[1] != made:  # one of the two was joined to another since
                continue
            merges += 1
            symbols[i], symbols[j] = made, -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if found := pairs.get((made, symbols[k])):
                    heapq.heappush(heap, (found[0], i, found[1]))
            h = left[i]
            if h >= 0 and (found := pairs.get((symbols[h], made))):
                heapq.heappush(heap, (found[0], h, found[1]))
        return n - merges

    def chunk(self, text: str) -> int:
        """Tokens of a text without special strings, piece by piece."""
        return sum(map(self.pieces.__getitem__, self.split.findall(text)))

    def _plain(self, text: str) -> int:
        # A space between two other characters starts a piece, so what stands between such spaces can be counted apart.
        if not text or _UNSAFE.search(text):
            return self.chunk(text)
        head, *rest = text.split(" ")
        return self.chunk(head) + sum(map(self.chunks.__getitem__, rest))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not (found := self.special.findall(text)):
            return self._plain(text)
        return len(found) + sum(map(self._plain, self.special.split(text)))


_LOADED: dict[str, Merges] = {}


def loaded(path: str) -> Merges:
    if path not in _LOADED:
        _LOADED[path] = Merges(path)
    return _LOADED[path]


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_bytes (UTF-8) and n_tokens of each row's whole text; one row for each input row, in no order.

    ``path`` is a vocabulary file that every executor has.
    """
    ship(docs.sparkSession)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(path)
        for part in parts:
            sizes = pc.fill_null(pc.binary_length(part.column(1)), 0).cast(pa.int64())
            counts = [counter.count(x.as_py()) for x in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), sizes, pa.array(counts, pa.int64())], names=[key, "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(batches, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint")

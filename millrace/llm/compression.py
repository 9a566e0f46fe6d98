"""Quality rules by compression bands: zstandard ratios of whole documents and of fixed chunks, beside counts of words, symbols and repeats.

The ratio is compressed bytes over bytes.  Prose of a length compresses to about the
same ratio; far less means repetition, far more means keys, encoded data or noise.  As
a short text has little to refer back to, the band depends on the length: BANDS gives
for each number of bytes from which it holds the lowest and the highest ratio.  A
document is rejected if its own ratio lies outside, or if more than one in FIFTH of its
chunks of CHUNK bytes do, so that a long text with a repeated or an encoded part is
found by that part.  A last chunk of less than half of CHUNK is judged with the document only.

Words are longest runs of characters other than ASCII white space.  ``n_repeat_words``
counts the words in windows of eight words that the text has twice or more; windows are
compared by ranks that are doubled in width (1, 2, 4, 8 words), so equal means equal.

Defined results: null and empty texts have no words, ratio 0 and fail the base rules; rows that repeat stay
rows of their own; an empty table gives an empty one; a text of any length is read whole, one
such text at a time.  Other columns stay; columns with the names of the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.runtime import ship, slices
from millrace.llm.terms import SPACES, pieces

#: (bytes from which a band holds, lowest ratio, highest ratio): about half of what prose has, and above what any script's prose has;
#: the frame outweighs what is in it below 32 bytes.
BANDS = [(0, 0.0, float("inf")), (32, 0.50, 1.30), (128, 0.42, 1.05), (256, 0.36, 0.92), (512, 0.32, 0.86), (1024, 0.28, 0.80), (2048, 0.25, 0.76), (4096, 0.22, 0.74),
         (16384, 0.19, 0.73), (65536, 0.16, 0.72), (1048576, 0.12, 0.72)]
CHUNK = 4096
FIFTH = 5
LEVEL = 3
WINDOW = 8
#: The base rules: fewest words, and per cent of words that may be in repeated windows.
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Bytes of text that are measured at once.
BATCH = 1 << 20

FIELDS = {"n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean",
          "ratio": "double", "n_chunks": "int", "n_low_chunks": "int", "n_high_chunks": "int", "verdict": "string", "kept": "boolean"}
_SPACE = b" \t\n\r\x0b\x0c"
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}


def band(size: int) -> tuple[float, float]:
    """Lowest and highest ratio of so many bytes."""
    return next((low, high) for least, low, high in reversed(BANDS) if size >= least)


def ratios(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, int, int, int, str]:
    """Ratio of the whole, chunks, chunks below and above their band, and the verdict: ok, repetitive or incompressible, with ``_part`` if by chunks."""
    if not data:
        return 0.0, 0, 0, 0, "ok"
    ratio = len(compressor.compress(data)) / len(data)
    low, high = band(len(data))
    chunks = below = above = 0
    for at in range(0, len(data), CHUNK):
        part = data[at:at + CHUNK]
        if 2 * len(part) < CHUNK or len(part) == len(data):
            break
        own_low, own_high = band(len(part))
        own = len(compressor.compress(part)) / len(part)
        chunks, below, above = chunks + 1, below + (own < own_low), above + (own > own_high)
    verdict = ("repetitive" if ratio < low else "incompressible" if ratio > high
               else "repetitive_part" if below * FIFTH > chunks and below >= above else "incompressible_part" if above * FIFTH > chunks
               else "mixed_part" if (below + above) * FIFTH > chunks else "ok")
    return ratio, chunks, below, above, verdict


def repeated_words(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For texts whose words are ``ids[bounds[i]:bounds[i + 1]]``: words in windows that a text has twice or more."""
    n = len(ids)
    if n < WINDOW:
        return np.zeros(len(bounds) - 1, np.int64)
    rank, width = ids.astype(np.int64), 1
    while width < WINDOW:  # the rank of 2 w words from those of two times w words
        pair = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        rank, width = np.unique(pair, return_inverse=True)[1], 2 * width
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = owner[:len(rank)] == owner[WINDOW - 1:]
    start = np.flatnonzero(inside)
    _, again, times = np.unique(owner[start] * (int(rank.max()) + 1) + rank[start], return_inverse=True, return_counts=True)
    edges = np.zeros(n + 1, np.int64)
    start = start[times[again] > 1]
    edges[:n] += np.bincount(start, minlength=n)
    edges += np.bincount(start + WINDOW, minlength=n + 1)[:n + 1] * -1
    covered = np.concatenate(([0], np.cumsum(np.cumsum(edges[:n]) > 0)))
    return covered[bounds[1:]] - covered[bounds[:-1]]


def measured(texts: list[bytes], compressor: zstandard.ZstdCompressor) -> dict[str, list]:
    """The fields of each text."""
    known: dict[bytes, int] = {}
    ids: list[np.ndarray] = []
    bounds = np.zeros(len(texts) + 1, np.int64)
    out: dict[str, list] = {name: [] for name in FIELDS}
    for i, data in enumerate(texts):
        n = 0
        for piece in pieces(data.translate(SPACES)):
            words = piece.split()
            ids.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
            n += len(words)
        bounds[i + 1] = bounds[i] + n
        lines = [line for line in data.split(b"\n") if line.strip(_SPACE)]
        bare = data.translate(None, _SPACE)
        out["n_words"].append(n)
        # bytes that don't continue a character
        out["word_chars"].append(len(bare.decode("utf-8", "surrogatepass")))
        out["n_symbols"].append(len(data) - len(data.translate(None, b"#*$%&|<>")))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        for name, value in zip(("ratio", "n_chunks", "n_low_chunks", "n_high_chunks", "verdict"), ratios(data, compressor), strict=True):
            out[name].append(value)
    out["n_repeat_words"] = repeated_words(np.concatenate(ids) if ids else np.zeros(0, np.int64), bounds).tolist()
    for words, repeated, verdict in zip(out["n_words"], out["n_repeat_words"], out["verdict"], strict=True):
        out["base_failed"].append(words < LEAST_WORDS or 100 * repeated > MOST_REPEATED * words)
        out["kept"].append(not out["base_failed"][-1] and verdict == "ok")
    return out


def quality(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with the columns of FIELDS."""
    ship(docs.sparkSession)
    keep = [c for c in docs.columns if c not in FIELDS and (keep_text or c != text)]
    held = [c for c in keep if c != text]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(held)], F.col(f"`{text}`").alias("_body"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for whole in parts:
            for part in slices(whole, "_body", BATCH):
                found = measured([x.as_buffer().to_pybytes() if x.is_valid else b"" for x in part.column(len(held))], compressor)
                first = part.columns if keep_text else part.columns[:-1]
                yield pa.RecordBatch.from_arrays([*first, *[pa.array(found[n], _ARROW[k]) for n, k in FIELDS.items()]],
                                                 names=[*part.schema.names[:len(first)], *FIELDS])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if keep_text or f.name != "_body"]
    made = rows.mapInArrow(batches, ", ".join([*fields, *[f"`{n}` {k}" for n, k in FIELDS.items()]]))
    back = {c: f"_c{i}" for i, c in enumerate(held)} | {text: "_body"}
    return made.select(*[F.col(back[c]).alias(c) for c in keep], *FIELDS)


def without_poor(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    names = {c: f"_k{i}" for i, c in enumerate(docs.columns)}
    found = quality(docs.select(*[F.col(f"`{c}`").alias(k) for c, k in names.items()]), names[text]).filter("kept")
    return found.select(*[F.col(k).alias(c) for c, k in names.items()])

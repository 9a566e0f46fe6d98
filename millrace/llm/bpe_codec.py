"""Encoding to and decoding from the ids of a local rank file, by the tiktoken library.

The splitting pattern reads a text from left to right, and no piece goes on from a character
that is not white space to one that is, nor from a letter to a sign.  So a long text may be
cut before white space that follows other characters, and before a sign that follows a letter:
the cut changes no id and bounds what the library holds at once.  A run of white space is matched with a
look-ahead that the library can't carry out on a very long run; such runs go by the pattern's own
rule: the whole run at the end of a text, all but its last character before other text, as one piece.
Decoding joins the raw bytes of the ids; they are read as UTF-8 only at the end, as an id may
hold part of a character.

Defined results: a null text is encoded as empty (no ids); a text of any length and make is encoded
whole (a stretch without a boundary, say of letters only, at once); rows that repeat give equal rows;
an empty table gives an empty one; other columns stay, those with the names of the results are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from millrace.llm.runtime import ship, slices

#: Characters of a text that are given to the library at once, up to the next safe boundary.
PART = 1 << 16
#: Bytes of text in one output batch.
BATCH = 1 << 20
#: White space as the library's pattern has it; some letters and signs that every version of Unicode has as such.
_BLANK = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTER, _SIGN = r"A-Za-zа-яА-Я一-龥ぁ-ゔァ-ヺ가-힣", r"!-&(-/:-@\[-`{-~。，、"
_SAFE = re.compile(f"(?<=[^{_BLANK}])(?=[{_BLANK}])|(?<=[{_LETTER}])(?=[{_SIGN}])")
#: White space of this length on is kept from the library's pattern.
LONG_RUN = 1 << 15
_RUN = re.compile(f"[{_BLANK}]{{{LONG_RUN},}}")


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        self.encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {i: b for b, i in ranks.items()}

    def encode(self, text: str | None) -> np.ndarray:
        """The ids as 32-bit numbers."""
        parts = [np.array(self.encoding._encode_single_piece(piece) if single else self.encoding.encode_ordinary(piece), np.int32)
                 for part in safe_parts(text) for piece, single in without_long_runs(part)] if text else []
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def decode_bytes(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.asarray(ids, np.int64).tolist()))

    def decode(self, ids: Sequence[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


def safe_parts(text: str, limit: int = PART) -> Iterator[str]:
    """The text in parts of about ``limit`` characters that are encoded alike alone and in their place."""
    start = 0
    while len(text) - start > limit:
        cut = _SAFE.search(text, start + limit)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def without_long_runs(part: str) -> Iterator[tuple[str, bool]]:
    """Stretches of a part, and whether each is a single piece of the pattern: what it takes of a long run of white space."""
    at = 0
    for run in _RUN.finditer(part) if len(part) >= LONG_RUN else ():
        stop = run.end() if run.end() == len(part) else run.end() - 1
        if run.start() > at:
            yield part[at:run.start()], False
        yield part[run.start():stop], True
        at = stop
    if at < len(part):
        yield part[at:], False


_LOADED: dict[tuple[str, str], Codec] = {}


def loaded(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = Codec(path, pattern)
    return _LOADED[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``ids`` (array<int>) of each whole text; a column of that name is replaced."""
    return _mapped(docs, path, pattern, text, ["ids"], lambda codec, ids: {"ids": ids})


def encode_digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with n_tokens, ids_sha256 and decoded_sha256 after an encode and a decode.

    ids_sha256 is over the ids as little-endian unsigned 32-bit numbers, decoded_sha256 over the decoded bytes.
    """
    return _mapped(docs, path, pattern, text, ["n_tokens", "ids_sha256", "decoded_sha256"], _digests, keep_text=False)


def encode_all(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """As ``encode_digests``, and the ids."""
    return _mapped(docs, path, pattern, text, ["n_tokens", "ids_sha256", "decoded_sha256", "ids"],
                   lambda codec, ids: _digests(codec, ids) | {"ids": ids}, keep_text=False)


def _digests(codec: Codec, ids: np.ndarray) -> dict:
    return {"n_tokens": len(ids), "ids_sha256": hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest(),
            "decoded_sha256": hashlib.sha256(codec.decode_bytes(ids)).hexdigest()}


_TYPES = {"ids": ("array<int>", pa.list_(pa.int32())), "n_tokens": ("bigint", pa.int64()),
          "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}


def _mapped(docs, path, pattern, text, names, of_ids, keep_text=True) -> DataFrame:
    ship(docs.sparkSession)
    keep = [c for c in docs.columns if c not in names and (keep_text or c != text)]
    order = [*[c for c in keep if c != text], text]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = loaded(path, pattern)
        last = len(order) - 1
        for whole in parts:
            for part in slices(whole, text, BATCH):
                made = [of_ids(codec, codec.encode(x.as_py())) for x in part.column(last)]
                held = range(len(order)) if keep_text else range(last)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in held] + [pa.array([m[n] for m in made], _TYPES[n][1]) for n in names],
                    names=[order[i] for i in held] + names)

    source = docs.select(*[f"`{c}`" for c in order])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if keep_text or f.name != text]
    return source.mapInArrow(batches, ", ".join(fields + [f"{n} {_TYPES[n][0]}" for n in names]))


def decode_texts(docs: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded`` (binary): the raw bytes of each row's ids; null ids give no bytes."""
    ship(docs.sparkSession)
    keep = [c for c in docs.columns if c != "decoded"]
    source = docs.select(*[f"`{c}`" for c in keep])
    place = keep.index(ids)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = loaded(path, pattern)
        for part in parts:
            decoded = [codec.decode_bytes(x.as_py() or []) for x in part.column(place)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], names=[*keep, "decoded"])

    return source.mapInArrow(batches, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema] + ["decoded binary"]))

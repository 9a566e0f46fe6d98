"""Terms of texts as UTF-8 bytes: runs of kept bytes, A-Z in lower case, in pieces of bounded size."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

__all__ = ["LETTERS", "LETTERS_AND_DIGITS", "SPACES", "pieces", "term_lists", "count_terms"]

#: Bytes of text that are cut into terms at once.
PIECE = 1 << 20


def _kept(kept: bytes) -> bytes:
    """A translation: kept bytes stay (A-Z in lower case), as do those of characters beyond ASCII; all others become spaces."""
    return bytes(b + 32 if 65 <= b <= 90 else b if b in kept or b >= 128 else 32 for b in range(256))


_LETTERS = bytes([*range(65, 91), *range(97, 123)])
LETTERS = _kept(_LETTERS)
LETTERS_AND_DIGITS = _kept(_LETTERS + bytes(range(48, 58)))
#: White space becomes a space, all else stays as it is.
SPACES = bytes(32 if b in range(9, 14) else b for b in range(256))


def pieces(data: bytes, limit: int = PIECE) -> Iterator[bytes]:
    """``data`` in parts of about ``limit`` bytes, each ending before a space."""
    start = 0
    while len(data) - start > limit:
        cut = data.find(b" ", start + limit)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut
    yield data[start:] if start else data


def term_lists(text: bytes, kept: bytes) -> Iterator[list[bytes]]:
    """All terms of a whole text in order, piece by piece."""
    for piece in pieces(text.translate(kept)):
        yield piece.split()


def count_terms(text: bytes, kept: bytes) -> Counter[bytes]:
    """How often each term occurs in a whole text."""
    found: Counter[bytes] = Counter()
    for terms in term_lists(text, kept):
        found.update(terms)
    return found

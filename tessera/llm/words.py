"""Cutting UTF-8 texts into words by their bytes: all delimiters are ASCII, so no character is ever cut apart."""

from __future__ import annotations

from collections.abc import Callable, Iterator

#: Bytes of a text that are cut into words at once: the words of a long text are never all held.
PIECE = 2 << 20


def byte_table(lower: bool, keep: Callable[[int], bool], other: int = 0x20) -> bytes:
    """A table for ``bytes.translate``: bytes to keep (A-Z lower-cased if ``lower``), all others become ``other``."""
    return bytes((b + 32 if lower and 0x41 <= b <= 0x5A else b) if keep(b) else other for b in range(256))


def cut_at_spaces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``text`` in pieces of about ``size`` bytes, cut at a space (a longer word stays whole)."""
    lo = 0
    while len(text) - lo > size:
        hi = text.rfind(b" ", lo, lo + size)
        if hi < lo:
            hi = text.find(b" ", lo + size)
            if hi < 0:
                break
        yield text[lo:hi]
        lo = hi + 1
    yield text[lo:]

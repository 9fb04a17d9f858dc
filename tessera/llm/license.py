"""License scan: exact phrases, and short notices with a bounded number of edits.

A text becomes its words (runs of digits, letters and non-ASCII characters; A-Z lower-cased),
joined by one space. ``phrases`` are searched for as they stand, on word bounds. A notice of *m* characters may
be found with up to ``edits(m)`` = *k* edits: it is cut into k + 1 pieces, of which one must occur
unchanged (pigeonhole), so exact search for the pieces locates every candidate; around each, the
regex library's bounded-error matching verifies the edits and gives the span. Each search is bounded by a seed's window, so the work
grows in proportion to the text, however many notices it holds. A place within that of another
notice with fewer edits is left out: notices can be so alike that one is the other with a few edits. Nothing is
shuffled, and each text is searched whole.

Edge cases: a null or empty text has no words and no matches; a phrase that stands several times
is counted at each place; touching places count each; repeated rows are scanned alike; extra columns
pass through, except those named like the added ones.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import regex
from pyspark.sql import DataFrame

from tessera.llm.common import map_texts

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Short notices and their labels.
NOTICES = {
    "this work is licensed under the gnu general public license": "gpl",
    "this program is free software you can redistribute it and or modify": "gpl",
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under a creative commons attribution": "cc-by",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved no part of this publication may be reproduced": "all-rights-reserved",
}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: bytes of words, lower-cased; every other ASCII byte becomes a space
TO_WORDS = bytes(c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else 32 for c in range(256))

SCHEMA = (
    "n_words long, matches array<struct<label:string,kind:string,first_word:long,last_word:long,"
    "start:long,end:long,edits:int,score:double>>"
)


def edits(length: int) -> int:
    """Edits allowed in a notice of so many characters."""
    return max(1, min(5, length // 12))


def pieces(notice: str) -> list[tuple[int, str]]:
    """The notice cut into ``edits + 1`` pieces, with their offsets."""
    k = edits(len(notice)) + 1
    at = [len(notice) * i // k for i in range(k + 1)]
    return [(a, notice[a:b]) for a, b in zip(at, at[1:], strict=False)]


@lru_cache(maxsize=256)
def fuzzy(notice: str) -> regex.Pattern:
    return regex.compile(rf"(?b)\b(?=\S)(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits(len(notice))}}}(?<=\S)\b")


def windows(notice: str, text: str) -> list[tuple[int, int]]:
    """Short parts of the text such that each match of the notice lies in one: seeds' windows, neighbouring ones together."""
    k = edits(len(notice))
    found = set()
    for offset, piece in pieces(notice):
        at = text.find(piece)
        while at >= 0:
            found.add(at - offset)
            at = text.find(piece, at + 1)
    out: list[list[int]] = []
    for start in sorted(found):
        lo, hi = max(0, start - 2 * k - 1), min(len(text), start + len(notice) + 2 * k + 1)
        if out and hi - out[-1][0] <= len(notice) + 8 * k + 2:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def places(notice: str, text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, edits) of the best match of the notice, then of the best in what is left, and so on.

    Every search is bounded by a seed's window. A heap holds each window's best match; one that overlaps a place taken
    before is searched again in the window's parts before and behind that place."""
    pattern, shortest = fuzzy(notice), max(1, len(notice) - edits(len(notice)))
    heap: list[tuple[int, int, int, int, int]] = []
    starts, ends = [], []  # of the places taken, in order

    def search(lo: int, hi: int) -> None:
        while hi - lo >= shortest and (m := pattern.search(text, lo, hi)):
            if m.end() > m.start():
                heappush(heap, (sum(m.fuzzy_counts), m.start(), m.end(), lo, hi))
                return
            lo = m.start() + 1

    for lo, hi in windows(notice, text):
        search(lo, hi)
    while heap:
        n, start, end, lo, hi = heappop(heap)
        i = bisect_right(starts, start)  # the places taken don't overlap: only the neighbours may
        if i and ends[i - 1] > start:
            start, end = starts[i - 1], ends[i - 1]
        elif i < len(starts) and starts[i] < end:
            start, end = starts[i], ends[i]
        else:
            starts.insert(i, start)
            ends.insert(i, end)
            yield start, end, n
        search(lo, min(start, hi))
        search(max(end, lo), hi)


def fewest_edits(found: list[tuple[str, int, int, int, float]]) -> list[tuple[str, int, int, int, float]]:
    """The matches (label, start, end, edits, score) that lie within none with fewer edits; those of one notice
    don't overlap."""
    out = []
    ends: dict[int, int] = {}  # by number of edits: the furthest end so far
    for m in sorted(found, key=lambda m: (m[1], m[3])):
        if all(end < m[2] for n, end in ends.items() if n < m[3]):
            out.append(m)
        ends[m[3]] = max(m[2], ends.get(m[3], 0))
    return out


def find_notices(text: str, notices: dict[str, str]) -> list[tuple[str, int, int, int, float]]:
    """(label, start, end, edits, score) of each notice in a text of words joined by spaces."""
    out = []
    for notice, label in notices.items():
        out += [(label, a, b, n, 1 - n / len(notice)) for a, b, n in places(notice, text)]
    return fewest_edits(out)


def scan(text: bytes, phrases: dict[bytes, str], notices: dict[str, str], seeds: list[bytes]) -> tuple[int, list]:
    """The number of words of a text, and its matches as rows of ``SCHEMA``."""
    words = text.translate(TO_WORDS).split()
    joined = b" " + b" ".join(words) + b" "
    exact = []
    for phrase, label in phrases.items():
        at = joined.find(phrase)
        while at >= 0:
            exact.append((at, len(phrase) - 2, label))
            at = joined.find(phrase, at + 1)
    near = find_notices(joined[1:-1].decode(errors="replace"), notices) if any(s in joined for s in seeds) else []
    if not exact and not near:
        return len(words), []
    spans = [m.span() for m in WORD.finditer(text.decode(errors="replace").translate(LOWER))]
    out = []
    for at, size, label in exact:
        first = joined.count(b" ", 0, at)
        last = first + joined.count(b" ", at + 1, at + 1 + size)
        out.append((label, "exact", first, last, spans[first][0], spans[last][1], 0, 1.0))
    starts = [0]
    for a, b in spans:
        starts.append(starts[-1] + b - a + 1)
    for label, a, b, n, s in near:
        first, last = bisect_right(starts, a) - 1, bisect_right(starts, b - 1) - 1
        out.append((label, "near", first, last, spans[first][0], spans[last][1], n, s))
    names = ("label", "kind", "first_word", "last_word", "start", "end", "edits", "score")
    return len(words), [dict(zip(names, m, strict=True)) for m in sorted(out, key=lambda m: (m[2], m[3], m[0], m[1]))]


def license_scan(docs: DataFrame, phrases: dict[str, str] | None = None, notices: dict[str, str] | None = None) -> DataFrame:
    """``docs`` without the text, with ``n_words`` and ``matches``: label, kind (exact or near), first
    and last word (from 0), span in characters of the text, edits, and score (1 - edits / length)."""
    phrases = {f" {p} ".encode(): v for p, v in (PHRASES if phrases is None else phrases).items()}
    notices = dict(NOTICES if notices is None else notices)
    seeds = list({p.encode() for n in notices for _, p in pieces(n)})

    def run(texts):
        got = [scan(t, phrases, notices, seeds) for t in texts]
        return {"n_words": [n for n, _ in got], "matches": [m for _, m in got]}

    return map_texts(docs, run, SCHEMA)

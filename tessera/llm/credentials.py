"""Secrets in texts: plain patterns, and strings that look random to a character Markov model.

Base kinds, each leftmost and without overlaps of its own: ``assign`` (a name such as ``password`` or ``api_key``, then ``:`` or ``=``
and a value of 8 characters or more), ``access`` (``AKIA`` and capitals or digits, 16 characters or more), ``hex`` (32 hexadecimal
digits or more). Patterns run on UTF-8 bytes, so letter case means ASCII letters only; offsets are code points.

The method adds kind ``markov``: runs of at least ``LENGTH`` characters of keys and identifiers that touch no base span. Two first-order
Markov models of characters, one of random strings and one of ordinary identifiers, give a run's log-likelihood ratio; it counts
where that exceeds the prior odds against a secret (labelled identifiers per labelled secret) and ``ODDS`` to one on top.

The models are fitted on labelled samples: the distinct strings of ``SAMPLE`` distinct texts (those with the smallest hashes; a documented
bound). The base patterns label them: what they find is random, all other runs of ``LEAST`` characters are ordinary. Only sums of
transitions between characters, at most 2 x 68 x 68 numbers, come to the driver. Where no string is labelled random, the random model is uniform.

Edge cases: null and empty texts have no spans; ids may be null or repeat; each row is judged by itself; a long text is searched as a
whole; an empty table fits a model without any knowledge; other columns stay, except those called like the added ones, which are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_texts, slices, tidy

# The base patterns, the group that is measured and its least length.
BASE = {
    "assign": (re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE), 2, 8),
    "access": (re.compile(rb"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(rb"[0-9a-f]+"), 0, 32),
}
KINDS = [*BASE, "markov"]
#: One of these stands in every ``assign`` match: most texts are ruled out by a plain search.
NAMES = (b"passw", b"secret", b"token", b"api")

LENGTH, LEAST = 16, 8
RUN, LONG_RUN = (re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % n) for n in (LEAST, LENGTH))
#: Texts of the labelled sample, and the odds that a found string must reach.
SAMPLE, ODDS = 20_000, 99
#: Added to each count of a transition.
SMOOTHING = 0.5
SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CODE = np.zeros(256, np.int64)  # 0: the start of a string
CODE[np.frombuffer(SIGNS, np.uint8)] = np.arange(1, len(SIGNS) + 1)
STATES = len(SIGNS) + 1


class Span(NamedTuple):
    start: int
    kind: int
    end: int
    value: int  #: where the measured group starts


def runs_of(text: bytes, pattern: re.Pattern) -> list[tuple[int, int]]:
    return [m.span() for m in pattern.finditer(text)]


def base_spans(text: bytes, runs: list[tuple[int, int]]) -> list[Span]:
    """Byte offsets, in order. ``runs``: at least all runs of ``LENGTH`` characters."""
    out = []
    lower = text.lower()
    if any(n in lower for n in NAMES):
        pattern, group, least = BASE["assign"]
        out += [Span(m.start(), 0, m.end(), m.start(group)) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    pattern, group, least = BASE["access"]
    out += [Span(m.start(), 1, m.end(), m.start()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    # a match is a whole run of hexadecimal digits, and that lies in a run of key characters
    pattern, group, least = BASE["hex"]
    for a, b in runs:
        if b - a >= least:
            out += [Span(m.start(), 2, m.end(), m.start()) for m in pattern.finditer(text, a, b) if len(m.group(group)) >= least]
    return sorted(out)


def free_runs(runs: list[tuple[int, int]], spans: list[Span]) -> Iterator[tuple[int, int]]:
    """The runs that touch none of the sorted ``spans``."""
    i, reach = 0, -1
    for a, b in runs:
        while i < len(spans) and spans[i].start < b:
            reach = max(reach, spans[i].end)
            i += 1
        if reach <= a:
            yield a, b


class Model(NamedTuple):
    ratio: np.ndarray  #: log of P(next | last, random) / P(next | last, ordinary)
    least: float  #: the log-likelihood ratio from which a run counts


def transitions(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The transitions of all runs (as last * STATES + next), and where each run's begin."""
    code = CODE[np.frombuffer(b"".join(b"\x00" + r for r in runs), np.uint8)]
    inside = code[1:] != 0
    at = np.concatenate([[0], np.cumsum([len(r) for r in runs])[:-1]]).astype(np.int64)
    return (code[:-1] * STATES + code[1:])[inside], at


def labelled(docs: DataFrame) -> DataFrame:
    """random (boolean), run. ``docs``: text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            found: set[tuple[bool, bytes]] = set()
            for text in texts:
                runs = runs_of(text, RUN)
                spans = base_spans(text, runs)
                found.update((True, text[s.value : s.end]) for s in spans)
                found.update((False, text[a:b]) for a, b in free_runs(runs, spans))
            cols = [pa.array([f[0] for f in found], pa.bool_()), pa.array([f[1] for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["random", "run"])

    return docs.select("text").mapInArrow(tidy(run), "random boolean, run binary")


def added_up(strings: DataFrame) -> DataFrame:
    """random, pair (-1: the strings themselves), n; a task adds up its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, STATES * STATES + 1), np.int64)
        for batch in batches:
            kind = np.asarray(batch.column(0).to_pylist(), bool)
            for label in (0, 1):
                runs = batch.column(1).filter(pa.array(kind == bool(label))).to_pylist()
                if runs:
                    n[label, :-1] += np.bincount(transitions([bytes(r).translate(None, b".") for r in runs])[0], minlength=STATES * STATES)
                    n[label, -1] += len(runs)
        label, pair = np.nonzero(n)
        cols = [pa.array(label == 1, pa.bool_()), pa.array(np.where(pair == STATES * STATES, -1, pair)), pa.array(n[label, pair])]
        yield pa.RecordBatch.from_arrays(cols, names=["random", "pair", "n"])

    return strings.mapInArrow(tidy(run), "random boolean, pair long, n long")


def fit(docs: DataFrame, sample: int = SAMPLE, text: str = "text") -> Model:
    """The models of the ``sample`` distinct texts of ``docs`` with the smallest hashes."""
    texts = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    key = F.xxhash64("text")
    last = texts.select(key.alias("h")).distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    strings = labelled(texts.where(key <= (0 if last is None else last))).distinct()
    n = np.zeros((2, STATES, STATES))
    strings_of = [0, 0]
    for r in added_up(strings).groupBy("random", "pair").agg(F.sum("n").alias("n")).collect():  # sums per pair of characters
        if r.pair < 0:
            strings_of[r.random] = r.n
        else:
            n[int(r.random), r.pair // STATES, r.pair % STATES] = r.n
    n = n[:, :, 1:] + SMOOTHING
    share = np.log(n / n.sum(axis=2, keepdims=True))
    ratio = np.zeros((STATES, STATES))
    ratio[:, 1:] = share[1] - share[0]
    return Model(ratio, math.log(ODDS) + math.log((strings_of[0] + 1) / (strings_of[1] + 1)))


def scores(runs: list[bytes], model: Model) -> np.ndarray:
    """The log-likelihood ratio of each run."""
    if not runs:
        return np.zeros(0)
    pair, at = transitions(runs)
    return np.add.reduceat(model.ratio.ravel()[pair], at)


def code_points(text: bytes, at: list[int]) -> list[int]:
    if text.isascii():
        return at
    before = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return before[at].tolist()


def without(text: bytes, spans: list[tuple], mark: bytes) -> bytes:
    """``text`` with each span, or chain of spans that overlap, replaced by ``mark``."""
    out, at = [], 0
    for start, _, end, _ in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return b"".join([*out, text[at:]])


def find_secrets(docs: DataFrame, model: Model, text: str = "text", mark: str | None = None) -> DataFrame:
    """``docs`` without ``text`` and with ``matches``, an array of (kind, start, end, score) by start and then kind; ``score`` is the
    log-likelihood ratio of a ``markov`` span, else null. With a ``mark`` also ``redacted``, the text with ``mark`` for its secrets."""

    def search(texts: list[bytes]) -> dict[str, list]:
        found, places = [], []
        for i, t in enumerate(texts):
            runs = runs_of(t, LONG_RUN)
            spans = base_spans(t, runs)
            found.append([(s.start, s.kind, s.end, None) for s in spans])
            places += [(i, a, b) for a, b in free_runs(runs, spans)]
        for (i, a, b), score in zip(places, scores([texts[i][a:b] for i, a, b in places], model).tolist(), strict=True):
            if score > model.least:
                found[i].append((a, KINDS.index("markov"), b, score))
        out, redacted = [], []
        for t, spans in zip(texts, found, strict=True):
            spans.sort(key=lambda s: s[:3])
            at = code_points(t, [p for s in spans for p in (s[0], s[2])]) if spans else []
            out.append([{"kind": KINDS[s[1]], "start": a, "end": b, "score": s[3]} for s, a, b in zip(spans, at[::2], at[1::2], strict=True)])
            if mark is not None:
                redacted.append(without(t, spans, mark.encode()).decode(errors="replace"))
        return {"matches": out, "redacted": redacted}

    schema = "matches array<struct<kind:string,start:long,end:long,score:double>>"
    return map_texts(docs, search, schema if mark is None else f"{schema}, redacted string", text)

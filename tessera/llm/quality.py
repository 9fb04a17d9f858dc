"""Quality classifier: histogram gradient-boosted trees over document statistics.

``document_stats`` turns a text into a fixed vector of byte, word and line statistics.
``fit`` learns from at most ``sample`` labelled rows (a documented bound; the rows with the
smallest hash of their id, so the choice depends on neither order nor partitions): statistics
are cut into at most ``bins`` quantile bins, and each tree grows level by level from gradient
and Hessian histograms. The trees are complete binary trees kept as three arrays, so a task
scores a batch with ``depth`` vectorised numpy steps per tree. Only the arrays (a few tens of
kilobytes, fixed by ``trees`` and ``depth``) travel to the executors; the corpus is scored in one
pass without a shuffle.

Edge cases: a null text is scored as the empty text; null ids never match a label; labels that are
null are left out; with no labels, or one class only, every score is the share of label 1 (0.5 with
none); repeated rows are scored alike; extra columns pass through, except those named like the
columns that are added.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep_texts, map_texts

SYMBOLS = "#%&*$!|.,:;=<>@/-\"'()_"
STATS = (
    ["log_bytes", "upper", "digit", "space", "newline", "non_ascii", "punct", "entropy"]
    + [f"sym_{i}" for i in range(len(SYMBOLS))]
    + ["log_words", "word_len", "unique_words", "top_word", "same_as_previous", "longest_word"]
    + ["symbol_words", "upper_words", "lines", "line_bytes", "repeated_lines", "longest_line", "repeated_pairs"]
)
THRESHOLD = 0.3


def document_stats(texts: list[bytes]) -> np.ndarray:
    """One row of ``STATS`` per text."""
    out = np.zeros((len(texts), len(STATS)))
    sym = np.frombuffer(SYMBOLS.encode(), np.uint8)
    for row, text in zip(out, texts, strict=True):
        n = len(text)
        if not n:
            continue
        h = np.bincount(np.frombuffer(text, np.uint8), minlength=256) / n
        upper, lower = h[65:91].sum(), h[97:123].sum()
        p = h[h > 0]
        row[:8] = (
            np.log1p(n),
            upper / max(upper + lower, 1e-9),
            h[48:58].sum(),
            h[32] + h[9:14].sum(),
            h[10],
            h[128:].sum(),
            h[33:48].sum() + h[58:65].sum() + h[91:97].sum() + h[123:127].sum(),
            -(p * np.log2(p)).sum(),
        )
        row[8 : 8 + len(sym)] = h[sym]
        words = text.split()
        lines = text.split(b"\n")
        k = 8 + len(sym)
        if words:
            w = len(words)
            counts = Counter(words)
            row[k : k + 8] = (
                np.log1p(w),
                sum(map(len, words)) / w,
                len(counts) / w,
                max(counts.values()) / w,
                sum(map(eq, words, words[1:])) / w,
                max(map(len, words)),
                sum(not x[-1:].isalnum() and x[-1] < 128 for x in words) / w,
                sum(map(bytes.isupper, words)) / w,
            )
            row[k + 12] = 1 - len(set(zip(words, words[1:], strict=False))) / max(w - 1, 1)
        row[k + 8 : k + 12] = (
            len(lines),
            n / len(lines),
            1 - len(set(lines)) / len(lines),
            np.log1p(max(map(len, lines))),
        )
    return out


@dataclass
class Trees:
    """Complete trees of one depth: ``feature`` and ``cut`` per inner node (heap order), ``leaf``
    per leaf; a row goes right where its statistic is above the cut."""

    base: float
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**self.depth - 1)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def boost(x: np.ndarray, y: np.ndarray, trees=80, depth=4, bins=64, rate=0.15, l2=1.0, least=5.0) -> Trees:
    """Fit the trees to statistics ``x`` and labels ``y`` (0 or 1)."""
    inner, leaves = 2**depth - 1, 2**depth
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        base = 0.0 if not len(y) else float(np.clip(np.log(max(share, 1e-9) / max(1 - share, 1e-9)), -20, 20))
        return Trees(base, depth, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T, strict=True)])
    base = float(np.log(share / (1 - share)))
    margin = np.full(len(y), base)
    model = Trees(base, depth, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.zeros(width)
            choice = np.full((width, 2), -1)
            at = node - first
            total_g, total_h = np.bincount(at, g, width), np.bincount(at, h, width)
            for f, codes in enumerate(binned):
                slot = at * bins + codes
                gl = np.bincount(slot, g, width * bins).reshape(width, bins).cumsum(1)[:, : len(cuts[f])]
                hl = np.bincount(slot, h, width * bins).reshape(width, bins).cumsum(1)[:, : len(cuts[f])]
                if not gl.shape[1]:
                    continue
                gr, hr = total_g[:, None] - gl, total_h[:, None] - hl
                gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - (total_g**2 / (total_h + l2))[:, None]
                gain[(hl < least * 0.05) | (hr < least * 0.05)] = 0
                k = gain.argmax(1)
                better = gain[np.arange(width), k] > best + 1e-9
                best[better] = gain[np.arange(width), k][better]
                choice[better] = np.stack([np.full(width, f), k], 1)[better]
            right = np.zeros(len(y), np.int64)
            for j, (f, k) in enumerate(choice):
                if f >= 0:
                    model.feature[t, first + j], model.cut[t, first + j] = f, cuts[f][k]
                    here = at == j
                    right[here] = binned[f][here] > k
            node = 2 * node + 1 + right
        at = node - inner
        model.leaf[t] = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + l2)
        margin += model.leaf[t][at]
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = 20_000, label: str = "quality", **params) -> Trees:
    """Fit on at most ``sample`` rows of ``docs`` that have a label."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = (
        labels.select("doc_id", F.col(label).cast("double").alias("__y"))
        .dropna()
        .orderBy(*order, "__y")
        .limit(sample)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    stats = map_texts(rows, lambda t: {"__x": list(document_stats(t))}, "__x array<double>")
    got = stats.orderBy(*order, "__y", "__x").limit(sample).toPandas()
    x = np.asarray(got["__x"].tolist(), float).reshape(len(got), len(STATS))
    return boost(x, got["__y"].to_numpy(float), **params)


def score(docs: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the text, with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""

    def run(texts):
        s = model.score(document_stats(texts))
        return {"score": s, "predicted": (s >= threshold).astype(np.int32)}

    return map_texts(docs, run, "score double, predicted int")


def accepted(docs: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold."""
    return keep_texts(docs, lambda texts: model.score(document_stats(texts)) >= threshold)

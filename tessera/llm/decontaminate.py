"""Benchmark decontamination by a prefix-filtered join on rare shingles.

A window is ``size`` consecutive words of an item (an item with fewer words is one window). A document
word inside any occurrence of a window is hit. Since a window must occur whole, its set join needs one prefix
token: its rarest shingle of three words (of fewer in shorter windows), by the number of places in all documents. Pass 1
counts the items' shingles over all documents. Pass 2 looks up the chosen shingles in each document; a place
proposes a window at a start that the shingle's position in it fixes; proposals that start before or end behind the
document fall away (position and length bounds), and the rest are verified word by word.

Nothing of the documents is shuffled but counts: a text stays in its task. The items' tables
go to the tasks in segments of about ``SEGMENT_WORDS`` words, dealt by hash; a larger benchmark
takes more segments, never larger ones. A long item is cut into parts that overlap by all words of a window but one, so
its windows are dealt to several segments. The documents of a slice are laid end to end with a gap that no window crosses,
so that numpy handles millions of places at once.

Edge cases: null and empty texts have no words; items without words have no windows; items of equal text are all
reported; the windows of items with a null id hit words as others do, but no list names them; repeated rows are judged alike; extra columns pass through, except those named like
the added ones; with an empty benchmark nothing is hit.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tessera.llm.common import slices, tidy, written

WINDOW = 13
SHINGLE = 3
SEGMENT_WORDS = 500_000
PART_WORDS = 50_000
CHUNK = 200_000
#: bytes of words, A-Z lower-cased; every other ASCII byte becomes a space
TO_WORDS = bytes(c + 32 if 65 <= c < 91 else c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else 32 for c in range(256))
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TO_WORDS).split()


def shingle_keys(ids: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit key for each place where ``k`` words that occur in the benchmark stand; 0 elsewhere."""
    n = len(ids) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = ids.astype(np.uint64)
    key = np.full(n, k, np.uint64)
    known = np.ones(n, bool)
    for j in range(k):
        part = wide[j : j + n]
        known &= part > 0
        key = (key ^ (part * MIX[j])) * MIX[(j + 1) % 3]
        key ^= key >> np.uint64(29)
    return np.where(known, key | np.uint64(1), np.uint64(0))


class Keys:
    """Sorted keys with a bit filter in front."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.flag = np.zeros(1 << 20, bool)
        self.flag[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places whose key is here, and its number."""
        at = np.flatnonzero(self.flag[(keys >> np.uint64(44)).astype(np.int64)])
        at = at[keys[at] > 0]
        number = np.searchsorted(self.keys, keys[at])
        number = np.minimum(number, max(len(self.keys) - 1, 0))
        same = self.keys[number] == keys[at] if len(self.keys) else np.zeros(len(at), bool)
        return at[same], number[same]


class Windows:
    """The windows of a segment of items."""

    def __init__(self, items: list[tuple[int | None, bytes]], size: int = WINDOW):
        self.word_ids: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = defaultdict(set)
        for item, text in items:  # a null item has windows, but no name
            ids = [self.word_ids.setdefault(w, len(self.word_ids) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - size + 1) if ids else 0):
                owners[tuple(ids[i : i + size])].add(item)
        self.rows = sorted(owners)
        self.items = [sorted(i for i in owners[w] if i is not None) for w in self.rows]
        self.lengths = np.array([len(w) for w in self.rows], np.int64)
        self.matrix = np.zeros((len(self.rows), size), np.int32)
        for row, w in zip(self.matrix, self.rows, strict=True):
            row[: len(w)] = w
        self.kinds = sorted({min(SHINGLE, len(w)) for w in self.rows})
        each = [shingle_keys(np.array(w, np.int32), min(SHINGLE, len(w))) for w in self.rows]
        self.shingles = each
        self.all = Keys(np.concatenate(each) if each else np.zeros(0, np.uint64))

    def choose(self, counts: np.ndarray) -> None:
        """Take each window's rarest shingle as its prefix; windows with one that occurs nowhere go."""
        key, offset, window = [], [], []
        for w, keys in enumerate(self.shingles):
            n = counts[np.searchsorted(self.all.keys, keys)]
            j = int(n.argmin())
            if n[j]:
                key.append(keys[j])
                offset.append(j)
                window.append(w)
        keys = np.array(key, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.prefix = Keys(keys)
        self.offset, self.window = np.array(offset, np.int64)[order], np.array(window, np.int64)[order]
        self.first = np.searchsorted(keys[order], self.prefix.keys)
        self.many = np.diff(np.append(self.first, len(keys)))
        del self.shingles, self.rows, self.all

    def lay(self, texts: list[bytes], gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The texts' word numbers end to end behind gaps, where each text starts, and its words."""
        get = self.word_ids.get
        parts, starts, counts, at = [np.zeros(gap, np.int32)], [], [], gap
        for text in texts:
            words = words_of(text)
            starts.append(at)
            counts.append(len(words))
            parts.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
            parts.append(np.zeros(gap, np.int32))
            at += len(words) + gap
        return np.concatenate(parts), np.array(starts, np.int64), np.array(counts, np.int64)

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, window) of every occurrence."""
        starts, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        size = self.matrix.shape[1]
        for k in self.kinds:
            at, number = self.prefix.places(shingle_keys(ids, k))
            ends = np.cumsum(self.many[number])
            for lo in range(0, int(ends[-1]) if len(ends) else 0, CHUNK):
                proposal = np.arange(lo, min(lo + CHUNK, int(ends[-1])))
                hit = np.searchsorted(ends, proposal, side="right")
                slot = self.first[number[hit]] + proposal - (ends[hit] - self.many[number[hit]])
                window = self.window[slot]
                start = at[hit] - self.offset[slot]
                ok = (start >= 0) & (start + self.lengths[window] <= len(ids))
                start, window = start[ok], window[ok]
                for j in range(size):
                    inside = self.lengths[window] > j
                    same = ~inside | (ids[np.minimum(start + j, len(ids) - 1)] == self.matrix[window, j])
                    start, window = start[same], window[same]
                starts.append(start)
                windows.append(window)
        return np.concatenate(starts), np.concatenate(windows)


def contaminated(share: int = 20) -> F.Column:
    """Whether at least one word in ``share`` is hit, and one at all."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def item_parts(items: DataFrame, size: int) -> DataFrame:
    """``item_id, words, n``: each item's words, joined by spaces, in parts of about ``PART_WORDS``. Two neighbouring parts
    share ``size - 1`` words, so each window of the item stands in just one part. Items without words have none, and
    repeated rows count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            ids, words, n = [], [], []
            for item, text in zip(part.column(0).to_pylist(), texts, strict=True):
                own = words_of(text)
                windows = max(1, len(own) - size + 1) if own else 0
                for lo in range(0, windows, PART_WORDS):
                    cut = own[lo : min(lo + PART_WORDS, windows) + size - 1]
                    ids.append(item)
                    words.append(b" ".join(cut))
                    n.append(len(cut))
            cols = [pa.array(ids, pa.int64()), pa.array(words, pa.binary()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["item_id", "words", "n"])

    return written(items.mapInArrow(tidy(run), "item_id long, words binary, n long").distinct(), "benchmark-parts")


def find_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", size: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans`` (hit runs of words, first and last) and ``items``
    (sorted ids of the items with occurring windows); without the text unless ``keep_text``."""
    spark = docs.sparkSession
    bench = item_parts(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")), size)
    amount = bench.agg(F.sum("n")).first()[0] or 0
    segments = max(1, -(-amount // SEGMENT_WORDS))
    kinds = StructType.fromDDL("n_words long, n_hit long, spans array<struct<first:long,last:long>>, items array<long>")
    kept = [c for c in docs.columns if c not in kinds.fieldNames()]
    out = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in kinds}
    )
    for s in range(segments):
        rows = bench.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(segments)) == s).orderBy("item_id", "words").collect()
        windows = Windows([(r["item_id"], bytes(r["words"])) for r in rows], size)
        windows.choose(count_shingles(docs, windows, text))
        shared = spark.sparkContext.broadcast(windows)
        out = out.mapInArrow(tidy(marker(shared, kept.index(text), len(kept), kinds)), out.schema)
    return out if keep_text else out.drop(text)


def count_shingles(docs: DataFrame, windows: Windows, text: str) -> np.ndarray:
    """How many places of all documents each shingle of the windows has."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    def run(batches):
        own = shared.value
        counts = np.zeros(len(own.all.keys), np.int64)
        for _, texts in slices(batches, "__text"):
            ids, _, _ = own.lay(texts, SHINGLE)
            for k in own.kinds:
                counts += np.bincount(own.all.places(shingle_keys(ids, k))[1], minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["at", "n"])

    got = (
        docs.select(F.col(f"`{text}`").cast("string").alias("__text"))
        .mapInArrow(tidy(run), "at long, n long")
        .groupBy("at")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most the shingles of a segment
    )
    counts = np.zeros(len(windows.all.keys), np.int64)
    counts[got["at"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return counts


def marker(shared, text_at: int, kept: int, added: StructType):
    """Find a segment's windows in the texts and add them to what earlier segments found."""
    types = [to_arrow_type(f.dataType) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        gap = windows.matrix.shape[1]
        for batch in batches:
            name = batch.schema.names[text_at]
            for part, texts in slices(iter([batch]), name):
                ids, starts, counts = windows.lay(texts, gap)
                at, window = windows.occurrences(ids)
                doc = np.searchsorted(starts, at, side="right") - 1
                items: list[set] = [set(x or ()) for x in part.column(kept + 3).to_pylist()]
                for d, w in set(zip(doc.tolist(), window.tolist(), strict=True)):
                    items[d].update(windows.items[w])
                cover = np.zeros(len(ids) + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + windows.lengths[window], -1)
                for d, before in enumerate(part.column(kept + 2).to_pylist()):
                    for span in before or ():
                        cover[starts[d] + span["first"]] += 1
                        cover[starts[d] + span["last"] + 1] -= 1
                edge = np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).astype(np.int8)]))
                lo, hi = np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)
                owner = np.searchsorted(starts, lo, side="right") - 1
                spans: list[list] = [[] for _ in texts]
                n_hit = np.zeros(len(texts), np.int64)
                for d, a, b in zip(owner.tolist(), lo.tolist(), hi.tolist(), strict=True):
                    spans[d].append({"first": a - int(starts[d]), "last": b - int(starts[d]) - 1})
                    n_hit[d] += b - a
                new = [counts, n_hit, spans, [sorted(i) for i in items]]
                cols = [pa.array(v, t) for v, t in zip(new, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], *cols], names=batch.schema.names)

    return run

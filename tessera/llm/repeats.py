"""Removal of repeated byte strings: a distributed suffix sort by bucket-pointer refinement.

Every byte is removed that lies in a string of ``SIZE`` bytes which also starts anywhere else in the table. The
suffixes that are sorted are those at anchors: each string of SIZE bytes holds SIZE - Q + 1 places of Q bytes, and
the place with the smallest hash is its anchor, so equal strings have the same anchor at the same offset.

1. Initial buckets: anchors by the hash of their Q bytes. A block of texts (some megabytes) sends an entry per distinct
   context (the bytes that a string around the anchor may reach), packed by slices of the hash space. A bucket with one
   entry is final: nothing there repeats. Entries of equal context settle each other, without regard to the rest: all their strings
   repeat. A block whose bucket has many contexts deals them out by context instead and sends two
   stand-ins to the bucket, so a hot bucket never meets in one task.
2. Buckets with several contexts are refined. The context's bytes left and right of the anchor are read, and every place there gets
   the identifier of its ``GRAM`` bytes' bucket. The bucket of an anchor and its next n bytes is refined from that of n - GRAM bytes
   by sorting on (bucket identifier, bucket identifier of the later offset n - GRAM), outwards on either side, so each
   refinement is used again GRAM bytes on; the first GRAM - 1 lengths go byte by byte. The bucket of a whole string at offset d is the
   pair of the left identifier for d bytes and the right identifier for the rest. A string repeats if its last bucket holds more than
   one occurrence.
   Buckets with more than ``LIMIT`` contexts are refined by an aggregation over (offset, string digest) rows instead.
3. The strings found give spans, which are joined to their texts, merged and cut out.

Edge cases: null and empty texts have no bytes; texts shorter than SIZE stay whole; occurrences may overlap and lie in the same
document; rows that are equal in id and text repeat each other; null ids are kept; extra columns pass through,
except those named like the added ones.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import set_aside, slices, tidy, written

SIZE = 400
Q = 200
CHUNK = 1 << 20
BLOCK_TEXT = 8 << 20
LOCALLY_HOT = 64
LIMIT = 4096
BATCH = 8_192
CONTEXTS = 4_096
#: Bytes of the buckets at later offsets; as many as fit a 64-bit number when each has 257 values.
GRAM = 7
#: Rows of an Arrow batch that a task sends on.
ROWS = 1 << 16
BASE = 0x9E3779B97F4A7C15
PLACE = np.uint64((1 << 21) - 1)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class Roller:
    """Polynomial hashes of substrings, modulo 2^64."""

    def __init__(self, chunk: int, size: int):
        self.chunk, length = chunk, chunk + 4 * size
        inverse = np.uint64(pow(BASE, -1, 2**64))
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(length, BASE, np.uint64)]), dtype=np.uint64)
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(length, inverse, np.uint64)]), dtype=np.uint64)
        self.value = mix(np.arange(1, 257, dtype=np.uint64))

    def prefix(self, text: np.ndarray) -> np.ndarray:
        out = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self.value[text] * self.power[: len(text)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mix((prefix[at + length] - prefix[at]) * self.back[at])


def window_argmin(x: np.ndarray, w: int) -> np.ndarray:
    """The distinct places of the smallest of every ``w`` neighbouring values, by their upper bits and
    then from the left. At most 2^21 values."""
    low = (x & ~PLACE) | np.arange(len(x), dtype=np.uint64)
    n, span = len(x) - w + 1, 1
    while span * 2 <= w:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    low = np.minimum(low[:n], low[w - span : w - span + n]) & PLACE
    return low[np.concatenate([[True], low[1:] != low[:-1]])].astype(np.int64)


def anchors(text: bytes, roller: Roller, size: int, q: int) -> tuple[np.ndarray, ...]:
    """Anchor, left and right reach, hash of the anchor's bytes, hash of the context."""
    data, w = np.frombuffer(text, np.uint8), size - q + 1
    found = []
    for lo in range(0, len(data) - size + 1, roller.chunk):
        a, b = max(0, lo - size), min(len(data), lo + roller.chunk + 2 * size)
        prefix = roller.prefix(data[a:b])
        places = np.arange(lo - a, min(lo + roller.chunk - 1 + size, len(data)) - q + 1 - a)
        at = window_argmin(roller.of(prefix, places, q), w) + (lo - a)
        left = np.minimum(at + a, size - q)
        right = np.minimum(len(data) - (at + a) - q, size - q)
        context = roller.of(prefix, at - left, left + q + right) + mix((left * size + right).astype(np.uint64))
        found.append((at + a, left, right, roller.of(prefix, at, q), mix(context)))
    at, left, right, bucket, context = (np.concatenate(c) for c in zip(*found, strict=True))
    keep = np.unique(at, return_index=True)[1]
    return at[keep], left[keep], right[keep], bucket[keep], context[keep]


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted disjoint spans (touching ones joined) from rows of start and end."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    end = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > end[:-1]])
    last = np.append(np.flatnonzero(first)[1:] - 1, len(spans) - 1)
    return np.stack([spans[first, 0], end[last]], 1)


def merged_by_row(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The merged spans of each row key."""
    if not len(row):
        return row, start, end
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    cut = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    parts = [merged(np.stack([start[a:b], end[a:b]], 1)) for a, b in zip(cut, np.append(cut[1:], len(row)), strict=True)]
    spans = np.concatenate(parts)
    return np.repeat(row[cut], [len(p) for p in parts]), spans[:, 0], spans[:, 1]


#: kinds: 0 packed entries of a slice, 1 a span
ENTRY_SCHEMA = "kind int, slice long, payload binary, row long, start long, end long"
#: kinds: 1 a span, 2 a context of a bucket that is to be refined
FOUND_SCHEMA = "kind int, bucket long, row long, start long, end long, left int, right int, weight int"


def batch_of(schema: str, n: int, **columns) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names = [c.split() for c in schema.split(", ")]
    arrays = [pa.array(columns[k], types[t]) if k in columns else pa.nulls(n, types[t]) for k, t in names]
    return pa.RecordBatch.from_arrays(arrays, names=[k for k, _ in names])


def span_batch(schema: str, row, start, end) -> pa.RecordBatch:
    return batch_of(schema, len(row), kind=np.ones(len(row), np.int32), row=row, start=start, end=end)


def packed(columns: list[np.ndarray]) -> bytes:
    raw = b"".join(np.ascontiguousarray(c.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(c.T).view(np.int64).ravel() for c in raw]


def slice_of(key: np.ndarray, n_slices: int) -> np.ndarray:
    """The slice of a hash. Its bits are scattered anew, as an anchor's hash is the smallest of its window: nearly all are near 0."""
    return ((mix(key) >> np.uint64(32)) * np.uint64(n_slices) >> np.uint64(32)).astype(np.int64)


def entries(docs: DataFrame, n_slices: int, size: int, q: int) -> DataFrame:
    """The entries of each block's contexts, and the spans that a block settles by itself. ``docs``: row, text."""
    hot = LOCALLY_HOT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(CHUNK, size)

        def finish(found):
            row, at, left, right, bucket, context = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.lexsort((context, bucket))
            row, at, left, right, bucket, context = (c[order] for c in (row, at, left, right, bucket, context))
            new_bucket = np.concatenate([[True], bucket[1:] != bucket[:-1]])
            new = new_bucket | np.concatenate([[True], context[1:] != context[:-1]])
            first = np.flatnonzero(new)
            many = np.diff(np.append(first, len(row)))
            settled = np.repeat(many > 1, many)
            spans = merged_by_row(row[settled], (at - left)[settled], (at + q + right)[settled])
            yield span_batch(ENTRY_SCHEMA, *spans)
            weight = np.where(many > 1, 2, 1)
            row, at, left, right, bucket, context = (c[first] for c in (row, at, left, right, bucket, context))
            of = np.cumsum(new_bucket[first]) - 1
            per = np.bincount(of)
            aside = per[of] >= hot
            part = slice_of(np.where(aside, context, bucket), n_slices)
            # stand-ins: an entry that settles nothing but shows that the bucket has more contexts (weight 0)
            stand = np.flatnonzero(aside & new_bucket[first])
            pick = np.concatenate([np.arange(len(row)), stand])
            part = np.concatenate([part, slice_of(bucket[stand], n_slices)])
            weight = np.concatenate([np.where(aside, weight + 2, weight), np.zeros(len(stand), np.int64)])
            columns = [*(c.view(np.int64)[pick] for c in (bucket, context)), row[pick], at[pick], left[pick], right[pick], weight]
            order = np.lexsort((columns[3], columns[2], part))
            part, columns = part[order], [c[order] for c in columns]
            cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            data = [packed([c[a:b] for c in columns]) for a, b in zip(cut, np.append(cut[1:], len(part)), strict=True)]
            yield batch_of(ENTRY_SCHEMA, len(cut), kind=np.zeros(len(cut), np.int32), slice=part[cut], payload=data)

        found, held = [], 0
        for part, texts in slices(batches):
            for row, text in zip(part.column(0).to_pylist(), texts, strict=True):
                if len(text) >= size:
                    at, left, right, bucket, context = anchors(text, roller, size, q)
                    found.append((np.full(len(at), row), at, left, right, bucket, context))
                    held += len(text)
                    if held >= BLOCK_TEXT:
                        yield from finish(found)
                        found, held = [], 0
        if found:
            yield from finish(found)

    return docs.select("row", "text").mapInArrow(tidy(run), ENTRY_SCHEMA)


def meet(parts: list[bytes], q: int) -> Iterator[pa.RecordBatch]:
    """Settle the entries of a slice: spans of equal contexts, and one entry per context of the other buckets."""
    columns: list[list[np.ndarray]] = [[] for _ in range(7)]
    while parts:
        for c, values in zip(columns, unpacked(parts.pop(), 7), strict=True):
            c.append(values)
    for i, c in enumerate(columns):  # only one column is held twice
        columns[i] = np.concatenate(c)
        c.clear()
    order = np.lexsort((columns[6] == 0, columns[1], columns[0]))
    for i in range(7):
        columns[i] = columns[i][order]
    bucket, context, row, at, left, right, weight = columns
    new_bucket = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    new = new_bucket | (context != np.concatenate([context[:1], context[:-1]]))
    first = np.flatnonzero(new)
    size_of = np.diff(np.append(first, len(row)))
    real = np.add.reduceat((weight > 0).astype(np.int64), first)  # entries that aren't stand-ins
    heavy = np.maximum.reduceat(np.where(weight > 2, weight - 2, weight), first) > 1
    repeated = heavy | (real > 1)
    mine = np.repeat(repeated, size_of) & np.isin(weight, (1, 3))
    yield span_batch(FOUND_SCHEMA, *merged_by_row(row[mine], (at - left)[mine], (at + q + right)[mine]))
    of = np.cumsum(new_bucket[first]) - 1
    contexts = np.bincount(of)
    dealt = np.bincount(of, np.maximum.reduceat((weight > 2) | (weight == 0), first)) > 0  # others are elsewhere
    go = ((contexts > 1) | dealt)[of] & (real > 0)
    at_first = first[go]
    yield batch_of(
        FOUND_SCHEMA, len(at_first), kind=np.full(len(at_first), 2, np.int32), bucket=bucket[at_first], row=row[at_first],
        start=at[at_first], left=left[at_first], right=right[at_first], weight=np.where(repeated[go], 2, 1),
    )


def in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most ``ROWS``."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield batch.slice(lo, ROWS)


def settle(packed_entries: DataFrame, q: int) -> DataFrame:
    def run(batches):
        now, held = None, []
        for batch in batches:
            for s, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if s != now and held:
                    yield from in_pieces(meet(held, q))
                    held = []
                now = s
                held.append(data.as_py())
        if held:
            yield from in_pieces(meet(held, q))

    n = int(packed_entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return packed_entries.select("slice", "payload").repartition(n, "slice").sortWithinPartitions("slice").mapInArrow(tidy(run), FOUND_SCHEMA)


def numbered(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].ravel()


def outwards(bucket: np.ndarray, side: np.ndarray) -> list[np.ndarray]:
    """The identifiers of each bucket together with the next 0, 1, 2, ... values of ``side`` (0: none, else a byte and 1)."""
    reach = side.shape[1]
    later, kinds = np.zeros((len(side), max(0, reach - GRAM + 1)), np.int64), 1
    if later.size:
        for i in range(GRAM):
            later *= 257
            later += side[:, i : i + later.shape[1]]
        later = numbered(later.ravel()).astype(np.int32).reshape(later.shape)
        kinds = int(later.max()) + 1
    ids = [numbered(bucket)]
    for n in range(1, reach + 1):
        if n < GRAM:
            ids.append(numbered(ids[-1] * 257 + side[:, n - 1]))
        else:
            ids.append(numbered(ids[n - GRAM] * kinds + later[:, n - GRAM]))
    return ids


def refine(bucket: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray, weight: np.ndarray, contexts: list[bytes], size: int, q: int):
    """For contexts of whole buckets: (number of the context, start, end) of the strings that repeat."""
    reach = size - q
    before, after = np.zeros((len(at), reach), np.int16), np.zeros((len(at), reach), np.int16)
    for i, c in enumerate(contexts):
        data = np.frombuffer(c, np.uint8)
        before[i, : left[i]] = data[: left[i]][::-1] + np.int16(1)
        after[i, : right[i]] = data[left[i] + q :] + np.int16(1)
    to_right = outwards(bucket, after)
    to_left = outwards(np.zeros(len(at), np.int64), before)
    out = []
    for d in range(reach + 1):
        fits = np.flatnonzero((left >= d) & (right >= reach - d))
        if len(fits):
            last = numbered(to_right[reach - d][fits] * (len(at) + 1) + to_left[d][fits])
            again = fits[(np.bincount(last, weight[fits]) > 1)[last]]
            out.append(np.stack([again, at[again] - d, at[again] - d + size]))
    return np.concatenate(out, axis=1) if out else np.zeros((3, 0), np.int64)


CONTEXT_SCHEMA = "bucket long, row long, at long, left int, right int, weight int, hot boolean, context binary"


def contexts(docs: DataFrame, wanted: DataFrame, q: int) -> DataFrame:
    """The bytes of the wanted contexts; as often as rows with the text's key occur.
    ``wanted``: row, bucket, at, left, right, weight, hot."""
    each = wanted.groupBy("row").agg(
        F.collect_list(F.struct("bucket", "at", "left", "right", "weight", "hot")).alias("list")  # of one text
    )
    joined = docs.select("row", "text").join(each, "row").select("row", "list", "text")
    names = [c.split()[0] for c in CONTEXT_SCHEMA.split(", ")]

    def run(batches):
        types = {"context": pa.binary(), "hot": pa.bool_(), "left": pa.int32(), "right": pa.int32(), "weight": pa.int32()}

        def batch_of_contexts(out):
            return pa.RecordBatch.from_arrays([pa.array(out[n], types.get(n, pa.int64())) for n in names], names=names)

        out: dict[str, list] = {n: [] for n in names}
        for part, texts in slices(batches):
            for row, asked, text in zip(part.column(0), part.column(1), texts, strict=True):
                for c in asked.as_py():
                    for n in ("bucket", "at", "left", "right", "weight", "hot"):
                        out[n].append(c[n])
                    out["row"].append(row.as_py())
                    out["context"].append(text[c["at"] - c["left"] : c["at"] + q + c["right"]])
                    if len(out["row"]) >= CONTEXTS:
                        yield batch_of_contexts(out)
                        out = {n: [] for n in names}
        if out["row"]:
            yield batch_of_contexts(out)

    return joined.mapInArrow(tidy(run), CONTEXT_SCHEMA)


def refined(found: DataFrame, size: int, q: int) -> DataFrame:
    """row, start and end of what repeats in buckets of bounded size."""

    def run(batches):
        held: list = []

        def flush(rows):
            rows = list({(r[1], r[2]): r for r in rows}.values())
            bucket, row, at, left, right, weight, context = zip(*rows, strict=True)
            row, at, left, right, weight = (np.array(c, np.int64) for c in (row, at, left, right, weight))
            who, start, end = refine(np.array(bucket, np.int64), at, left, right, weight, list(context), size, q)
            cols = merged_by_row(row[who], start, end)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["row", "start", "end"])

        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) >= BATCH and r[0] != held[-1][0]:
                    yield flush(held)
                    held = []
                held.append(r)
        if held:
            yield flush(held)

    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        found.select("bucket", "row", "at", "left", "right", "weight", "context")
        .repartition(n, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(tidy(run), "row long, start long, end long")
    )


def aggregated(found: DataFrame, size: int, q: int) -> DataFrame:
    """The same for hot buckets, by rows of (digest of the string and its offset from the anchor, weight)."""
    schema = "digest binary, weight int, row long, start long"

    def run(batches):
        for batch in batches:
            for bucket, row, at, left, right, weight, context in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                starts = range(0, left + q + right - size + 1)
                digests = [xxhash.xxh128_digest(context[i : i + size] + struct.pack("<qq", bucket, left - i)) for i in starts]
                n = len(digests)
                cols = [pa.array(digests, pa.binary()), pa.array([weight] * n, pa.int32()), pa.array([row] * n, pa.int64())]
                cols.append(pa.array([at - left + i for i in starts], pa.int64()))
                yield pa.RecordBatch.from_arrays(cols, names=["digest", "weight", "row", "start"])

    found = found.dropDuplicates(["row", "at"])
    strings = written(found.select("bucket", "row", "at", "left", "right", "weight", "context").mapInArrow(tidy(run), schema), "repeat-strings")
    again = strings.groupBy("digest").agg(F.sum("weight").alias("n")).where("n > 1").select("digest")
    return strings.join(again, "digest").select("row", "start", (F.col("start") + size).alias("end"))


def repeated_spans(docs: DataFrame, size: int = SIZE, q: int = Q) -> DataFrame:
    """row, start, end: spans (not yet merged) of the bytes in repeated strings. ``docs``: row (a key of id
    and text) and text."""
    spark = docs.sparkSession
    amount = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), amount >> 24)
    blocks = written(entries(docs, n_slices, size, q), "repeat-entries")
    found = written(settle(blocks.filter("kind = 0"), q), "repeat-found")
    key = ["bucket", "row", "at", "left", "right"]
    open_ = found.filter("kind = 2").withColumnRenamed("start", "at").groupBy(*key).agg(F.sum("weight").cast("int").alias("weight"))
    open_ = written(open_, "repeat-open")
    per_bucket = open_.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    large = written(per_bucket.where(F.col("n") > LIMIT), "repeat-hot")  # a row per LIMIT contexts at most
    wanted = open_.join(large, "bucket", "left").withColumn("hot", F.col("n").isNotNull()).drop("n")
    read = written(contexts(docs, wanted, q), "repeat-contexts")
    spans = blocks.filter("kind = 1").select("row", "start", "end").union(found.filter("kind = 1").select("row", "start", "end"))
    spans = spans.union(refined(read.filter(~F.col("hot")), size, q))
    hot = read.filter("hot")
    if hot.limit(1).count():
        spans = spans.union(aggregated(hot, size, q))
    return spans


def remove_repeats(docs: DataFrame, size: int = SIZE, q: int | None = None, text: str = "text", id_col: str = "doc_id", as_text: bool = False) -> DataFrame:
    """``docs`` with ``text`` replaced by ``kept`` (the remaining bytes), ``n_bytes``, ``n_removed`` and ``spans``. ``as_text``: ``kept``
    is a string, without what is left of a character that was cut apart."""
    q = q or size // 2
    added = ["kept", "n_bytes", "n_removed", "spans"]
    own = [c for c in docs.columns if c not in (text, *added)]
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    keyed = docs.select(*[F.col(f"`{c}`") for c in own], body.alias("__text"))
    keyed = keyed.withColumn("__row", F.xxhash64(F.col(f"`{id_col}`").cast("long"), "__text"))
    spans = repeated_spans(keyed.select(F.col("__row").alias("row"), F.col("__text").alias("text")), size, q)
    each = spans.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__spans"))  # of one text
    each = each.withColumnRenamed("row", "__of")
    joined = keyed.join(each, keyed["__row"] == each["__of"], "left").select(*[F.col(f"`{c}`") for c in own], "__spans", "__text")
    schema = keyed.select(*[F.col(f"`{c}`") for c in own]).schema
    for field in StructType.fromDDL(f"kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>"):
        schema = schema.add(field)

    def run(batches):
        for part, texts in slices(batches, "__text"):
            kept, removed, cut = [], [], []
            for found, body in zip(part.column(len(own)).to_pylist(), texts, strict=True):
                rows = merged(np.array([(s["start"], s["end"]) for s in found or ()], np.int64).reshape(-1, 2)).tolist()
                edges = [0, *(e for r in rows for e in r), len(body)]
                kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                removed.append(len(body) - len(kept[-1]))
                cut.append([{"start": a, "end": b} for a, b in rows])
            kept = pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
            cols = [kept, pa.array([len(t) for t in texts], pa.int64()), pa.array(removed, pa.int64())]
            cols.append(pa.array(cut, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
            yield pa.RecordBatch.from_arrays([*part.columns[: len(own)], *cols], names=schema.fieldNames())

    return joined.mapInArrow(tidy(run), schema)


def without_repeats(docs: DataFrame, size: int = SIZE, text: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with what is left of each text (of a character that is cut apart, nothing stays), and its length in
    ``length_col`` if there is such a column; texts of which nothing is left go. Other columns stay whatever their names."""
    plain, own = set_aside(docs, "doc_id", text)
    # one Python task a row's way: two in a row would be two workers a core, each with its own memory
    cut = remove_repeats(plain, size, text=text, as_text=True).filter((F.col("n_bytes") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    names = [c for c in cut.columns if c not in ("kept", "n_bytes", "n_removed", "spans")]
    out = cut.select(*names, F.col("kept").alias("__text"))
    if length_col in own:
        out = out.withColumn(own[length_col], F.length("__text").cast(docs.schema[length_col].dataType))
    return out.select(*[F.col("__text") if c == text else F.col(f"`{n}`") for c, n in own.items()]).toDF(*docs.columns)

"""Exact n-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles (64-bit hashes; two documents link when
``100 * |A and B| >= T * |A or B|``). Its parity sketch flips one bit per shingle, so that the Hamming distance of
two sketches is never above the size of the symmetric difference. Sizes are cut into bands; in a band, linked
sets differ in at most D shingles, so if the sketch is split into more than D parts, some part is equal in
both (pigeonhole). A set is listed under its own band and under the lower band that a smaller partner may
be in. A part is keyed by the XOR of its shingles' hashes.
Parts with few shingles, or none, are alike in many documents. With P parts, at least P - D of a linked pair's are equal,
and equal parts are equally light: so a document with fewer than P - D light parts leaves them out and still loses no
partner, whose heavy parts are always listed. P is chosen so that nearly all documents can.

1. ``sketch_blocks``: each block of texts (some megabytes) yields the documents' sizes and set digests, the edges
   between its own documents that share a key, and one entry per key, sorted and packed by slices of
   the key space. So a hot key has one entry per block, however many documents hold it.
2. ``shared_keys``: each slice joins the entries of all blocks and connects the holders of each key, with as few edges as
   connect them in the slice. The packed entries are only shuffled, never written.
3. Equal sets become one class. Components of the star edges are candidate families; every linked pair lies inside one.
   A family of more than ``BLOCK`` classes, which often hangs together by passages that many documents share, is cut into the
   families that connect by a shingle among each set's rarest (``finer``).
4. ``verify``: the classes of a family meet in a task. Size and Hamming bounds drop most pairs, the rest are verified on the
   sets, except pairs that are already connected. A family of more than ``BLOCK`` classes is dealt by size (linked
   sets are in the same or in neighbouring steps) and into blocks; each block first meets the first block of its step (the hub).
   In a second round, classes that the hubs connected form blocks of their own, and only blocks of neighbouring steps
   and different components meet.

So no bucket is expanded into pairs of rows, no link between different components is lost, and the components are exact
(but for collisions of 64-bit shingle hashes, and of 128-bit set digests).

Edge cases: null and empty texts have no shingles and link with nothing; a text of fewer words than a shingle has one shingle,
its whole sequence; rows with equal ids are documents of their own that share an id; null ids are kept (a component of null ids
only has a null id); extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import HOT_KEYS, joined_back, set_aside, slices, tidy, written
from tessera.llm.components import components

RATIO = 1.5
KEY_BITS = 48
BLOCK = 256
SKETCH_BITS = 2048
SLICE_TEXT = 8 << 20
WORDS_KEPT = 200_000
#: Documents or edges of a block that go to one slice.
PLAIN = 256
M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingle hashes of texts; the hashes of words are cached."""

    def __init__(self, k: int):
        self.k, self.cache = k, {}
        self.weights = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1) ** 3) % 2**64 | 1) for i in range(k)]

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct hashes of each text."""
        return [self.of(t) for t in texts]

    def of(self, text: bytes) -> np.ndarray:
        words, cache = text.lower().split(), self.cache
        if len(cache) > WORDS_KEPT:
            cache.clear()
        for w in set(words):
            if w not in cache:
                cache[w] = xxhash.xxh64_intdigest(w)
        return self.hashes(np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)))

    def hashes(self, words: np.ndarray) -> np.ndarray:
        n = len(words)
        if n == 0:
            return words
        if n < self.k:
            total = sum((words[i : i + 1] * self.weights[i] for i in range(1, n)), words[:1] * self.weights[0])
            return mix(total + np.uint64(n))
        total = words[: n - self.k + 1] * self.weights[0]
        for i in range(1, self.k):
            total = total + words[i : n - self.k + 1 + i] * self.weights[i]
        return np.unique(mix(total))


def digest(s: np.ndarray) -> tuple[int, int]:
    """A 128-bit digest of a set, as two signed numbers."""
    if not len(s):
        return 0, 0
    data = s.tobytes()
    return tuple(int(np.uint64(xxhash.xxh64_intdigest(data, seed=x)).astype(np.int64)) for x in (1, 2))


class Bands:
    """The bands of sizes, for a threshold of ``percent``."""

    def __init__(self, percent: int):
        self.percent, self.edges, self.parts = percent, [1], []

    def upto(self, size: int) -> None:
        while self.edges[-1] <= size:
            low = self.edges[-1]
            high = max(low + 1, math.floor(low * RATIO))
            self.edges.append(high)
            most = (high - 1) * (100 - self.percent) // self.percent  # largest difference of linked sets
            self.parts.append((*self.split(high - 1, most), most))

    @staticmethod
    def split(size: int, most: int) -> tuple[int, int]:
        """(parts, light): as many parts that, of a set of that size, more than ``most`` hold at least ``light``
        shingles, with two deviations to spare; the largest ``light`` that fewer than 1.6 times ``most`` parts allow."""
        for light in (4, 3, 2, 1):
            for parts in range(most + 2, max(most + 3, int(1.6 * (most + 1)) + 2)):
                mean = size / parts
                share = math.exp(-mean) * sum(mean**i / math.factorial(i) for i in range(light))
                if parts * (1 - share) - 2 * math.sqrt(parts * share * (1 - share)) >= most + 1:
                    return parts, light
        return most + 2, 1

    def of(self, size: int) -> list[int]:
        """The band of a size, and the lower ones that hold possible smaller partners."""
        self.upto(size)
        band = int(np.searchsorted(self.edges, size, side="right")) - 1
        least = -(-self.percent * size // 100)
        out = [band]
        while out[-1] > 0 and self.edges[out[-1]] - 1 >= least:
            out.append(out[-1] - 1)
        return out

    def keys(self, s: np.ndarray) -> np.ndarray:
        """The keys of a set: its digest's and those of its parts."""
        out = [np.array([xxhash.xxh64_intdigest(s.tobytes())], np.uint64)]
        spread = mix(s ^ M3)
        for band in self.of(len(s)):
            parts, light, most = self.parts[band]
            if most == 0:
                continue  # only equal sets link: the digest's key finds them
            part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # sorted, as the set is
            first = np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1)))
            value, number = np.bitwise_xor.reduceat(spread, first), part[first]
            heavy = np.diff(np.append(first, len(s))) >= light
            differ = min(most, len(s) * (100 - self.percent) // self.percent)
            if parts - heavy.sum() < parts - differ:
                value, number = value[heavy], number[heavy]
            else:  # too many light parts to leave out
                none = np.setdiff1d(np.arange(parts, dtype=np.uint64), number)
                value, number = np.append(value, np.zeros(len(none), np.uint64)), np.append(number, none)
            out.append(mix(value + mix(number * M3 + np.uint64(band + 1))))
        return np.concatenate(out) >> np.uint64(64 - KEY_BITS)


def packed(columns: list[np.ndarray]) -> bytes:
    """Arrays of 64-bit numbers, byte by byte, compressed."""
    raw = b"".join(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=3).compress(raw)


def unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(c.T).view("<u8").ravel() for c in raw]


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few pairs as connect what the pairs (a, b) connect: the smallest of a component, and each other one of it."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    low = np.arange(len(nodes))
    while True:
        before, least = low, np.minimum(low[u], low[v])
        low = before.copy()
        for at in (u, v, before[u], before[v]):
            np.minimum.at(low, at, least)
        low = low[low]
        if np.array_equal(low, before):
            break
    other = np.flatnonzero(low != np.arange(len(nodes)))
    return nodes[low[other]], nodes[other]


FOUND_SCHEMA = "kind int, ref long, other long, doc_id long, row long, n long, d1 long, d2 long"
BLOCK_SCHEMA = f"{FOUND_SCHEMA}, slice int, payload binary"
FOUND, NAMES = ([c.split()[0] for c in s.split(", ")] for s in (FOUND_SCHEMA, BLOCK_SCHEMA))


def record(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    types = {"kind": pa.int32(), "slice": pa.int32(), "payload": pa.binary()}
    arrays = [pa.array(columns[c], types.get(c, pa.int64())) if c in columns else pa.nulls(n, types.get(c, pa.int64())) for c in NAMES]
    return pa.RecordBatch.from_arrays(arrays, names=NAMES)


def row_key(id_col: str, text_col: str) -> F.Column:
    """A key of a row's id and text."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def sketch_blocks(docs: DataFrame, words: int, percent: int, n_slices: int) -> DataFrame:
    """Rows of three kinds: 0 a document, 1 an edge between two documents of a block, 2 the packed entries of a slice. The first
    two go to any slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block = TaskContext.get().partitionId(), 0
        shingler, bands = Shingler(words), Bands(percent)

        def finish(ids, row, sets):
            first_ref = (task << 40) | (block << 24)
            found = [digest(s) for s in sets]
            ref = first_ref + np.arange(len(ids))
            anywhere = (task * 31 + block + np.arange(len(ids)) // PLAIN) % n_slices
            n = [len(s) for s in sets]
            d1, d2 = zip(*found, strict=True)
            yield record(kind=np.zeros(len(ids), np.int32), ref=ref, doc_id=ids, row=row, n=n, d1=d1, d2=d2, slice=anywhere)
            seen, keys, holder = {}, [], []
            for i, (s, d) in enumerate(zip(sets, found, strict=True)):
                if len(s) and seen.setdefault(d, i) == i:
                    keys.append(bands.keys(s))
                    holder.append(np.full(len(keys[-1]), i))
            if not keys:
                return
            key, who = np.concatenate(keys), np.concatenate(holder)
            order = np.argsort(key, kind="stable")
            key, who = key[order], who[order]
            first = np.flatnonzero(np.diff(key, prepend=key[:1] + np.uint64(1)))
            star = who[np.repeat(first, np.diff(np.append(first, len(key))))]
            root, own = spanning(star[who != star], who[who != star])
            if len(own):
                yield record(kind=np.ones(len(own), np.int32), ref=first_ref + own, other=first_ref + root, slice=anywhere[: len(own)])
            key, who = key[first], who[first]
            part = ((key >> np.uint64(KEY_BITS - 32)) * np.uint64(n_slices) >> np.uint64(32)).astype(np.int64)
            cut = np.flatnonzero(np.diff(part, prepend=-1))
            payloads = []
            for a, b in zip(cut, np.append(cut[1:], len(key)), strict=True):
                gaps = np.diff(key[a:b], prepend=np.uint64(0))
                payloads.append(packed([gaps, who[a:b].astype(np.uint64)]))
            yield record(kind=np.full(len(cut), 2, np.int32), ref=np.full(len(cut), first_ref), slice=part[cut], payload=payloads)

        ids, row, sets, held = [], [], [], 0
        for part, texts in slices(batches):
            ids += part.column(0).to_pylist()
            row += part.column(1).to_pylist()
            sets += shingler.sets(texts)
            held += sum(map(len, texts))
            if held >= SLICE_TEXT or len(ids) >= 1 << 20:
                yield from finish(ids, row, sets)
                ids, row, sets, held, block = [], [], [], 0, block + 1
        if ids:
            yield from finish(ids, row, sets)

    return docs.select("doc_id", row_key("doc_id", "text").alias("row"), "text").mapInArrow(tidy(run), BLOCK_SCHEMA)


def shared_keys(blocks: DataFrame) -> DataFrame:
    """The documents and edges of the blocks, and the edges that connect the holders of each key in the packed entries."""

    def star(payloads: list[tuple[int, bytes]]):
        key, who = [], []
        for ref, data in payloads:
            gaps, local = unpacked(data, 2)
            key.append(np.cumsum(gaps, dtype=np.uint64))
            who.append(local.astype(np.int64) + ref)
        key, who = np.concatenate(key), np.concatenate(who)
        order = np.lexsort((who, key))
        key, who = key[order], who[order]
        first = np.flatnonzero(np.diff(key, prepend=key[:1] + np.uint64(1)))
        hub = who[np.repeat(first, np.diff(np.append(first, len(key))))]
        root, other = spanning(hub[hub != who], who[hub != who])
        return record(kind=np.ones(len(other), np.int32), ref=other, other=root).select(FOUND)

    def run(batches):
        at, held = None, []
        for batch in batches:
            entry = pc.equal(batch["kind"], 2)
            if (plain := batch.filter(pc.invert(entry))).num_rows:
                yield plain.select(FOUND)
            for s, ref, data in zip(*(c.to_pylist() for c in batch.filter(entry).select(["slice", "ref", "payload"]).columns), strict=True):
                if s != at and held:
                    yield star(held)
                    held = []
                at = s
                held.append((ref, data))
        if held:
            yield star(held)

    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(n, "slice").sortWithinPartitions("slice").mapInArrow(tidy(run), FOUND_SCHEMA)


def parity(s: np.ndarray) -> np.ndarray:
    """The parity sketch of a set."""
    bit = (s >> np.uint64(8)) % np.uint64(SKETCH_BITS)
    return np.packbits(np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS) & 1 == 1)


class Forest:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.root(i)] = self.root(j)


def links(classes: list[int], joined: list[int], sides: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect the classes of two sides (0: the hub, 1: the other; all are of side 0 in a
    single block). ``joined``: components known before; pairs inside one aren't looked at."""
    n = len(classes)
    forest, first = Forest(n), {}
    for i, c in enumerate(joined):
        if first.setdefault(c, i) != i:
            forest.join(i, first[c])
    size = np.array([len(s) for s in sets], np.int64)
    sketch = np.stack([parity(s) for s in sets]).view(np.uint64)
    side = np.array(sides)
    inner = len(set(sides)) == 1
    out = []
    for i in range(n):
        rest = np.arange(i + 1, n) if inner else np.arange(n)[side == 1] if side[i] == 0 else np.zeros(0, int)
        low, high = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
        rest = rest[100 * low >= percent * high]
        if not len(rest):
            continue
        most = (size[rest] + size[i]) * (100 - percent) // (100 + percent)
        rest = rest[np.bitwise_count(sketch[rest] ^ sketch[i]).sum(1) <= most]
        for j in rest.tolist():
            if forest.root(i) != forest.root(j):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    forest.join(i, j)
                    out.append((classes[i], classes[j]))
    return out


def verify(meetings: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that connect what the links of each meeting connect, from rows (meeting, class, joined, side, shingles): the rows
    of a meeting stand together."""

    def run(batches):
        at, rows = None, []

        def meet():
            got = np.array(links(*(list(c) for c in zip(*rows, strict=True)), percent), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in spanning(got[:, 0], got[:, 1])], names=["a", "b"])

        for batch in batches:
            for key, c, j, side, data in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if key != at and rows:
                    yield meet()
                    rows = []
                at = key
                rows.append((c, j, side, np.frombuffer(data, "<u8")))
        if rows:
            yield meet()

    n = int(meetings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        meetings.select("meeting", "class", "joined", "side", "shingles")
        .repartition(n, "meeting")
        .sortWithinPartitions("meeting", "side", "class")
        .mapInArrow(tidy(run), "a long, b long")
    )


def shingle_sets(rows: DataFrame, words: int) -> DataFrame:
    """Replace the text by n, d1, d2 and the packed shingle set."""
    kept = [c for c in rows.columns if c != "text"]
    schema = rows.select(*kept).schema.add("n", "long").add("d1", "long").add("d2", "long").add("shingles", "binary")

    def run(batches):
        shingler = Shingler(words)
        for part, texts in slices(batches):
            sets = shingler.sets(texts)
            found = [digest(s) for s in sets]
            cols = [part.column(i) for i in range(len(kept))]
            cols += [pa.array([len(s) for s in sets]), pa.array([a for a, _ in found]), pa.array([b for _, b in found])]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([s.tobytes() for s in sets], pa.binary())], names=schema.fieldNames())

    return rows.select(*kept, "text").mapInArrow(tidy(run), schema)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, the smallest id of its component, and first: whether
    the row's key (``row``: of id and text) is the one that stands for its component."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    amount = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), amount >> 24)
    found = written(shared_keys(sketch_blocks(docs, words, percent, n_slices)), "jaccard-found")
    rows = found.filter("kind = 0").select("ref", "doc_id", "row", "n", "d1", "d2")
    edges = found.filter("kind = 1").select(F.col("other").alias("a"), F.col("ref").alias("b")).distinct()
    total = rows.count()

    key = ["n", "d1", "d2"]
    classes = written(
        rows.filter("n > 0")
        .groupBy(*key)
        .agg(
            F.min("ref").alias("class"),
            F.min("doc_id").alias("least"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("lead"),
            F.min("row").alias("text_of"),
        ),
        "jaccard-classes",
    )
    named = written(rows.filter("n > 0").join(classes.select(*key, "class"), key).select("ref", "class"), "jaccard-named")
    between = (
        edges.join(named.select(F.col("ref").alias("a"), F.col("class").alias("x")), "a")
        .join(named.select(F.col("ref").alias("b"), F.col("class").alias("y")), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    family = components(between)
    sizes = family.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    members = (
        joined_back(family, sizes, ["component"], F.col("members"), total)
        .select(F.col("node").alias("class"), F.col("component").alias("family"), "members")
        .join(classes, "class")
    )
    wanted = members.select("text_of", "class", "family", "members", *[F.col(k).alias(f"own_{k}") for k in key])
    held = wanted.join(docs.select(row_key("doc_id", "text").alias("text_of"), "text"), "text_of").drop("text_of")
    sets = shingle_sets(held, words).filter("n = own_n and d1 = own_d1 and d2 = own_d2").drop("own_n", "own_d1", "own_d2", *key)
    if rows.groupBy("row").count().where("count > 1").limit(1).count():  # rows that are equal in id and text
        sets = sets.dropDuplicates(["class"])
    sets = written(sets, "jaccard-sets")
    large = sets.where(F.col("members") > BLOCK)
    one = {"step": F.lit(-1), "blocks": F.lit(1).cast("long"), "block": F.lit(0).cast("long")}
    sets = sets.where(F.col("members") <= BLOCK).select("class", "family", "shingles", *[c.alias(k) for k, c in one.items()])
    if large.limit(1).count():
        sets = sets.union(written(dealt(large, finer(large, percent), percent, total), "jaccard-large"))

    hub = sets.filter("block = 0").withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    others = sets.filter("block > 0").withColumn("to", F.col("block"))
    meetings = hub.withColumn("side", F.lit(0)).union(others.withColumn("side", F.lit(1)))
    first = written(
        verify(meetings.withColumn("meeting", F.concat_ws(":", "family", "step", "to")).withColumn("joined", F.col("class")), percent), "jaccard-links"
    )
    large = sets.filter("step >= 0")
    known = components(first)
    if large.limit(1).count():
        later = written(second_round(large, known, percent), "jaccard-links")
        if later.limit(1).count():
            known = components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).union(later))
    joined = known.select(F.col("node").alias("class"), "component")
    whole = classes.join(joined, "class", "left").select(*key, "least", "lead", F.coalesce("component", "class").alias("group"))
    first = whole.groupBy("group").agg(F.min("least").alias("component_id"), F.min("lead").alias("lead"), F.count(F.lit(1)).alias("size"))
    by_class = joined_back(whole.drop("least", "lead"), first, ["group"], F.col("size"), total).select(*key, "component_id", F.col("lead.row").alias("lead_row"))
    linked = (
        rows.filter("n > 0")
        .join(by_class, key)
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id", "row", (F.col("row") == F.col("lead_row")).alias("first"))
    )
    return linked.union(rows.filter("n = 0").select("doc_id", F.lit(0).cast("long"), "doc_id", "row", F.lit(True)))


def tokens_of(family: int, data: bytes) -> np.ndarray:
    """The shingles of a set as tokens: equal tokens are equal shingles of a family."""
    return mix(np.frombuffer(data, "<u8") ^ mix(np.array([family], np.int64).view(np.uint64) * M3)).view(np.int64)


def set_tokens(sets: DataFrame) -> DataFrame:
    """A row (class, token) for each of a set's shingles."""

    def run(batches):
        for batch in batches:
            for c, family, data in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                token = tokens_of(family, data)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(token), c), pa.int64()), pa.array(token)], names=["class", "token"])

    return sets.select("class", "family", "shingles").mapInArrow(tidy(run), "class long, token long")


def first_tokens(sets: DataFrame, percent: int, hot: list[tuple[int, int]]) -> DataFrame:
    """What is known of each set's first d + 1 tokens, if tokens of ``hot`` (token, holders) come last. Rows of four kinds: 0 a token that may be
    among them, 1 one that is, 2 a hot one that is, with one of its sets in a batch, 3 an edge (class, root) between sets of a batch that share such a one."""
    schema = "kind int, class long, n long, token long, root long"
    names = [c.split()[0] for c in schema.split(", ")]
    hot = np.array(sorted(hot), np.int64).reshape(-1, 2)
    rank = np.empty(len(hot), np.int64)
    rank[np.lexsort((hot[:, 0], hot[:, 1]))] = np.arange(len(hot))

    def rows(kind, classes, n=None, token=None, root=None):
        columns = [pa.nulls(len(classes), pa.int64()) if c is None else pa.array(c, pa.int64()) for c in (classes, n, token, root)]
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(classes), kind), pa.int32()), *columns], names=names)

    def run(batches):
        for batch in batches:
            at, who = [], []
            for c, family, data in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                token = tokens_of(family, data)
                n = len(token)
                place = np.searchsorted(hot[:, 0], token)
                known = np.append(hot[:, 0], 0)[place] == token
                known &= place < len(hot)
                plain, first = token[~known], n * (100 - percent) // 100 + 1
                yield rows(int(len(plain) <= first), np.full(len(plain), c), np.full(len(plain), n), plain)
                if len(plain) < first:
                    own = place[known]
                    at.append(own[np.argsort(rank[own])][: first - len(plain)])
                    who.append(np.full(len(at[-1]), c))
            if not at:
                continue
            at, who = np.concatenate(at), np.concatenate(who)
            order = np.lexsort((who, at))
            at, who = at[order], who[order]
            begin = np.flatnonzero(np.diff(at, prepend=-1))
            yield rows(2, who[begin], token=hot[at[begin], 0])
            star = np.repeat(who[begin], np.diff(np.append(begin, len(at))))
            root, other = spanning(star[star != who], who[star != who])
            yield rows(3, other, root=root)

    return sets.select("class", "family", "shingles").mapInArrow(tidy(run), schema)


def finer(sets: DataFrame, percent: int) -> DataFrame:
    """The families of large families: (class, family), without classes that link with none.

    Of a set of n shingles, at most d = n * (100 - percent) / 100 are missing in a linked one: so a set with more than d that no other
    set holds links with none and goes. If all shingles of those left are in one order, the first that a linked pair shares is among the first
    d + 1 of either. They are ordered by the number of sets that hold them, the hot ones last (more than a 10,000th of all rows, so
    10,000 at most): a set's hot ones among its first d + 1 are known from the set alone, so they are settled by batch, without a row for
    each holder, and the others' holders are only looked up for sets that have more than d + 1 of them."""
    counted = written(set_tokens(sets).groupBy("token").agg(F.count(F.lit(1)).alias("holders"), F.min("class").alias("least")), "jaccard-holders")
    total = counted.agg(F.sum("holders")).first()[0] or 0
    hot = [tuple(r) for r in counted.where(F.col("holders") > max(1, total // HOT_KEYS)).select("token", "holders").collect()]
    alone = counted.where("holders = 1").groupBy(F.col("least").alias("class")).agg(F.count(F.lit(1)).alias("alone"))
    still = sets.join(alone, "class", "left").where(f"coalesce(alone, 0) <= octet_length(shingles) div 8 * {100 - percent} div 100")
    found = written(first_tokens(still, percent, hot), "jaccard-tokens")

    holders = found.where("kind < 2").groupBy("token").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    size = found.where("kind = 0").groupBy("class").agg(F.count(F.lit(1)).alias("plain"))
    own = found.where("kind = 0").join(holders, "token").groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("holders", "token"))).alias("own"))
    own = own.join(size, "class").withColumn("first", F.expr(f"cast(n * {100 - percent} div 100 + 1 - (plain - size(own)) as int)")).where("first > 0")
    own = own.select("class", F.explode(F.slice("own", F.lit(1), F.col("first"))).alias("t")).select("class", "t.token")
    first = written(own.union(found.where("kind in (1, 2)").select("class", "token")), "jaccard-first")
    root = first.groupBy("token").agg(F.min("class").alias("root"), F.count(F.lit(1)).alias("holders")).where("holders > 1")
    star = first.join(root, "token").select("class", "root").union(found.where("kind = 3").select("class", "root"))
    return components(star, "class", "root").select(F.col("node").alias("class"), F.col("component").alias("family"))


def dealt(sets: DataFrame, family: DataFrame, percent: int, total: int) -> DataFrame:
    """``sets`` in the families given, those of more than ``BLOCK`` sets dealt into steps of size and blocks."""
    sizes = family.groupBy("family").agg(F.count(F.lit(1)).alias("members"))
    placed = joined_back(family, sizes, ["family"], F.col("members"), total).join(sets.drop("family", "members"), "class")
    step = step_of(F.octet_length("shingles") / 8, percent)
    placed = written(placed.withColumn("step", F.when(F.col("members") > BLOCK, step).otherwise(-1)), "jaccard-finer")
    units = placed.groupBy("family", "step").agg(F.count(F.lit(1)).alias("in_step"))
    placed = joined_back(placed, units, ["family", "step"], F.col("in_step"), total)
    blocks = F.ceil(F.col("in_step") / BLOCK).cast("long")
    return placed.select("class", "family", "shingles", "step", blocks.alias("blocks"), F.pmod(F.xxhash64("class"), blocks).alias("block"))


def step_of(size: F.Column, percent: int) -> F.Column:
    """The step of a size; sizes of linked sets are a little less than one step apart at most."""
    return F.floor(F.log(size.cast("double")) / F.lit(math.log(100 / percent * 1.001))).cast("int")


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id. Rows without words all stay."""
    plain, own = set_aside(docs, id_col, text_col)
    found = near_duplicates(docs, words, percent, id_col, text_col)
    leads = written(
        found.filter("first and n_shingles > 0").groupBy(F.col("row").alias("__lead")).agg(F.count(F.lit(1)).alias("__rows")), "jaccard-leads"
    )
    keyed = plain.select("*", row_key(id_col, text_col).alias("__row"))
    stay = keyed.join(leads.where("__rows = 1"), F.col("__row") == F.col("__lead"))
    several = leads.where("__rows > 1")  # rows that are equal in id and text
    if several.limit(1).count():
        stay = stay.union(keyed.join(several, F.col("__row") == F.col("__lead")).dropDuplicates(["__row"]))
    bare = ~F.coalesce(F.col(text_col), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    return stay.select(*own.values()).union(plain.filter(bare)).toDF(*docs.columns)


def second_round(sets: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The links between the components that the hub round left, in families of several blocks."""
    sets = sets.join(known.select(F.col("node").alias("class"), F.col("component").alias("joined")), "class", "left").withColumn(
        "joined", F.coalesce("joined", "class")
    )
    count = sets.groupBy("family", "step", "joined").agg(F.count(F.lit(1)).alias("members"))
    own = F.when(F.col("members") >= BLOCK // 2, F.col("joined"))
    count = written(count.withColumn("whole", own), "jaccard-pools")
    pools = (
        count.groupBy("family", "step", "whole")
        .agg(F.sum("members").alias("pool"))
        .withColumn("parts", F.ceil(F.col("pool") / BLOCK).cast("int"))
    )
    pool = F.concat_ws(":", "family", "step", F.coalesce("whole", F.lit(-1)))
    placed = written(
        sets.join(count.select("family", "step", "joined", "whole"), ["family", "step", "joined"])
        .withColumn("pool", pool)
        .join(pools.select(pool.alias("pool"), "parts"), "pool")
        .withColumn("place", F.pmod(F.xxhash64("class", F.lit(1)), F.col("parts")).cast("int"))
        .select("family", "pool", "whole", "place", "class", "joined", "shingles"),
        "jaccard-placed",
    )
    places = pools.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("family", "step", "whole", pool.alias("pool"), "place")
    left = places.select("family", *[F.col(c).alias(f"{c}_a") for c in ("step", "whole", "pool", "place")])
    right = places.select("family", *[F.col(c).alias(f"{c}_b") for c in ("step", "whole", "pool", "place")])
    later = (F.col("pool_a") < F.col("pool_b")) | ((F.col("pool_a") == F.col("pool_b")) & (F.col("place_a") <= F.col("place_b")))
    same = F.col("whole_a").isNotNull() & F.col("whole_a").eqNullSafe(F.col("whole_b"))
    near = F.abs(F.col("step_a") - F.col("step_b")) <= 1
    pairs = left.join(right, "family").where(near & later & ~same)
    meeting = F.concat_ws("/", "pool_a", "place_a", "pool_b", "place_b").alias("meeting")
    loop = (F.col("pool_a") == F.col("pool_b")) & (F.col("place_a") == F.col("place_b"))
    ends = pairs.select(meeting, F.col("pool_a").alias("pool"), F.col("place_a").alias("place"), F.lit(0).alias("side")).union(
        pairs.where(~loop).select(meeting, F.col("pool_b"), F.col("place_b"), F.lit(1))
    )
    return verify(placed.join(ends, ["pool", "place"]), percent)

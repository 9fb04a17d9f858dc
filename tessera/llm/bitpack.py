"""Token files: ids packed in the fewest bits that hold the vocabulary.

Texts are encoded in ascending id order and written as binary files of bounded size. A file has a
header, the ids and token offsets of its documents, the byte offsets of its blocks, and the blocks:
``BLOCK`` ids each, packed little-endian in ``bits`` bits. A block starts on a byte, so ids can be read from
any place without what stands before, and numpy unpacks a whole block at once.

Spark range-sorts the texts, encodes them in the sorted tasks, and its own text writer puts one file per row
into the shared folder (so a lost task leaves no half-written file; each file ends with the writer's newline,
which the reader doesn't look at); the ``binaryFile`` source reads them. A file knows its task and number,
so the order of the tokens over all files follows from the files alone.

Encoding uses a bounded cache of the pieces between ASCII white space, which no token of a
white-space-dropping vocabulary crosses; new pieces go through the tokenizer in batches. A Python worker keeps its
cache from task to task, in two generations: what isn't met while one fills is forgotten with it.

Edge cases: null and empty texts have the end id alone; null ids come first; rows with equal ids stand side by
side, ordered by text; an empty table writes no file and reads as an empty table; one document may be
longer than a file's bound and then has a file of its own; other columns are left out.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import scratch, slices, tidy, written

BLOCK = 4096
FILE_IDS = 4 << 20
#: Pieces of a generation of the cache: two are kept.
CACHE = 500_000
#: Bits of numpy's own numbers
WHOLE = (8, 16, 32)
MAGIC = b"TOKBITS1"
HEAD = struct.Struct("<8sIIQQQQ")  # magic, bits, ids in a block, documents, ids, task, number


def width(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in WHOLE:
        return ids.astype(f"<u{bits // 8}").tobytes()
    if bits % 8 == 0:
        return ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : bits // 8].tobytes()
    return np.packbits((ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1 != 0, bitorder="little").tobytes()


def unpack(data: bytes | memoryview, n: int, bits: int) -> np.ndarray:
    if bits in WHOLE:
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    raw = np.frombuffer(data, np.uint8)
    if bits % 8 == 0:
        out = np.zeros((n, 4), np.uint8)
        out[:, : bits // 8] = raw[: n * bits // 8].reshape(n, bits // 8)
        return out.view("<u4").ravel()
    flat = np.unpackbits(raw, count=n * bits, bitorder="little").reshape(n, bits)
    return (flat.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


def to_file(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, bits: int, task: int, number: int) -> bytes:
    blocks = [pack(ids[i : i + BLOCK], bits) for i in range(0, len(ids), BLOCK)]
    return b"".join(
        [
            HEAD.pack(MAGIC, bits, BLOCK, len(doc_ids), len(ids), task, number),
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            bytes(d is None for d in doc_ids),
            np.cumsum([0, *counts], dtype="<u8").tobytes(),
            np.cumsum([0, *map(len, blocks)], dtype="<u8").tobytes(),
            *blocks,
        ]
    )


class TokenFile:
    """Random access to the bytes of a file."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        magic, self.bits, self.block, docs, self.n_ids, self.task, self.number = HEAD.unpack(self.data[: HEAD.size])
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEAD.size
        self.doc_ids = np.frombuffer(self.data, "<i8", docs, at)
        self.null = np.frombuffer(self.data, np.bool_, docs, at + 8 * docs)
        self.offsets = np.frombuffer(self.data, "<u8", docs + 1, at + 9 * docs)
        at += 9 * docs + 8 * (docs + 1)
        blocks = -(-self.n_ids // self.block)
        self.block_offsets = np.frombuffer(self.data, "<u8", blocks + 1, at)
        self.payload = at + 8 * (blocks + 1)

    def ids_of(self, b: int) -> np.ndarray:
        """The ids of a block."""
        n = min(self.block, self.n_ids - b * self.block)
        a, z = int(self.block_offsets[b]), int(self.block_offsets[b + 1])
        return unpack(self.data[self.payload + a : self.payload + z], n, self.bits)

    def read(self, lo: int, hi: int) -> np.ndarray:
        """The ids from lo up to hi, unpacking the blocks that hold them."""
        if hi <= lo:
            return np.zeros(0, np.uint32)
        first, last = lo // self.block, -(-hi // self.block)
        return np.concatenate([self.ids_of(b) for b in range(first, last)])[lo - first * self.block : hi - first * self.block]

    def crc32s(self) -> list[int]:
        """The crc32 of each document's ids as little-endian 32-bit numbers; each block is unpacked once."""
        ends, out, d = self.offsets.tolist(), [0] * len(self.doc_ids), 0
        for b in range(len(self.block_offsets) - 1):
            raw = memoryview(self.ids_of(b).astype("<u4", copy=False)).cast("B")
            at, end = b * self.block, b * self.block + len(raw) // 4
            while d < len(out) and ends[d] < end:
                out[d] = zlib.crc32(raw[4 * (max(ends[d], at) - at) : 4 * (min(ends[d + 1], end) - at)], out[d])
                if ends[d + 1] > end:
                    break
                d += 1
        return out


class PieceEncoder:
    """Encode texts by a cache of the ids of their pieces between ASCII white space.

    For a vocabulary that lower-cases, ends each word with ``</w>`` and splits letters from other characters, ASCII
    letters may be lower-cased, and a comma or full stop behind a word be cut off, before the pieces are
    looked up: there are fewer to encode. Of a new piece, signs behind its last ASCII letter or digit are encoded by themselves, as they are in many. New pieces of letters only are single words: they are encoded many at a
    time and told apart by the end marks (by themselves where the marks don't add up)."""

    END = "</w>"
    #: what no word of ASCII letters or digits holds, nor a token that begins in one
    SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    #: a comma or full stop at the end of a word, and one that follows anything else
    STOP = re.compile(rb"(?<=[a-z0-9])([,.])(?=[ \n]|\Z)")
    OTHER = re.compile(rb"[^a-z0-9\s][,.](?:[ \n]|\Z)")

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(self.END)]] = True

    def pieces(self, text: bytes) -> list[bytes]:
        if b"<|" in text:  # a special token may stand there, which is case-sensitive
            return text.split()
        low = text.lower()
        if self.OTHER.search(low):
            return self.STOP.sub(rb" \1", low).split()
        return low.replace(b", ", b" , ").replace(b". ", b" . ").replace(b".\n", b" .\n").split()

    def plain(self, pieces: list[bytes]) -> None:
        """Encode pieces one by one."""
        for i in range(0, len(pieces), 10_000):
            part = pieces[i : i + 10_000]
            got = self.tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)
            self.cache.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(part, got, strict=True))

    def together(self, words: list[tuple[bytes, str]]) -> None:
        """Encode pieces of letters, many in one text."""
        for i in range(0, len(words), 2_000):
            part = words[i : i + 2_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(w for _, w in part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part) or cuts[-1] != len(ids):
                self.plain([p for p, _ in part])
                continue
            data, at = ids.tobytes(), 0
            for (p, _), end in zip(part, (4 * cuts).tolist(), strict=True):
                self.cache[p] = data[at:end]
                at = end

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [self.pieces(t) for t in texts]
        if len(self.cache) > CACHE:
            self.cache, self.older = {}, self.cache
        new, cut = set(), []
        for p in set().union(*split).difference(self.cache):
            known = self.older.get(p)
            if known is not None:
                self.cache[p] = known
                continue
            head = p.rstrip(self.SIGNS)
            if head != p and head[-1:].isalnum() and b"<|" not in p:
                cut.append((p, head, p[len(head) :]))
                new.update(cut[-1][1:])
            else:
                new.add(p)
        letters, others = [], []
        for p in new.difference(self.cache):
            if (word := p.decode()).isalpha():
                letters.append((p, word))
            else:
                others.append(p)
        self.together(letters)
        self.plain(others)
        look = self.cache.__getitem__
        self.cache.update((p, look(head) + look(tail)) for p, head, tail in cut)
        return [b"".join(map(look, words)) for words in split]


@lru_cache(maxsize=1)
def encoder_for(tokenizer_path: str) -> PieceEncoder:
    """One encoder for all tasks of a Python worker."""
    return PieceEncoder(tokenizer_path)


def vocabulary_size(tokenizer_path: str) -> int:
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(tokenizer_path).get_vocab().values()) + 1


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col="doc_id", text_col="text") -> None:
    """Encode ``docs``, append ``end_id`` to each, and write the files to ``path``."""
    bits = width(max(vocabulary_size(tokenizer_path), end_id + 1))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        encoder = encoder_for(tokenizer_path)
        doc_ids, parts, held = [], [], 0

        def flush():
            data = to_file(doc_ids, [len(p) // 4 for p in parts], np.frombuffer(b"".join(parts), "<u4"), bits, task, number)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["content"])

        for part, texts in slices(batches):
            for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(texts), strict=True):
                if held and held + len(ids) // 4 > FILE_IDS:
                    yield flush()
                    doc_ids, parts, held, number = [], [], 0, number + 1
                doc_ids.append(doc_id)
                parts.append(ids + end)
                held += len(ids) // 4 + 1
        if doc_ids:
            yield flush()

    (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(tidy(run), "content binary")
        .select(F.col("content").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """A row per document of the files under ``path``: task, number, doc_id, local_start, n_tokens, ids_crc32."""
    schema = "task long, number long, doc_id long, local_start long, n_tokens long, ids_crc32 long"
    names = ["task", "number", "doc_id", "local_start", "n_tokens", "ids_crc32"]

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                f = TokenFile(content.as_buffer())
                n = len(f.doc_ids)
                lo, hi = f.offsets[:-1].astype(np.int64), f.offsets[1:].astype(np.int64)
                cols = [np.full(n, f.task), np.full(n, f.number), pa.array(f.doc_ids, pa.int64(), mask=f.null), lo, hi - lo, f.crc32s()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(tidy(run), schema)


def with_starts(tokens: DataFrame) -> DataFrame:
    """Replace the files' numbers and local starts by ``start``: the ids of all documents before."""
    files = tokens.groupBy("task", "number").agg(F.sum("n_tokens").alias("n"))
    tasks = files.groupBy("task").agg(F.sum("n").alias("n")).orderBy("task").collect()  # one row per task
    base = np.cumsum([0, *(r["n"] for r in tasks)]).tolist()
    spark = tokens.sparkSession
    bases = spark.createDataFrame([(r["task"], b) for r, b in zip(tasks, base, strict=False)], "task long, base long")
    inside = Window.partitionBy("task").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        files.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .join(F.broadcast(bases), "task")
        .select("task", "number", (F.col("base") + F.col("inside")).alias("offset"))
    )
    return tokens.join(offsets, ["task", "number"]).select(
        "doc_id", (F.col("offset") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_index(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder, read them back, and return per document
    doc_id, start, n_tokens and ids_crc32."""
    path = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id)
    return with_starts(written(read_tokens(docs.sparkSession, path), "token-rows"))

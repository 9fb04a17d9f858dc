"""BPE encoding and decoding through a table of distinct words.

1. A block of texts (some megabytes) is split into words, the units that no merge crosses, and sends its distinct
   words, packed by slices of their hash, to the word table.
2. Each slice encodes its distinct words once and answers every block with the ids of the words it asked for.
3. A block, its texts compressed, meets its answers: the ids of the words are joined back by position, and decoded again
   by a join of the ids with the vocabulary's pieces.

A hot word is sent once per block. No task holds more than the words of a block, or ``WORDS_KEPT`` words
of a slice (a slice of more forgets what it knows and encodes a word again when it is asked again).
Texts cross the network once, compressed; an occurrence of a word never does.

Steps 1 and 3 read the documents separately, so their partitions must come out alike both times, as those of a table
do; otherwise (``stable=False``) the documents are written first. A digest of each block is compared, so a difference would
raise an error.

Edge cases: null texts are encoded as empty ones (no ids); special tokens in a text get their ids, as the library does;
repeated rows are encoded alike; extra columns pass through, except those named like the added ones; an empty table gives
no rows.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import SLICE_BYTES, slices, tidy, written

BLOCK_TEXT = 16 << 20
BLOCK_ROWS = 1 << 16
WORDS_KEPT = 300_000
#: Fixed value: how the vocabulary's pre-tokenizer splits a text
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: the same for texts of ASCII characters
ASCII_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
#: ``block`` is a digest of the block's texts
ROW_SCHEMA = "block long, kind int, slice long, payload binary"


@lru_cache(maxsize=1)
def unassigned() -> re.Pattern:
    """Finds characters that Python's Unicode tables don't have: there the libraries' classes may differ."""
    own = [c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    ends = [i for i in range(1, len(own)) if own[i] != own[i - 1] + 1]
    runs = zip([0, *ends], [*ends, len(own)], strict=True)
    return re.compile("[" + "".join(f"{chr(own[a])}-{chr(own[b - 1])}" for a, b in runs) + "]")


@lru_cache(maxsize=2)
def words_for(tokenizer_path: str) -> Words:
    """One splitter for all tasks of a Python worker."""
    return Words(tokenizer_path)


class Words:
    """Split texts into words."""

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = added
        self.cut = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.any = regex.compile(SPLIT)
        self.ascii = re.compile(ASCII_SPLIT)

    #: white space of two or more characters, or at an end
    WIDE = re.compile(r"\s\s|\A\s|\s\Z")
    #: other white space than a space and a line feed
    OTHER = re.compile(r"[^\S \n]")
    #: a comma or full stop before white space that doesn't follow an ASCII letter or digit
    STOP = re.compile(r"[^A-Za-z0-9][,.](?:[ \n]|\Z)")

    def of(self, text: str) -> list[str]:
        """The text's words, as keys (see ``literal``).

        Between characters that aren't white space, a single space starts a word and a line feed is one; so does a comma
        or full stop behind an ASCII letter or digit and before white space. Where all white space is so, that
        gives the words without a pattern for each; other texts go through the pre-tokenizer's pattern."""
        if "\0" in text or self.WIDE.search(text) or self.OTHER.search(text):
            return [w[1:] if w[0] == " " and w[1:2] not in ("", "\0", "\n") else f"\0{w}" for w in self.pattern(text)]
        if not self.STOP.search(text):
            text = text.replace(", ", " \0, ").replace(". ", " \0. ").replace(".\n", " \0.\n")
        return f"\0{text}".replace("\n", " \n \0").split(" ")

    @staticmethod
    def literal(key: str) -> str:
        """What a key stands for: a line feed, what follows a NUL, or a space and the key."""
        return key if key == "\n" else key[1:] if key[:1] == "\0" else f" {key}"

    def pattern(self, text: str) -> list[str]:
        find = self.ascii.findall if text.isascii() else self.library if unassigned().search(text) else self.any.findall
        if not any(a in text for a in self.added):
            return find(text)
        out = []
        for i, part in enumerate(self.cut.split(text)):
            out += [part] if i % 2 else find(part)
        return [w for w in out if w]

    def library(self, text: str) -> list[str]:
        """Split by the library itself."""
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def encode(self, keys: list[str]) -> list[bytes]:
        """The ids of each key, as little-endian 32-bit numbers."""
        got = self.tokenizer.encode_batch_fast([self.literal(k) for k in keys], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in got]

    @staticmethod
    def by_slice(keys: set[str], n_slices: int) -> list[tuple[int, list[bytes]]]:
        """The keys as UTF-8, by slice."""
        by: dict[int, list[bytes]] = {}
        for k in keys:
            data = k.encode()
            by.setdefault(xxhash.xxh64_intdigest(data) % n_slices, []).append(data)
        return sorted(by.items())


class Pieces:
    """Decode ids by the bytes of the vocabulary's pieces."""

    def __init__(self, tokenizer):
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(printable)]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            known = all(c in byte for c in piece)
            self.pieces[i] = bytes(byte[c] for c in piece) if known else piece.encode()

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(errors="replace")


def pack_strings(items: list[bytes]) -> bytes:
    sizes = np.array(list(map(len, items)), "<u4")
    return zstandard.ZstdCompressor(level=3).compress(np.uint32(len(items)).tobytes() + sizes.tobytes() + b"".join(items))


def unpack_strings(data: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 + 4 * n
    at, out = 4 + 4 * n, []
    for end in ends.tolist():
        out.append(raw[at:end])
        at = end
    return out


def blocks_of(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[int, list[pa.RecordBatch], list[bytes]]]:
    """(digest, parts, texts) of the blocks of a task's rows."""
    parts, texts, held, digest = [], [], 0, xxhash.xxh64()
    for part, own in slices(batches, text):
        for i, t in enumerate(own):
            parts.append(part.slice(i, 1))
            texts.append(t)
            held += len(t)
            digest.update(len(t).to_bytes(8, "little") + t)
            if held >= BLOCK_TEXT or len(texts) >= BLOCK_ROWS:
                yield digest.intdigest() >> 1, parts, texts
                parts, texts, held, digest = [], [], 0, xxhash.xxh64()
    if parts:
        yield digest.intdigest() >> 1, parts, texts


def rows(block: int, kind: int, payloads: list[tuple[int, bytes]]) -> pa.RecordBatch:
    n = len(payloads)
    cols = [
        pa.array([block] * n, pa.int64()),
        pa.array([kind] * n, pa.int32()),
        pa.array([s for s, _ in payloads], pa.int64()),
        pa.array([p for _, p in payloads], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(cols, names=["block", "kind", "slice", "payload"])


def asked_words(docs: DataFrame, text: str, tokenizer_path: str, n_slices: int) -> DataFrame:
    """The distinct words of each block, by slice."""

    def run(batches):
        words = words_for(tokenizer_path)
        for block, _, texts in blocks_of(batches, "__text"):
            own: set[str] = set()
            for t in texts:
                own.update(words.of(t.decode()))
            yield rows(block, 0, [(s, pack_strings(ws)) for s, ws in words.by_slice(own, n_slices)])

    return docs.select(F.col(f"`{text}`").cast("string").alias("__text")).mapInArrow(tidy(run), ROW_SCHEMA)


def answers(asked: DataFrame, tokenizer_path: str) -> DataFrame:
    """Encode each slice's distinct words once; the words that each block asked for, and their ids."""

    def run(batches):
        words, known, now = words_for(tokenizer_path), {}, None
        for batch in batches:
            for block, _, part, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now or len(known) > WORDS_KEPT:
                    known, now = {}, part
                own = unpack_strings(payload)
                new = [w for w in own if w not in known]
                known.update(zip(new, words.encode([w.decode() for w in new]), strict=True))
                yield rows(block, 0, [(part, pack_strings(own + [known[w] for w in own]))])

    n = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return asked.repartition(n, "slice").sortWithinPartitions("slice").mapInArrow(tidy(run), ROW_SCHEMA)


def texts_of(docs: DataFrame, text: str) -> DataFrame:
    """The rows of each block, compressed."""

    def run(batches):
        for block, parts, _ in blocks_of(batches, text):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, parts[0].schema) as out:
                for p in pa.Table.from_batches(parts).combine_chunks().to_batches():
                    out.write_batch(p)
            yield rows(block, 1, [(0, zstandard.ZstdCompressor(level=6).compress(sink.getvalue()))])

    return docs.mapInArrow(tidy(run), ROW_SCHEMA)


def encode_decode(docs: DataFrame, tokenizer_path: str, text: str = "text", stable: bool = True) -> DataFrame:
    """``docs`` without the text, with ``ids`` (little-endian 32-bit numbers) and ``decoded``."""
    docs = docs if stable else written(docs, "bpe-documents")
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in (text, "ids", "decoded")]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("__text"))
    schema = docs.drop("__text").schema
    for field in StructType.fromDDL("ids binary, decoded string"):
        schema = schema.add(field)
    amount = docs.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_slices = max(n, amount >> 24)
    answered = answers(asked_words(docs, "__text", tokenizer_path, n_slices), tokenizer_path)

    def run(batches):
        words = words_for(tokenizer_path)
        pieces = Pieces(words.tokenizer)
        ids: dict[str, bytes] = {}
        now = None
        for batch in batches:
            for block, kind, _, payload in zip(*batch.columns, strict=True):
                if block.as_py() != now:
                    ids, now = {}, block.as_py()
                if kind.as_py() == 0:
                    got = unpack_strings(payload.as_py())
                    half = len(got) // 2
                    ids.update(zip([w.decode() for w in got[:half]], got[half:], strict=True))
                    continue
                for part in pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(payload.as_py())):
                    yield from joined(part, words, ids, pieces)

    def joined(part, words, ids, pieces):
        lo, encoded, decoded, size = 0, [], [], 0

        def cut(hi):
            own = part.slice(lo, hi - lo)
            cols = [*own.columns[: len(kept)], pa.array(encoded, pa.binary()), pa.array(decoded, pa.string())]
            return pa.RecordBatch.from_arrays(cols, names=[*kept, "ids", "decoded"])

        for i, text in enumerate(part.column(len(kept))):
            try:
                encoded.append(b"".join(map(ids.__getitem__, words.of(text.as_py() or ""))))
            except KeyError as e:
                raise RuntimeError("the documents' partitions came out differently: pass stable=False") from e
            decoded.append(pieces.decode(encoded[-1]))
            size += len(encoded[-1])
            if size >= SLICE_BYTES:  # batches of bounded size
                yield cut(i + 1)
                lo, encoded, decoded, size = i + 1, [], [], 0
        if encoded:
            yield cut(len(part))

    return (
        answered.unionByName(texts_of(docs, "__text"))
        .repartition(n, "block")
        .sortWithinPartitions("block", "kind")
        .mapInArrow(tidy(run), schema)
    )

"""Phrases whose words stand together more often than their parts would: level-wise mining with double-array tries.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words at spaces and tabs. A phrase is
2 to 4 words that follow each other in a piece; f counts all its places in a language. Phrases with f >= ``least`` are candidates.

1. Words are counted; those with f >= ``least`` get numbers (a number belongs to a word of one language), and the texts are
   written as numbers.
2. Level by level the texts propose phrases that are safe by Apriori: both phrases of one word less are in the trie. Proposals are
   added up over the tasks; sums below ``least`` can't be candidates. What remains is numbered and laid out as the
   trie's next level, a double array over the bytes of word numbers: node n goes by byte c to slot base[n] + c, if check there is n.
3. One pass over the texts counts all levels: numpy moves the states of all positions of a slice forward at once, a word a
   level, and counts the states reached by ``bincount``. The tasks' counts are added up.
4. Each way to cut a candidate into two parts is scored by floor(2000000 * f / (f(first) + f(rest))); the lowest counts. A candidate
   goes if a longer candidate that holds it has at least 80 % of its places. The rest is ranked.

Memory: the dictionary and each level are cut into pieces of at most ``PIECE`` words or ways (and one block of prefixes more);
a piece is what the driver lays out and what is broadcast, and a worker that meets more than ``KEEP`` pieces holds one at a time. Texts are read
in slices, long ones in parts. The work is texts times pieces: see README for what that means for very large corpora.

Edge cases: null texts have no words; a null language is ``und``, together with documents so labelled; repeated rows
count each; a language without candidates has no rows; ties go by f, then by the phrase's UTF-8 bytes; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import slices, tidy, written
from tessera.llm.words import cut_at_spaces

LEAST, LONGEST, SHARE, TOP = 30, 4, 80, 2000
#: Words of a dictionary piece and ways of a trie piece; pieces that a worker keeps open.
PIECE, KEEP = 1 << 18, 8
#: Prefixes that always share a trie piece, and the most prefixes of a piece.
BLOCK, REACH = 1 << 10, 1 << 21
#: Entries of a task's counters before they are sent on, and rows of the batches then.
ENTRIES, ROWS = 1 << 21, 1 << 18
#: A byte that no UTF-8 text holds: the end of a piece.
STOP = b"\xff"
LETTERS = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """The words of ``text`` and ``STOP`` between its pieces, some megabytes of text at a time."""
    for part in cut_at_spaces(text.translate(LETTERS).replace(STOP, b" " + STOP + b" ")):
        yield part.split()


# ---- words


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n; added up per task only. ``docs``: lang, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, n in held.items():
                n.pop(STOP, None)
                if n:
                    cols = [pa.array([lang] * len(n)), pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64())]
                    yield pa.RecordBatch.from_arrays(cols, names=["lang", "word", "n"])
            held.clear()

        for part, texts in slices(batches):
            for lang, text in zip(part.column(0).to_pylist(), texts, strict=True):
                n = held.setdefault(lang, Counter())
                for words in tokens(text):
                    n.update(words)
            if sum(map(len, held.values())) > ENTRIES // 8:
                yield from flush()
        yield from flush()

    return docs.select("lang", "text").mapInArrow(tidy(run), "lang string, word string, n long")


def number_words(words: DataFrame) -> DataFrame:
    """lang, word, n, piece and a gapless number; a piece's numbers follow each other."""
    pieces = max(1, -(-words.count() // PIECE))
    dealt = words.withColumn("piece", F.expr(f"cast(pmod(xxhash64(lang, word), {pieces}) as int)"))
    sizes = dict(dealt.groupBy("piece").count().collect())  # a row per PIECE words
    first = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(pieces)])])
    offset = F.element_at(F.array(*[F.lit(int(v)) for v in first]), F.col("piece") + 1).cast("long")
    inside = F.row_number().over(Window.partitionBy("piece").orderBy("lang", "word"))  # of PIECE words
    return dealt.withColumn("number", offset + inside - 1)


def dictionaries(spark, words: DataFrame) -> list:
    """A broadcast {lang: {word: number}} for each piece."""
    out = []
    for p in range((words.agg(F.max("piece")).first()[0] or 0) + 1):
        rows = words.where(F.col("piece") == p).select("lang", "word", "number").toArrow()
        book: dict[str, dict[bytes, int]] = {}
        for lang, word, number in zip(rows["lang"].to_pylist(), rows["word"].cast(pa.binary()).to_pylist(), rows["number"].to_pylist(), strict=True):
            book.setdefault(lang, {})[word] = number
        out.append(spark.sparkContext.broadcast(book))
    return out


# ---- the trie


class Ways(NamedTuple):
    """The ways from the states lo <= s < lo + width by a word each: a double-array trie over the bytes of the words' numbers.

    Node n goes by byte c to slot base[n] + c, if ``check`` there is n; ``to`` names the next node, or the state reached
    after the last byte. Nodes 0 to width - 1 are the states."""

    lo: int
    width: int
    digits: int
    base: np.ndarray
    check: np.ndarray
    to: np.ndarray
    first: int
    count: int


def lay_out(node: np.ndarray, byte: np.ndarray, window: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes and their bases, at least 0, so that base + byte differs for all pairs. The pairs are sorted.
    Nodes with most bytes are placed first, each where all its bytes fit; nodes of like size follow one another, and each time
    the size has halved the search starts at the front again."""
    nodes, start, many = np.unique(node, return_index=True, return_counts=True)
    base = np.zeros(len(nodes), np.int64)
    used = np.zeros(2 * len(node) + 4 * window, bool)
    used[:256] = True  # no base is negative
    low, size, order = 256, 256, np.argsort(-many, kind="stable")
    several = np.count_nonzero(many > 1)
    for n in order[:several]:
        if 2 * many[n] <= size:
            low, size = 256, many[n]
        own = byte[start[n] : start[n] + many[n]]
        own, at = own - own[0], low
        while True:
            if at + window + 256 > len(used):
                used = np.concatenate([used, np.zeros(len(used), bool)])
            free = np.flatnonzero(~used[at : at + window]) + at
            for c in own[1:]:
                free = free[~used[free + c]]
                if not len(free):
                    break
            if len(free):
                break
            at += window
        used[free[0] + own] = True
        base[n], low = free[0] - byte[start[n]], max(low, free[0] - 256)
    free = np.flatnonzero(~used)
    single = order[several:]
    free = np.concatenate([free, len(used) + np.arange(max(0, len(single) - len(free)))])[: len(single)]
    base[single] = free - byte[start[single]]
    return nodes, base


def ways_of(state: np.ndarray, word: np.ndarray, n_words: int, lo: int, hi: int, first: int) -> Ways:
    """``state`` and ``word`` (below ``n_words``) sorted; the ways' ends are numbered from ``first``."""
    digits = max(1, -(-max(n_words - 1, 0).bit_length() // 8))
    node, nodes, parts = state - lo, hi - lo, []
    for d in range(digits):
        byte = (word >> (8 * (digits - 1 - d))) & 255
        new = np.concatenate([[True], (node[1:] != node[:-1]) | (byte[1:] != byte[:-1])]) if len(node) else np.zeros(0, bool)
        after = nodes + np.cumsum(new) - 1 if d < digits - 1 else first + np.arange(len(node))
        parts.append((node[new], byte[new], after[new]))
        nodes += np.count_nonzero(new)
        node = after
    node, byte, after = (np.concatenate(c) for c in zip(*parts, strict=True))
    where, bases = lay_out(node, byte)
    base = np.zeros(nodes, np.int64)
    base[where] = bases
    slot = base[node] + byte
    check = np.full(int(slot.max(initial=0)) + 257, -1, np.int64)
    to = check.copy()
    check[slot], to[slot] = node, after
    return Ways(lo, hi - lo, digits, base, check, to, first, len(state))


def step(ways: Ways, state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The states reached (-1: none) from ``state`` by ``word``; both are -1 where there is none."""
    out = np.full(len(state), -1, np.int64)
    at = np.flatnonzero((state >= ways.lo) & (state < ways.lo + ways.width) & (word >= 0))
    node, word = state[at] - ways.lo, word[at]
    for d in range(ways.digits):
        slot = ways.base[node] + ((word >> (8 * (ways.digits - 1 - d))) & 255)
        hit = ways.check[slot] == node
        at, node, word = at[hit], ways.to[slot[hit]], word[hit]
    out[at] = node
    return out


def opened(pieces: list) -> Iterator:
    """The values of broadcast pieces, one after the other; of more than ``KEEP``, a worker holds one at a time."""
    for piece in pieces:
        yield piece.value
        if len(pieces) > KEEP:
            vars(piece).pop("_value", None)


def numbers_of(langs: list[str], texts: list[bytes], books: list) -> np.ndarray:
    """The word numbers of all texts after each other; -1 for other words and between pieces and texts."""
    out = None
    for book in opened(books):
        found = []
        for lang, text in zip(langs, texts, strict=True):
            get = book.get(lang, {}).get
            found += [np.fromiter(map(get, words, repeat(-1)), np.int64, len(words)) for words in tokens(text)]
            found.append(np.array([-1], np.int64))
        now = np.concatenate(found)
        out = now if out is None else np.maximum(out, now)
    return out


def reached(numbers: np.ndarray, levels: list[list]) -> Iterator[np.ndarray]:
    """For each position the state after its first 1, 2, ... words."""
    state = numbers
    yield state
    for k, pieces in enumerate(levels, 1):
        word = np.concatenate([numbers[k:], np.full(min(k, len(numbers)), -1, np.int64)])
        after = np.full(len(state), -1, np.int64)
        for ways in opened(pieces):
            after = np.maximum(after, step(ways, state, word))
        state = after
        yield state


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(place.ravel(), np.concatenate(counts), len(key)).astype(np.int64)


def encoded(docs: DataFrame, books: list) -> DataFrame:
    """The word numbers of all texts, a slice of texts a row: ``numbers``, 32-bit numbers, compressed. Written once, as every
    level reads them. ``docs``: lang, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for part, texts in slices(batches):
            numbers = numbers_of(part.column(0).to_pylist(), texts, books)
            yield pa.RecordBatch.from_arrays([pa.array([pack(numbers.astype("<i4").tobytes())], pa.binary())], names=["numbers"])

    return docs.select("lang", "text").mapInArrow(tidy(run), "numbers binary")


def summed(batches: Iterator[pa.RecordBatch], per_row) -> Iterator[pa.RecordBatch]:
    """Batches of key and n, added up over a task's rows of numbers. ``per_row`` gives distinct keys and counts."""
    keys, counts, held = [], [], 0
    for batch in batches:
        for row in batch.column(0):
            numbers = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.as_buffer()), "<i4").astype(np.int64)
            for key, n in per_row(numbers):
                keys.append(key)
                counts.append(n)
                held += len(key)
            if held > ENTRIES:
                key, n = added(keys, counts)
                keys, counts, held = [key], [n], len(key)
                if held > ENTRIES // 2:
                    yield from sent(key, n)
                    keys, counts, held = [], [], 0
    if held:
        yield from sent(*added(keys, counts))


def sent(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(key), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(key[lo : lo + ROWS]), pa.array(n[lo : lo + ROWS])], names=["key", "n"])


def proposals(texts: DataFrame, levels: list[list], n_words: int) -> DataFrame:
    """key (number of the phrase without its last word, times n_words, plus the last word) and n, for phrases of one word more
    than the trie's. ``texts``: see ``encoded``."""
    k = len(levels) + 1

    def per_row(numbers):
        *_, state = reached(numbers, levels)
        safe = np.flatnonzero((state[:-1] >= 0) & (state[1:] >= 0))
        yield np.unique(state[safe] * n_words + numbers[safe + k], return_counts=True)

    return texts.mapInArrow(tidy(lambda batches: summed(batches, per_row)), "key long, n long")


def counts(texts: DataFrame, levels: list[list]) -> DataFrame:
    """key (number of a phrase) and n, for all phrases of the trie."""

    def per_row(numbers):
        for state, pieces in zip(list(reached(numbers, levels))[1:], levels, strict=True):
            state = state[state >= 0]
            for ways in opened(pieces):
                mine = state if len(pieces) == 1 else state[(state >= ways.first) & (state < ways.first + ways.count)]
                n = np.bincount(mine - ways.first, minlength=ways.count)
                found = np.flatnonzero(n)
                yield found + ways.first, n[found]

    return texts.mapInArrow(tidy(lambda batches: summed(batches, per_row)), "key long, n long")


def number_level(cands: DataFrame, n_words: int, first: int) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """prefix, word, piece, number (from ``first``, a piece's numbers follow each other); (lo, hi, first) of the pieces."""
    cands = cands.select(F.expr(f"key div {n_words}").alias("prefix"), F.expr(f"key % {n_words}").alias("word"))
    blocks = sorted(tuple(r) for r in cands.groupBy(F.expr(f"prefix div {BLOCK}").alias("b")).count().collect())
    pieces: list[list[int]] = []  # lo, hi, ways
    for b, n in blocks:
        lo, hi = b * BLOCK, (b + 1) * BLOCK
        if pieces and pieces[-1][2] + n <= PIECE and hi - pieces[-1][0] <= REACH:
            pieces[-1][1:] = [hi, pieces[-1][2] + n]
        else:
            pieces.append([lo, hi, n])
    starts = [first + int(v) for v in np.cumsum([0] + [p[2] for p in pieces])]
    los = F.array(*[F.lit(p[0]).cast("long") for p in pieces])
    piece = F.size(F.filter(los, lambda lo: lo <= F.col("prefix"))) - 1
    inside = F.row_number().over(Window.partitionBy("piece").orderBy("prefix", "word"))  # of a piece
    offset = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("piece") + 1)
    level = cands.withColumn("piece", piece).withColumn("number", offset + inside - 1)
    return level, [(p[0], p[1], s) for p, s in zip(pieces, starts, strict=False)]


def mine(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all words and phrases with f >= least, and (lang, n) of all words. ``docs``: lang, text."""
    spark = docs.sparkSession
    all_words = written(word_counts(docs).groupBy("lang", "word").agg(F.sum("n").alias("n")), "collocation-words")
    words = written(number_words(all_words.where(F.col("n") >= least)), "collocation-dictionary")
    totals = all_words.groupBy("lang").agg(F.sum("n").alias("n"))
    n_words = max(1, words.count())
    books = dictionaries(spark, words)
    texts = written(encoded(docs, books), "collocation-numbers")
    levels, tables, first = [], [], n_words
    while len(levels) < longest - 1:
        bounds = proposals(texts, levels, n_words).groupBy("key").agg(F.sum("n").alias("n"))
        cands = written(bounds.where(F.col("n") >= least).select("key"), "collocation-candidates")
        size = cands.count()
        if not size:
            break
        level, pieces = number_level(cands, n_words, first)
        level = written(level, "collocation-level")
        ways = []
        for p, (lo, hi, start) in enumerate(pieces):
            rows = level.where(F.col("piece") == p).select("prefix", "word").orderBy("prefix", "word").toArrow()
            ways.append(spark.sparkContext.broadcast(ways_of(rows["prefix"].to_numpy(), rows["word"].to_numpy(), n_words, lo, hi, start)))
        levels.append(ways)
        tables.append(level)
        first += size
    out = named = words.select("number", "lang", F.col("word").alias("phrase"), F.lit(1).alias("k"), F.col("n").alias("f"))
    spelled = words.select(F.col("number").alias("word"), F.col("word").alias("last"))
    if levels:
        found = written(counts(texts, levels).groupBy("key").agg(F.sum("n").alias("f")), "collocation-counts")
        found = found.withColumnRenamed("key", "number").where(F.col("f") >= least)
        for k, level in enumerate(tables, 2):
            before = named.select(F.col("number").alias("prefix"), "lang", "phrase")
            named = level.join(found, "number").join(before, "prefix").join(spelled, "word")
            named = named.select("number", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), F.lit(k).alias("k"), "f")
            named = written(named, "collocation-phrases")
            out = out.union(named)
    for b in [*books, *(w for ways in levels for w in ways)]:
        b.unpersist()  # the driver keeps them: a lost executor's tables are in the shared folder
    return out.drop("number"), totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, share: int = SHARE, top: int = TOP, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: see the module's text."""
    plain = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    phrases, totals = mine(plain, least, longest)
    cands = phrases.where("k > 1").withColumn("words", F.split("phrase", " "))
    part = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    # longer candidates' inner phrases, with the best of the longer ones' counts
    spans = F.expr("flatten(transform(sequence(2, k - 1), n -> transform(sequence(1, k - n + 1), i -> array_join(slice(words, i, n), ' '))))")
    inner = cands.where("k > 2").select("lang", F.explode(spans).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = cands.join(inner, ["lang", "phrase"], "left").where(F.expr(f"longer is null or cast(100 as decimal(20,0)) * longer < cast({share} as decimal(20,0)) * f"))
    cuts = left.select("lang", "phrase", F.col("f").alias("a"), "k", "words", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("one"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("two"))
    parts = phrases.where(F.col("k") < longest)
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("one"), F.col("f").alias("l")), ["lang", "one"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("two"), F.col("f").alias("r")), ["lang", "two"])
    score = F.expr("(cast(2000000 as decimal(18,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + r)")
    best = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "cut", "l", "r").alias("c"))
    best = best.groupBy("lang", "phrase", "a").agg(F.min("c").alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    down = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(down).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""ALS of many ratings: the same alternating least squares as Spark's, with factors that are read where they lie.

Spark's ALS shuffles a copy of nearly every factor to each block and solves row by row. Here ratings are dealt to slices, once by user and
once by item. A slice holds its rows' ratings as arrays, by rising number of ratings, so that rows with equally many are multiplied in one
batch. In a half step each slice reads the other side's factors from the cache of the executors that made them: nothing is shuffled,
and a step's factors are written once, to the checkpoint folder, so that no lineage is longer than a step and a lost executor costs one.

A task holds the other side's factors, one slice and the sums of some rows (``fits``: else Spark's ALS, which sends each block what it
needs and sums in 64 bits, is the one to take). Products are summed in 32 bits (as factors are stored) over at most ``GATHERED`` ratings and in 64 bits beyond;
systems are solved in 64 bits. λ is multiplied with a row's number of ratings, as in Spark's ALS. Start values depend on id, rank and seed
only, so slices change a model by rounding only, and a fit of 30 iterations passes through that of 20.
"""

from __future__ import annotations

import contextlib
import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.serializers import NoOpSerializer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ratings of a slice, some 64 MB.
SLICE = 8_000_000
#: Ratings of a record of a slice, and those dealt to the slices at once.
PIECE, DEAL = 1_000_000, 400_000
#: Bytes of the factors that a task may hold.
HELD = 384_000_000
#: Below this λ the rounding of sums in 32 bits may show.
LEAST_REG = 0.001
#: Ratings whose factors are gathered at once, and numbers in the sums of rows solved at once.
GATHERED, SUMS = 32_768, 262_144
#: Up to this rank systems are eliminated side by side, beyond one by one.
SIDE_BY_SIDE = 16
SCHEMA = pa.schema([("user", pa.int32()), ("item", pa.int32()), ("rating", pa.float32())])
LEVEL = StorageLevel.MEMORY_AND_DISK_DESER  # as bytes: no serializer runs where they are read


class Rows(NamedTuple):
    """Part of a slice: ids by (number of ratings, id), and for each of their ratings the other side's id, or its place among the factors."""

    at: tuple[int, int]
    ids: np.ndarray
    counts: np.ndarray
    others: np.ndarray
    ratings: np.ndarray


class Factors(NamedTuple):
    at: tuple[int, int]
    ids: np.ndarray
    values: np.ndarray


def fits(users: int, items: int, rank: int, reg: float) -> bool:
    return 4 * rank * max(users, items) <= HELD and reg >= LEAST_REG


def start(ids: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Normal random directions, as Spark's ALS starts with, from a hash of id, component and seed."""

    def uniform(salt: int) -> np.ndarray:
        z = ids.astype(np.int64).astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        z = z + (np.arange(rank, dtype=np.uint64) * np.uint64(2) + np.uint64(salt)) * np.uint64(0xD1B54A32D192ED03)
        z = z + np.uint64(seed * 0x8CB92BA72F3D8DD7 % 2**64)
        for _ in range(2):
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            z = z ^ (z >> np.uint64(31))
        return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53

    x = np.sqrt(-2 * np.log(uniform(0))) * np.cos(2 * np.pi * uniform(1))
    return (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float32)


def dealt(parts: int) -> Callable[[Iterable[bytes]], Iterator[tuple]]:
    """Arrow batches of ratings (user, item, rating) as pieces for the slices by user (0 to ``parts`` - 1) and by item (the next)."""

    def run(batches: Iterable[bytes]) -> Iterator[tuple]:
        held: list[list[np.ndarray]] = []
        for b in batches:
            b = pa.ipc.read_record_batch(pa.py_buffer(b), SCHEMA)
            held.append([c.to_numpy(zero_copy_only=False) for c in b.columns])
            if sum(len(h[0]) for h in held) >= DEAL:
                yield from pieces(held)
                held = []
        if held:
            yield from pieces(held)

    def pieces(held: list[list[np.ndarray]]) -> Iterator[tuple]:
        user, item, rating = (np.concatenate(c) for c in zip(*held, strict=True))
        for side, (own, other) in enumerate(((user, item), (item, user))):
            part = part_of(own, parts)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cuts)):
                at = order[cuts[p] : cuts[p + 1]]
                yield side * parts + int(p), (own[at], other[at], rating[at])

    return run


def part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    z = ids.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((z ^ (z >> np.uint64(32))) % np.uint64(parts)).astype(np.int16 if parts < 2**15 else np.int32)


def packed(at: int, pieces: Iterable) -> Iterator[Rows]:
    """A slice's pieces as records of rows."""
    pieces = [p for _, p in pieces]
    if not pieces:
        return
    own, other, rating = (np.concatenate(c) for c in zip(*pieces, strict=True))
    pieces.clear()
    order = np.argsort((own.astype(np.int64) << 32) + other)
    own, other, rating = own[order], other[order], rating[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    counts = np.diff(np.r_[first, len(own)])
    by = np.argsort(counts, kind="stable")
    ids, first, counts = own[first[by]], first[by], counts[by]
    ends = np.cumsum(counts)
    order = np.repeat(first - (ends - counts), counts) + np.arange(len(own))
    other, rating = other[order], rating[order]
    a = 0
    while a < len(ids):
        begin = ends[a] - counts[a]
        b = max(a + 1, int(np.searchsorted(ends, begin + PIECE, side="right")))
        yield Rows((at, a), ids[a:b].copy(), counts[a:b].astype(np.int32), other[begin : ends[b - 1]].copy(), rating[begin : ends[b - 1]].copy())
        a = b


def split(records: Iterable) -> tuple[list[Rows], np.ndarray]:
    """A slice's records, and the other side's factors (or ids) as one array in the order of the slices."""
    rows, found = [], []
    for r in records:
        (rows if isinstance(r, Rows) else found).append(r)
    rows.sort(key=lambda r: r.at)
    found.sort(key=lambda r: r.at)
    if not found:
        return rows, np.empty((0, 0), np.float32)
    out, n = np.empty((sum(len(f.values) for f in found), *found[0].values.shape[1:]), found[0].values.dtype), 0
    for k, f in enumerate(found):
        out[n : n + len(f.values)] = f.values
        n += len(f.values)
        found[k] = f = None  # so that the factors are held once
    return rows, out


def placed(records: Iterable) -> Iterator[Rows]:
    """Rows with the other side's ids replaced by their places."""
    rows, ids = split(records)
    order = np.argsort(ids)
    ids = ids[order]
    for r in rows:
        yield r._replace(others=order[np.searchsorted(ids, r.others)].astype(np.int32))


def eliminated(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solutions of many small positive definite systems (a: system, row, column; b: system, row), all in step."""
    k = a.shape[1]
    a, b = np.ascontiguousarray(a.transpose(1, 2, 0)), np.ascontiguousarray(b.T)
    for j in range(k - 1):
        if not (a[j, j] > 0).all():
            raise np.linalg.LinAlgError("a least-squares system is not positive definite")
        f = a[j, j + 1 :] / a[j, j]
        b[j + 1 :] -= f * b[j]
        a[j + 1 :, j + 1 :] -= f[:, None] * a[j, None, j + 1 :]
    for j in range(k - 1, -1, -1):
        b[j] /= a[j, j]
        b[:j] -= a[:j, j] * b[j]
    return b.T


def solution(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Solutions of many positive definite systems (a: system, row, column; b: system, row)."""
    k = a.shape[1]
    if k <= SIDE_BY_SIDE:
        x = eliminated(a, b)
    else:
        low, x = np.linalg.cholesky(a), b.copy()
        for j in range(k):
            x[:, j] = (x[:, j] - np.einsum("sj,sj->s", low[:, j, :j], x[:, :j])) / low[:, j, j]
        for j in range(k - 1, -1, -1):
            x[:, j] /= low[:, j, j]
            x[:, :j] -= low[:, j, :j] * x[:, j, None]
    if not np.isfinite(x).all():
        raise np.linalg.LinAlgError("a least-squares system has no finite solution")
    return x


def diagonal(a: np.ndarray, by: np.ndarray | float) -> np.ndarray:
    at = np.arange(a.shape[1])
    a[:, at, at] += by
    return a


def solved(rows: Rows, other: np.ndarray, reg: float) -> np.ndarray:
    """The least-squares factors of ``rows`` given the other side's: x = (VᵀV + λnE)⁻¹Vᵀr, for rows with fewer ratings than factors
    as the equal Vᵀ(VVᵀ + λnE)⁻¹r, whose system is smaller."""
    k = other.shape[1]
    out = np.empty((len(rows.ids), k), np.float32)
    ends = np.cumsum(rows.counts, dtype=np.int64)

    def gathered(first: int, last: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        v = other.take(rows.others[first:last], axis=0).reshape(m, -1, k)
        return v, v.transpose(0, 2, 1), rows.ratings[first:last].reshape(m, -1)

    short = int(np.searchsorted(rows.counts, k))
    runs = np.flatnonzero(np.r_[True, rows.counts[1:] != rows.counts[:-1], True])
    for i, j in zip(runs[:-1], runs[1:], strict=True):
        if i >= short:
            break
        n = int(rows.counts[i])
        for s in range(i, j, wide := max(1, GATHERED // n)):
            e = min(j, s + wide)
            v, vt, r = gathered(ends[s] - n, ends[e - 1], e - s)
            y = solution(diagonal((v @ vt).astype(np.float64), reg * n), r.astype(np.float64))
            out[s:e] = (vt.astype(np.float64) @ y[:, :, None])[:, :, 0]

    step = max(64, SUMS // (k * k))
    for lo in range(short, len(out), step):
        counts = rows.counts[lo : lo + step]
        a, b = np.empty((len(counts), k, k)), np.empty((len(counts), k))
        runs = np.flatnonzero(np.r_[True, counts[1:] != counts[:-1], True])
        for i, j in zip(runs[:-1], runs[1:], strict=True):
            n = int(counts[i])
            for s in range(i, j, wide := max(1, GATHERED // n)):
                e = min(j, s + wide)
                first, last = ends[lo + s] - n, ends[lo + e - 1]
                for c in range(first, last, GATHERED):  # more than one only for a row that is longer by itself
                    v, vt, r = gathered(c, min(last, c + GATHERED), e - s)
                    sums, sides = vt @ v, (vt @ r[:, :, None])[:, :, 0]
                    a[s:e], b[s:e] = (sums, sides) if c == first else (a[s:e] + sums, b[s:e] + sides)
        out[lo : lo + step] = solution(diagonal(a, (reg * counts)[:, None]), b)
    return out


def half(reg: float) -> Callable[[Iterable], Iterator[Factors]]:
    def run(records: Iterable) -> Iterator[Factors]:
        rows, other = split(records)
        for r in rows:
            yield Factors(r.at, r.ids, solved(r, other, reg))

    return run


def beside(parts: list[RDD], whole: RDD) -> RDD:
    """A partition for each of ``parts``, of its records and all of ``whole``, which must be cached: its blocks are read, not shuffled."""
    sc = whole.ctx
    joined = [p._jrdd.union(whole._jrdd).coalesce(1) for p in parts]
    return sc.union([RDD(j, sc, whole._jrdd_deserializer) for j in joined])


def single(rdd: RDD) -> list[RDD]:
    """Each partition of a cached RDD as an RDD."""
    jvm = rdd.ctx._jvm
    only = [jvm.PythonUtils.toSeq([t]).toSet() for t in range(rdd.getNumPartitions())]  # a set is a function that says what it holds
    cut = [jvm.org.apache.spark.rdd.PartitionPruningRDD.create(rdd._jrdd.rdd(), t).toJavaRDD() for t in only]
    return [RDD(c, rdd.ctx, rdd._jrdd_deserializer) for c in cut]


def made(rdd: RDD, kept: bool = False) -> RDD:
    """``rdd`` in the cache; if ``kept``, its lineage is cut by a checkpoint."""
    rdd.persist(LEVEL)
    if kept:
        rdd.checkpoint()
    rdd._jrdd.count()
    return rdd


def dropped(rdd: RDD | None) -> None:
    """Forget the cached blocks of an RDD and its checkpoint, which nothing may need any more."""
    if rdd is None:
        return
    rdd.unpersist()
    if at := rdd.getCheckpointFile():
        path = rdd.ctx._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(rdd.ctx._jsc.hadoopConfiguration()).delete(path, True)


class Slices:
    """Ratings in slices by user and by item, for any number of fits."""

    def __init__(self, ratings: DataFrame, rows: int, user: str = "user_id", item: str = "item_id", rating: str = "rating"):
        self.spark: SparkSession = ratings.sparkSession
        sc = self.spark.sparkContext
        cores = sc.defaultParallelism
        n = math.ceil(max(1, rows / SLICE) / cores) * cores
        r = F.col(rating).cast("float")
        bad = r.isNull() | F.isnan(r) | (F.abs(r) == float("inf"))
        r = F.when(bad, F.raise_error(F.lit("Ratings MUST NOT be Null, NaN or infinite"))).otherwise(r)
        ids = [F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} Ids MUST NOT be Null"))).otherwise(F.col(c)).cast("int").alias(c) for c in (user, item)]
        ratings = ratings.select(*ids, r.alias(rating))
        batches = RDD(ratings._jdf.toArrowBatchRdd().toJavaRDD(), sc, NoOpSerializer())  # rows that pass DataFrame.rdd are pickled one by one
        pieces = batches.mapPartitions(dealt(n))
        both = made(pieces.partitionBy(2 * n, int).mapPartitionsWithIndex(packed))
        raw = single(both)
        raw = raw[:n], raw[n:]
        self._ids = [made(sc.union(x).map(lambda r: Factors(r.at, r.ids, r.ids))) for x in raw]
        self._rows = [made(beside(x, o).mapPartitions(placed)) for x, o in zip(raw, reversed(self._ids), strict=True)]
        both.unpersist()
        self._users, self._items = (single(x) for x in self._rows)

    def begun(self, rank: int, seed: int) -> RDD:
        return made(self._ids[0].map(lambda f: Factors(f.at, f.ids, start(f.ids, rank, seed))), kept=True)

    def close(self) -> None:
        for x in (*self._rows, *self._ids):
            x.unpersist()


@contextlib.contextmanager
def sliced(ratings: DataFrame, rows: int, **columns: str) -> Iterator[Slices]:
    held = Slices(ratings, rows, **columns)
    try:
        yield held
    finally:
        held.close()


class Course:
    """A fit that can be asked for its model after so many iterations, and then go on."""

    def __init__(self, slices: Slices, est: ALS):
        self.slices, self.est, self.done = slices, est, 0
        self.users, self.items = None, None

    def to(self, iterations: int) -> ALSModel:
        """The model after ``iterations``, not fewer than asked for before. The next call drops it."""
        rank, s = self.est.getRank(), self.slices
        if self.users is None:
            self.users = s.begun(rank, self.est.getSeed())
        step = half(self.est.getRegParam())
        while self.done < iterations or self.items is None:
            last = self.done + 1 >= iterations
            items = made(beside(s._items, self.users).mapPartitions(step), kept=last)
            if iterations:
                users = made(beside(s._users, items).mapPartitions(step), kept=True)
                self.done += 1
            self.drop()
            self.users, self.items = users, items
        return self._model(rank)

    def drop(self) -> None:
        dropped(self.users)
        dropped(self.items)

    def _model(self, rank: int) -> ALSModel:
        est = self.est.copy().setMaxIter(self.done)
        tables = [table(self.slices.spark, x) for x in (self.users, self.items)]
        java = self.slices.spark._jvm.org.apache.spark.ml.recommendation.ALSModel(est.uid, rank, *(t._jdf for t in tables))
        return est._copyValues(est._create_model(java))


def table(spark: SparkSession, factors: RDD) -> DataFrame:
    """``id, features`` as Spark's models have them."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, values in zip(b.column(0), b.column(1), strict=True):
                ids, values = (np.frombuffer(v.as_buffer(), t) for v, t in ((ids, np.int32), (values, np.float32)))
                k = len(values) // max(1, len(ids))
                for lo in range(0, len(ids), 10_000):
                    n = len(ids[lo : lo + 10_000])
                    at = pa.array(np.arange(0, n * k + 1, k, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[lo : lo + n]), pa.ListArray.from_arrays(at, pa.array(values[lo * k : (lo + n) * k]))], names=["id", "features"]
                    )

    cells = factors.map(lambda f: (bytearray(f.ids.tobytes()), bytearray(f.values.tobytes())))
    return spark.createDataFrame(cells, "ids binary, body binary").mapInArrow(rows, "id int, features array<float>")

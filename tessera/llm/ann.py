"""Approximate nearest neighbours by multi-index hashing.

Codes: the vectors (scaled to length 1) are centred, turned by principal axes, and by rotations learned
so that the signs lose little (iterative quantisation); each coordinate's sign is a bit. With fewer
dimensions than bits several rotations are learned. Fitted on at most ``SAMPLE`` rows: those with the smallest
hash of their id.

Index: every block of rows keeps, for each byte of the code, the rows sorted by that byte's value. A code
within radius r of the query's must, in some byte, lie within the byte's share of r (pigeonhole: with
r = q * bytes + rest, the first rest + 1 bytes get q, the others q - 1); the buckets of all byte values
within that share are probed, so every code within r is retrieved; the retrieved codes' full distances
are checked, and what is left is ranked by exact cosine on the original vectors. The radius is the one
within which ``COVER`` of the true neighbours of the fitting sample lie; a query that finds fewer than
``k`` rows of a block widens it there, so it always gets ``k`` results if there are so many rows.

Spark: the index rows stay in their partitions; the queries go to them in segments of at most
``SEGMENT`` (a broadcast of bounded size), and each task returns the ``k`` best rows of its own per query,
which a window merges. Neither a hot code bucket nor many copies of a vector meet in one task.

Vectors of different lengths have no cosine: each length is a table of its own, with codes of its own. Results are
written segment by segment, so no plan grows with their number.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do null
ids; a query never finds its own row, but other rows of its id and vector; rows of equal id are queries of their own; ties
go to the smaller id; an empty table gives no rows; extra columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import scratch, tidy, written

BITS = 128
SAMPLE = 20_000
SEGMENT = 20_000
COVER = 0.985
ONES = np.bitwise_count(np.arange(256, dtype=np.uint8))
#: byte patterns by their number of ones: masks[q] are those with q ones at most
MASKS = [np.flatnonzero(ONES <= q).astype(np.uint8) for q in range(9)]


@dataclass
class Coder:
    mean: np.ndarray
    turn: np.ndarray
    radius: int

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Packed codes of vectors."""
        unit = x / np.sqrt((x * x).sum(1, keepdims=True))
        return np.packbits((unit - self.mean) @ self.turn > 0, axis=1)


def learn(x: np.ndarray, bits: int = BITS, k: int = 5, rounds: int = 30, seed: int = 7) -> Coder:
    """Fit the codes, and the radius, to a sample of vectors."""
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    mean = unit.mean(0)
    centred = unit - mean
    axes = np.linalg.eigh(centred.T @ centred)[1][:, ::-1]
    rng = np.random.default_rng(seed)
    turns, have = [], 0
    while have < bits:
        p = min(x.shape[1], bits - have, bits)
        low = centred @ axes[:, : max(p, 1)]
        turn = np.linalg.qr(rng.normal(size=(p, p)))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.sign(low @ turn).T @ low)
            turn = (u @ vt).T
        turns.append(axes[:, :p] @ turn)
        have += p
    coder = Coder(mean, np.concatenate(turns, 1), bits)
    asked = rng.permutation(len(x))[:400]
    if len(x) > k:
        sim = unit[asked] @ unit.T
        sim[np.arange(len(asked)), asked] = -2
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        codes = coder.codes(x)
        apart = np.bitwise_count(codes[asked][:, None, :] ^ codes[near]).sum(2)
        coder.radius = int(np.quantile(apart, COVER, method="higher"))
    return coder


class BlockIndex:
    """The byte tables of a block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(c, kind="stable") for c in codes.T]
        self.starts = [np.searchsorted(c[o], np.arange(257)) for c, o in zip(codes.T, self.order, strict=True)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within the radius."""
        share, rest = divmod(radius, len(code))
        seen = np.zeros(len(self.codes), bool)
        for j, byte in enumerate(code):
            own = share if j <= rest else share - 1
            if own >= 8:
                seen[:] = True
                break
            if own >= 0:
                values = MASKS[own] ^ byte
                starts, order = self.starts[j], self.order[j]
                for a, b in zip(starts[values].tolist(), starts[values.astype(np.int64) + 1].tolist(), strict=True):
                    if b > a:
                        seen[order[a:b]] = True
        rows = np.flatnonzero(seen)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(1) <= radius]


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, in one order of summation, so that equal vectors get equal scores."""
    dot = (x * y).sum(1)
    return dot / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and double vector of the rows that take part, and a number for each row."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    return (
        vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull())
        .filter(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
        .filter(F.exists("v", lambda c: c != 0))
        .withColumn("row", F.monotonically_increasing_id())
    )


def to_matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return np.asarray(column.flatten(), float).reshape(n, -1)


def neighbours(
    vectors: DataFrame, query_filter: F.Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", bits: int = BITS
) -> DataFrame:
    """The ``k`` nearest rows found for each query row: query_id, rank, vec_id, score.

    ``query_filter`` says by the column ``id`` which rows are queries."""
    spark = vectors.sparkSession
    rows = written(usable(vectors, id_col, vector_col), "ann-rows")
    schema = "query long, query_id long, vec_id long, score double"
    path = scratch(spark, "ann-found")
    lengths = [r["d"] for r in rows.groupBy(F.size("v").alias("d")).count().orderBy("d").collect()]  # a row per length
    searched = False
    for dim in lengths:
        same = rows.filter(F.size("v") == dim)
        asked = same.filter(query_filter)
        count = asked.count()
        if not count:
            continue
        sample = same.orderBy(F.xxhash64("id"), "id", "row").limit(SAMPLE).toPandas()
        coder = learn(np.asarray(sample["v"].tolist(), float), bits, k)
        segments = -(-count // SEGMENT)
        for s in range(segments):
            own = asked.filter(F.pmod(F.xxhash64("row"), F.lit(segments)) == s).orderBy("id", "row").toPandas()
            if not len(own):
                continue
            x = np.asarray(own["v"].tolist(), float)
            shared = spark.sparkContext.broadcast((own["id"].to_numpy(np.int64), own["row"].to_numpy(np.int64), x, coder.codes(x)))
            same.mapInArrow(tidy(searcher(shared, coder, k)), schema).write.mode("append").parquet(path)
            shared.destroy()
            searched = True
    if not searched:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = spark.read.schema(schema).parquet(path)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def searcher(shared, coder: Coder, k: int):
    """Search the rows of a task, batch by batch, keeping the ``k`` best of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q_rows, q_x, q_codes = shared.value
        scores = np.full((len(q_ids), k), -np.inf)
        ids = np.full((len(q_ids), k), np.iinfo(np.int64).max)
        for batch in batches:
            if not batch.num_rows:
                continue
            own, x, row = batch.column(0).to_numpy(), to_matrix(batch.column(1)), batch.column(2).to_numpy()
            index = BlockIndex(coder.codes(x))
            for q in range(len(q_ids)):
                radius = coder.radius
                need = min(k, int((row != q_rows[q]).sum()))
                while True:
                    found = index.within(q_codes[q], radius)
                    found = found[row[found] != q_rows[q]]
                    if len(found) >= need or radius >= 8 * q_codes.shape[1]:
                        break
                    radius += max(1, radius // 8)
                if len(found):
                    s = np.concatenate([scores[q], cosine(np.broadcast_to(q_x[q], (len(found), x.shape[1])).copy(), x[found])])
                    i = np.concatenate([ids[q], own[found]])
                    top = np.lexsort((i, -s))[:k]
                    scores[q], ids[q] = s[top], i[top]
        at, rank = np.nonzero(scores > -np.inf)
        for lo in range(0, len(at), 50_000):
            a, r = at[lo : lo + 50_000], rank[lo : lo + 50_000]
            cols = [pa.array(c) for c in (q_rows[a], q_ids[a], ids[a, r], scores[a, r])]
            yield pa.RecordBatch.from_arrays(cols, names=["query", "query_id", "vec_id", "score"])

    return run

"""Shards of nearly equal bytes: minimax contiguous partition of ordered atomic groups.

Rows of equal text (a null text counts as an empty one) form a group that is never split. A group
above the mean of what is left to deal takes a shard of its own; the other groups, in the order of
their digests, are cut into contiguous runs whose largest sum is as small as possible.
The smallest feasible capacity is found by search, checking greedily: each run goes on for as long as it fits.

The groups are a Spark table in chunks of digest prefixes. The driver holds one sum per chunk (65,536 at most)
and reads the sizes of a chunk only where a run may end in it. A round checks ``PROBES`` capacities
at once (a binary search with several probes), so that a greedy step is one Spark job for all of them.

Slots number the rows of a shard from 0 without a gap: the rows are range-sorted by shard, digest and id,
so the copies of a hot text spread over many tasks; each task numbers its own rows, and one offset for
each task and shard (as many rows as tasks plus shards) makes the numbers global.

Edge cases: null ids sort first; equal rows get different slots; an empty table gives none; there may be
fewer groups than shards (some stay empty); only the id, text and result columns are returned.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written

PROBES = 63
CHUNK_GROUPS = 256


class Chunks:
    """Prefix sums of the group sizes in digest order, by chunks that are read when needed."""

    def __init__(self, groups: DataFrame, bits: int):
        self.groups, self.sizes = groups, {}
        sums = groups.groupBy("chunk").agg(F.sum("bytes").alias("bytes")).toPandas()
        by_chunk = np.zeros(2**bits, np.int64)
        by_chunk[sums["chunk"].to_numpy(int)] = sums["bytes"].to_numpy(np.int64)
        self.base = np.concatenate([[0], np.cumsum(by_chunk)])
        self.total = int(self.base[-1])

    def read(self, chunks: set[int]) -> None:
        """Fetch the sizes of chunks that haven't been read yet, in one job."""
        if need := sorted(chunks - self.sizes.keys()):
            rows = (
                self.groups.filter(F.col("chunk").isin(need))
                .select("chunk", "digest", "bytes")
                .toPandas()
                .sort_values("digest")
            )
            for chunk, part in rows.groupby("chunk"):
                self.sizes[int(chunk)] = np.cumsum(part["bytes"].to_numpy(np.int64))

    def fill(self, targets: list[int]) -> list[int]:
        """For each target, the largest prefix sum that isn't above it."""
        at = [int(np.searchsorted(self.base, t, side="right")) - 1 for t in targets]
        inside = {c for c in at if c < len(self.base) - 1}
        self.read(inside)
        out = []
        for t, c in zip(targets, at, strict=True):
            if c not in inside:
                out.append(self.total)
                continue
            sums = self.sizes[c]
            k = int(np.searchsorted(sums, t - self.base[c], side="right"))
            out.append(int(self.base[c]) + (int(sums[k - 1]) if k else 0))
        return out

    def runs(self, capacities: list[int], shards: int) -> list[list[int]]:
        """For each capacity, where the greedy runs end (as prefix sums)."""
        ends = [[] for _ in capacities]
        at = [0] * len(capacities)
        for _ in range(shards):
            at = self.fill([a + c for a, c in zip(at, capacities, strict=True)])
            for e, a in zip(ends, at, strict=True):
                e.append(a)
        return ends

    def cuts(self, shards: int, largest: int) -> list[int]:
        """The ends of the runs under the smallest feasible capacity."""
        mean = -(-self.total // shards)
        low, high = max(mean, largest), mean + largest  # the upper bound is always feasible
        while low < high:
            step = max(1, (high - low) // (PROBES + 1))
            tried = list(range(low, high, step))[: PROBES + 2]
            ok = [e[-1] == self.total for e in self.runs(tried, shards)]
            first = ok.index(True) if True in ok else len(tried)
            low, high = (tried[first - 1] + 1 if first else low), (tried[first] if first < len(tried) else high)
        return self.runs([high], shards)[0]

    def first_digests(self, ends: list[int]) -> list[str | None]:
        """The digest of the first group behind each end (None: behind all)."""
        at = [int(np.searchsorted(self.base, e, side="right")) - 1 for e in ends]
        inside = sorted({c for c in at if c < len(self.base) - 1})
        rows = self.groups.filter(F.col("chunk").isin(inside)).toPandas().sort_values("digest") if inside else None
        out = []
        for e, c in zip(ends, at, strict=True):
            if c not in inside:
                out.append(None)
                continue
            part = rows[rows["chunk"] == c]
            before = np.concatenate([[0], np.cumsum(part["bytes"].to_numpy(np.int64))])
            out.append(part["digest"].iloc[int(np.searchsorted(before, e - self.base[c], side="left"))])
        return out


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, digest, shard and slot of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = written(
        docs.select(
            F.col(id_col),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text.cast("binary"), 256).alias("digest"),
        ),
        "shard-rows",
    )
    n = rows.agg(F.approx_count_distinct("digest")).first()[0]
    bits = int(np.clip(np.ceil(np.log2(max(n, 1) / CHUNK_GROUPS)), 0, 16))
    chunk = F.shiftright(F.conv(F.substring("digest", 1, 4), 16, 10).cast("int"), 16 - bits)
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("bytes")).withColumn("chunk", chunk), "shard-groups")

    top = groups.orderBy(F.desc("bytes"), "digest").limit(shards).collect()  # as many as there are shards
    left, total, giants = shards, groups.agg(F.sum("bytes")).first()[0] or 0, {}
    while left > 1 and len(giants) < len(top) and top[len(giants)]["bytes"] * left > total:
        group = top[len(giants)]
        left, total = left - 1, total - group["bytes"]
        giants[group["digest"]] = left
    small = groups.filter(~F.col("digest").isin(list(giants))) if giants else groups
    chunks = Chunks(small, bits)
    largest = top[len(giants)]["bytes"] if len(giants) < len(top) else small.agg(F.max("bytes")).first()[0] or 0
    ends = [d for d in chunks.first_digests(chunks.cuts(left, largest)[:-1]) if d is not None]
    number = sum(((F.col("digest") >= d).cast("int") for d in ends), F.lit(0))
    for digest, i in giants.items():
        number = F.when(F.col("digest") == digest, i).otherwise(number)
    return numbered(rows.withColumn("shard", number), id_col)


def numbered(rows: DataFrame, id_col: str) -> DataFrame:
    """Add ``slot``: the row's number in its shard."""
    order = ["shard", "digest", id_col]
    placed = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()),
        "shard-placed",
    ).withColumn("task", F.shiftright("at", 33))
    per_task = placed.groupBy("shard", "task").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_task.select("shard", "task", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("offset"))
    return (
        placed.join(F.broadcast(offsets), ["shard", "task"])  # tasks + shards rows at most
        .withColumn("slot", F.col("at") + F.col("offset"))
        .drop("task", "at", "offset")
    )

"""The most frequent values of each group, exactly, with state that doesn't grow with the vocabulary.

1. A task keeps a frequent-items summary (Misra and Gries) of each group: at most twice ``capacity`` values with counts. When there are
   more, the count of the first that is too many is taken off all; what falls to 0 goes, and the amount is the
   summary's error: no count is more than that too small.
2. Summaries are merged by adding counts and errors. A value's true count lies between its sum and its sum plus the group's errors; a value
   that no summary holds has at most the errors. Values that may be among the k best are candidates.
3. Candidates are counted again over all rows, exactly.

If a group's errors are as large as its k-th best sum, a value that was dropped may belong to the best: such groups are done
again with four times the capacity, until nothing is in doubt (without drops there are no errors).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.broadcast import broadcast_if_small
from tessera.session import ensure_checkpoint_dir

CAPACITY = 1024
#: Values that a task holds over all groups before its summaries are sent on.
HELD = 1 << 20


class Summary:
    """Counts of the frequent values of a stream, each at most ``error`` too small."""

    def __init__(self, capacity: int):
        self.capacity, self.error, self.counts = capacity, 0, {}

    def add(self, value, n: int = 1) -> None:
        self.counts[value] = self.counts.get(value, 0) + n
        if len(self.counts) > 2 * self.capacity:
            self.shrink()

    def shrink(self) -> None:
        off = sorted(self.counts.values(), reverse=True)[self.capacity]
        self.counts = {v: n - off for v, n in self.counts.items() if n > off}
        self.error += off


def summaries(df: DataFrame, group: str, value: str, capacity: int) -> DataFrame:
    """``g, v, n, error`` of each task's summaries; the error stands in a row without a value."""
    kinds = [df.schema[c].dataType.simpleString() for c in (group, value)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def flush() -> pa.RecordBatch:
            rows = [(g, v, n, 0) for g, s in held.items() for v, n in s.counts.items()]
            rows += [(g, None, 0, s.error) for g, s in held.items() if s.error]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
            types = [batch.schema.field(0).type, batch.schema.field(1).type, pa.int64(), pa.int64()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["g", "v", "n", "error"])

        batch = None
        for batch in batches:
            pairs = pa.table({"g": batch.column(0), "v": batch.column(1)}).group_by(["g", "v"]).aggregate([([], "count_all")])
            for g, v, n in zip(*(pairs[c].to_pylist() for c in ("g", "v", "count_all")), strict=True):
                held.setdefault(g, Summary(capacity)).add(v, n)
            if sum(len(s.counts) for s in held.values()) > HELD:
                yield flush()
        if batch is not None:
            yield flush()

    return df.mapInArrow(run, f"g {kinds[0]}, v {kinds[1]}, n long, error long")


def candidates(found: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(g, v) that may be among the k most frequent of a group; (g) that are still in doubt."""
    errors = found.groupBy("g").agg(F.sum("error").alias("error"))
    sums = found.where("v is not null").groupBy("g", "v").agg(F.sum("n").alias("n"))
    at = Window.partitionBy("g").orderBy(F.desc("n"))
    kth = sums.withColumn("i", F.row_number().over(at)).where(F.col("i") <= k).groupBy("g").agg(F.min("n").alias("kth"), F.count(F.lit(1)).alias("many"))
    # a group with fewer than k values, none dropped, has them all
    limits = errors.join(kth, "g").withColumn("least", F.when(F.col("many") < k, 0).otherwise(F.col("kth")))
    doubt = limits.where("error > 0 and error >= least").select("g")
    sure = limits.where("error = 0 or error < least")
    return sums.join(sure, "g").where("n + error >= least").select("g", "v"), doubt


def most_frequent(df: DataFrame, group: str, value: str, k: int = 10, capacity: int = CAPACITY) -> DataFrame:
    """``group, rank, value, n``: the k most frequent values of each group, ties to the smaller value. Null groups and values
    don't count."""
    ensure_checkpoint_dir(df.sparkSession)
    if capacity < k:
        raise ValueError("a summary must hold k values")
    rows = df.select(F.col(group).alias("g"), F.col(value).alias("v")).where("g is not null and v is not null")
    todo, parts = rows, []
    while True:
        found = summaries(todo, "g", "v", capacity).checkpoint(eager=True)
        chosen, doubt = candidates(found, k)
        parts.append(chosen)
        doubt = doubt.checkpoint(eager=True)  # a row per group at most
        if not doubt.limit(1).count():
            break
        todo, capacity = rows.join(broadcast_if_small(doubt), "g", "left_semi"), 4 * capacity
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.union(p)
    chosen = chosen.checkpoint(eager=True)
    counted = rows.join(broadcast_if_small(chosen), ["g", "v"], "left_semi").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("n"), "v"))
    best = counted.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select(F.col("g").alias(group), "rank", F.col("v").alias(value), "n")

"""Connected components of an edge table, by alternating large and small stars.

Each round links a node's neighbours to the smallest node it knows; minima are aggregated before the
shuffle, and those of hot nodes are broadcast, of which there is a bounded number, so that a hub's edges never meet in a task. Edges and minima
are written to the shared folder, so no plan holds an earlier round. Edges may repeat: a small star has one edge for each of its nodes and one for each edge
that leads elsewhere, so repeated ones go by themselves and there are never more than at first. Rounds end when every node
is the smallest one it knows or knows only one other, a smaller one, after a number of rounds that grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import joined_back, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node that is reachable) for every node with an edge.

    Null ends and loops are left out; edges may repeat and run either way."""
    now = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v"), "cc")
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        known = written(both.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most"), F.count(F.lit(1)).alias("n")), "cc-known")
        ends, more = known.agg(F.sum("n"), F.count_if((F.col("m") < F.col("u")) & (F.col("m") < F.col("most")))).first()
        least = known.select("u", F.least("u", "m").alias("m"), "n")
        if not more:  # stars around the smallest nodes
            return least.select(F.col("u").alias("node"), F.col("m").alias("component"))
        large = joined_back(both, least, ["u"], F.col("n"), ends).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large, "cc")  # read several times below: unwritten, the plan would hold it once for each
        low = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "cc-low")
        other = joined_back(large, low, ["u"], F.col("n"), ends).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(low.select("u", F.col("m").alias("v")).union(other), "cc")

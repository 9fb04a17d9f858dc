"""A fitted forest as a table of nodes, and scoring from that table alone.

``forest_nodes`` reads a random forest out of its saved files: a row per node with its split or its share of each class.
``score_nodes`` scores any table by any such rows, without the model: each row starts at the roots of all trees and goes
down one level at a time, by column expressions over constant arrays (the number of nodes is checked against ``MAX_NODES``).
Nothing is shuffled, and Spark compiles it into the scan of the table.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import shared_path

MAX_NODES = 200_000
#: feature: number of the split feature; goes left if it is at most ``threshold``, or is one of ``categories`` if there are any;
#: left, right: null in leaves; shares: of the classes in a leaf.
NODE_SCHEMA = "tree int, node int, feature int, threshold double, categories array<double>, left int, right int, shares array<double>"


def forest_nodes(model: RandomForestClassificationModel, path: str | None = None) -> DataFrame:
    """The nodes of a forest, read from the files that the model is saved in (below ``path``, or a new shared folder)."""
    spark = SparkSession.active()
    path = path or shared_path(spark, "forests", uuid.uuid4().hex)
    model.write().overwrite().save(path)
    rows = spark.read.parquet(f"{path}/data")
    d = "nodeData."
    inner = F.col(f"{d}leftChild") >= 0
    continuous = F.col(f"{d}split.numCategories") < 0
    split = F.col(f"{d}split.leftCategoriesOrThreshold")
    stats = F.col(f"{d}impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda s, v: s + v)
    return rows.select(
        F.col("treeID").cast("int").alias("tree"),
        F.col(f"{d}id").cast("int").alias("node"),
        F.when(inner, F.col(f"{d}split.featureIndex")).alias("feature"),
        F.when(inner & continuous, F.get(split, F.lit(0))).alias("threshold"),
        F.when(inner & ~continuous, split).alias("categories"),
        F.when(inner, F.col(f"{d}leftChild")).alias("left"),
        F.when(inner, F.col(f"{d}rightChild")).alias("right"),
        F.when(~inner, F.transform(stats, lambda v: v / total)).alias("shares"),
    )


def _constant(values: Sequence, kind: str) -> Column:
    """An array of numbers as an expression that Spark folds into one literal."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def _sum_at(values: Column, places: str) -> Column:
    return F.aggregate(places, F.lit(0.0), lambda s, i: s + F.get(values, i))


def score_nodes(df: DataFrame, nodes: DataFrame, features: Sequence[str], keep: Sequence[str] = ("id",)) -> DataFrame:
    """``*keep, prediction, probability``: each class's share summed over the leaves that a row reaches, divided by the sum of all;
    the class with the largest (ties: the smallest). ``nodes``: rows of ``NODE_SCHEMA`` with nodes numbered from the root, 0, in
    each tree; ``features``: the columns by feature number. A null feature counts as NaN, which goes right."""
    rows = nodes.orderBy("tree", "node").limit(MAX_NODES + 1).collect()
    if len(rows) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes: cut the forest into several and add up their shares")
    at = {(r["tree"], r["node"]): i for i, r in enumerate(rows)}
    roots = [at[t, 0] for t in sorted({r["tree"] for r in rows})]
    left = [None if r["left"] is None else at[r["tree"], r["left"]] for r in rows]
    right = [None if r["right"] is None else at[r["tree"], r["right"]] for r in rows]
    depth, level = 0, roots
    while level := [child for i in level if left[i] is not None for child in (left[i], right[i])]:
        depth += 1
    none = lambda values, instead: [instead if v is None else v for v in values]
    lefts, rights = _constant(none(left, -1), "int"), _constant(none(right, -1), "int")
    feature = _constant(none([r["feature"] for r in rows], -1), "int")
    threshold = _constant(none([r["threshold"] for r in rows], math.nan), "double")
    listed = any(r["categories"] for r in rows)
    if listed:
        sets = F.array(*[F.array(*[F.lit(float(v)) for v in r["categories"] or ()]).cast("array<double>") for r in rows])
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(math.nan)) for c in features])

    def down(state: Column) -> Column:
        value = F.get(x, F.get(feature, state))
        goes_left = value <= F.get(threshold, state)
        if listed:
            goes_left = F.when(F.size(F.get(sets, state)) > 0, F.array_contains(F.get(sets, state), value)).otherwise(goes_left)
        child = F.when(goes_left, F.get(lefts, state)).otherwise(F.get(rights, state))
        return F.when(child >= 0, child).otherwise(state)  # leaves stay where they are

    states = _constant(roots, "int")
    for _ in range(depth):
        states = F.transform(states, down)
    classes = max((len(r["shares"]) for r in rows if r["shares"]), default=0)
    out = df.select(*keep, states.alias("__leaves"))
    for c in range(classes):
        share = _constant([r["shares"][c] if r["shares"] else 0.0 for r in rows], "double")
        out = out.withColumn(f"__raw{c}", _sum_at(share, "__leaves"))
    raw = F.array(*[F.col(f"__raw{c}") for c in range(classes)])
    total = F.aggregate(raw, F.lit(0.0), lambda s, v: s + v)
    prediction = (F.array_position(raw, F.array_max(raw)) - 1).cast("double")
    return out.select(*keep, prediction.alias("prediction"), F.transform(raw, lambda v: v / total).alias("probability"))

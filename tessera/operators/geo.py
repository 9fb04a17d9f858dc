"""Assign each point to the box (region) that contains it and whose centre is nearest.

Rules: both box ends inclusive; among the boxes that contain the point the least Euclidean
centre distance (in degrees) wins; on equal distance the box with the lowest ``ord`` wins;
no box → NULL. A box whose min exceeds its max (one crossing the antimeridian) holds nothing
unless ``wrap=True`` splits it in two.

A box is listed at the level whose cells (side ``4^level`` degrees) are at least as large as the box, so it
touches four cells at most, and the listing has at most four rows per box, however many boxes there are.
Small boxes crowd at fine levels, where few of them share a cell. A point looks up one cell per level in use (about
thirty levels exist). Strategies (equal results, see ``tests/test_geo.py``):

* ``broadcast``: one candidate list per cell, joined once per level through a broadcast hash lookup; the winner is picked
  by higher-order functions. No shuffle and no copy of the points. For at most ``max_broadcast_boxes`` boxes.
* ``shuffle``: the distinct coordinates, one row per level, meet the listing in an equi-join that AQE splits where
  a cell is hot; the nearest box per coordinate is a partial aggregation, and joins back to the points. No list is ever
  collected, so a cell may hold any number of boxes.
* ``grid`` (default) takes the first if the boxes are few enough (counted), else the second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.geo import centre_distance, in_box
from tessera.plans.broadcast import row_count_at_most

COORD_LIMIT = 1.0e9  # excludes NaN, ±inf and NULL coordinates before cell arithmetic
FINEST = -10  # smaller boxes (and single points) are listed at this level
BOX_FIELDS = ("min_lon", "min_lat", "max_lon", "max_lat", "c_lon", "c_lat")


def usable_boxes(boxes: DataFrame, wrap: bool = False) -> DataFrame:
    """Boxes that can hold a point: finite coordinates and min <= max on both axes.

    With ``wrap``, a box with ``min_lon > max_lon`` becomes two: ``[min_lon, 180]`` and
    ``[-180, max_lon]``, keeping its code, order and centre.
    """
    b = boxes.select("code", F.col("ord").cast("long").alias("ord"), *[F.col(c).cast("double").alias(c) for c in BOX_FIELDS])
    finite = None
    for c in BOX_FIELDS:
        cond = F.col(c).between(-COORD_LIMIT, COORD_LIMIT)
        finite = cond if finite is None else finite & cond
    b = b.filter(finite)
    if wrap:
        crossing = b.filter(F.col("min_lon") > F.col("max_lon"))
        east = crossing.withColumn("max_lon", F.lit(180.0))
        west = crossing.withColumn("min_lon", F.lit(-180.0))
        b = b.filter(F.col("min_lon") <= F.col("max_lon")).unionByName(east).unionByName(west)
    return b.filter((F.col("min_lon") <= F.col("max_lon")) & (F.col("min_lat") <= F.col("max_lat")))


def listing(boxes: DataFrame) -> DataFrame:
    """``level, cx, cy, box``: the cells that each box touches at its level."""
    extent = F.greatest(F.col("max_lon") - F.col("min_lon"), F.col("max_lat") - F.col("min_lat"))
    level = F.ceil(F.log(4.0, F.greatest(extent, F.lit(4.0**FINEST)))).cast("int")
    box = F.struct(*[F.col(c) for c in BOX_FIELDS], F.col("ord"), F.col("code"))
    at = boxes.select(level.alias("level"), box.alias("box"))
    xs = F.sequence(_cell(F.col("box.min_lon"), F.col("level")), _cell(F.col("box.max_lon"), F.col("level")))
    ys = F.sequence(_cell(F.col("box.min_lat"), F.col("level")), _cell(F.col("box.max_lat"), F.col("level")))
    return at.select("level", "box", F.explode(xs).alias("cx"), ys.alias("ys")).select(
        "level", "cx", F.explode("ys").alias("cy"), "box"
    )


def _cell(x, level):
    side = F.pow(F.lit(4.0), level) if not isinstance(level, int) else F.lit(4.0**level)
    return F.floor(x / side).cast("long")


def _best(x, y, b):
    """What the nearest box is the least of: distance, then order."""
    return F.struct(
        centre_distance(x, y, b["c_lon"], b["c_lat"]).alias("d"), b["ord"].alias("o"), b["code"].alias("c")
    )


def _holds(x, y, b):
    return in_box(x, y, b["min_lon"], b["min_lat"], b["max_lon"], b["max_lat"])


def assign_region(
    points: DataFrame,
    boxes: DataFrame,
    lon: str = "lon",
    lat: str = "lat",
    out: str = "region",
    strategy: str = "grid",
    max_broadcast_boxes: int = 100_000,
    wrap: bool = False,
) -> DataFrame:
    """Add ``{out}`` (box code) and ``{out}_ord`` to every point; NULL where no box holds it.

    Every input row is kept, duplicates included; no row id is needed."""
    good = usable_boxes(boxes, wrap=wrap)
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    if strategy not in ("grid", "broadcast", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    few = strategy != "shuffle" and row_count_at_most(good, max_broadcast_boxes)
    if strategy == "broadcast" and not few:
        raise ValueError(f"more than {max_broadcast_boxes} boxes: use the shuffle strategy")
    cells = listing(good)
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())  # about thirty exist
    if few:
        return _by_broadcast(points, cells, levels, x, y, out)
    return _by_shuffle(points, cells, levels, x, y, out)


def _usable(x, y):
    return x.between(-COORD_LIMIT, COORD_LIMIT) & y.between(-COORD_LIMIT, COORD_LIMIT)


def _by_broadcast(points, cells, levels, x, y, out) -> DataFrame:
    lists = cells.groupBy("level", "cx", "cy").agg(F.collect_list("box").alias("boxes"))  # of at most 4 rows a box
    j, found = points, []
    for i, level in enumerate(levels):
        own = lists.filter(F.col("level") == level).select(
            F.col("cx").alias(f"_cx{i}"), F.col("cy").alias(f"_cy{i}"), F.col("boxes").alias(f"_boxes{i}")
        )
        j = j.withColumn(f"_cx{i}", F.when(_usable(x, y), _cell(x, level))).withColumn(
            f"_cy{i}", F.when(_usable(x, y), _cell(y, level))
        )
        j = j.join(F.broadcast(own), [f"_cx{i}", f"_cy{i}"], "left")
        hits = F.filter(F.col(f"_boxes{i}"), lambda b: _holds(x, y, b))
        found.append(F.array_min(F.transform(hits, lambda b: _best(x, y, b))))
    best = F.array_min(F.array_compact(F.array(*found))) if found else None
    code = best["c"] if found else F.lit(None).cast("string")
    order = best["o"] if found else F.lit(None).cast("long")
    return j.select(*[F.col(f"`{c}`") for c in points.columns], code.alias(out), order.alias(f"{out}_ord"))


def _by_shuffle(points, cells, levels, x, y, out) -> DataFrame:
    keyed = points.withColumn("_x", F.when(_usable(x, y), x)).withColumn("_y", F.when(_usable(x, y), y))
    at = keyed.select("_x", "_y").dropna().distinct()
    asked = at.withColumn("level", F.explode(F.array(*[F.lit(v) for v in levels]) if levels else F.array().cast("array<int>")))
    asked = asked.withColumn("cx", _cell(F.col("_x"), F.col("level"))).withColumn("cy", _cell(F.col("_y"), F.col("level")))
    met = asked.join(cells, ["level", "cx", "cy"]).filter(_holds(F.col("_x"), F.col("_y"), F.col("box")))
    best = met.groupBy("_x", "_y").agg(F.min(_best(F.col("_x"), F.col("_y"), F.col("box"))).alias("_best"))
    return keyed.join(best, ["_x", "_y"], "left").select(
        *[F.col(f"`{c}`") for c in points.columns], F.col("_best.c").alias(out), F.col("_best.o").alias(f"{out}_ord")
    )

import math
import random

import pytest

from conftest import rows
from tessera.operators import geo

BOX_SCHEMA = "code string, ord int, min_lon double, min_lat double, max_lon double, max_lat double, c_lon double, c_lat double"

# --- fixed values: five boxes of the reference's country table (code, ordinal, min lon,
# min lat, max lon, max lat, centre lon, centre lat), enough for its four spot checks ------
REAL_BOXES = [
    ("BE", 19, 2.566667, 49.516667, 6.4, 51.683333, 4.4833335, 50.6),
    ("FR", 77, -5.133333, 41.333333, 9.533333, 51.083333, 2.2, 46.208333),
    ("LU", 134, 5.742778, 49.460833, 6.505833, 50.181667, 6.1243055, 49.82125),
    ("NL", 163, 3.133333, 50.75, 7.2, 53.583333, 5.1666665, 52.1666665),
    ("UK", 228, -13.65, 49.866667, 2.866667, 61.5, -5.3916665, 55.6833335),
]
# Spot checks: (lat, lon) → expected code.
SPOT_CHECKS = [
    (48.856578, 2.351828, "FR"),
    (50.846686, 4.352425, "BE"),
    (50.637222, 3.063333, "BE"),
    (49.4149, 2.823056, "FR"),
]
# --- end of fixed values ---------------------------------------------------------------------


def _assign(spark, pts, boxes, strategy, **kw):
    p = spark.createDataFrame(pts, "id long, lon double, lat double")
    b = spark.createDataFrame(boxes, BOX_SCHEMA)
    return geo.assign_region(p, b, strategy=strategy, **kw)


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_spot_checks(spark, strategy):
    pts = [(i, lon, lat) for i, (lat, lon, _) in enumerate(SPOT_CHECKS)]
    got = {r.id: (r.region, r.region_ord) for r in _assign(spark, pts, REAL_BOXES, strategy).collect()}
    assert got == {0: ("FR", 77), 1: ("BE", 19), 2: ("BE", 19), 3: ("FR", 77)}


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_edges_ties_and_degenerate_boxes(spark, strategy):
    boxes = [
        ("A", 0, 0.0, 0.0, 10.0, 10.0, 5.0, 5.0),
        ("B", 1, 10.0, 0.0, 20.0, 10.0, 15.0, 5.0),  # shares the edge lon = 10 with A
        ("C", 2, 0.0, 0.0, 10.0, 10.0, 5.0, 5.0),  # same as A: A wins ties (lower ord)
        ("P", 3, 30.0, 30.0, 30.0, 30.0, 30.0, 30.0),  # zero-size box
        ("W", 4, 170.0, -10.0, -170.0, 10.0, 180.0, 0.0),  # crosses the antimeridian
    ]
    pts = [
        (1, 0.0, 0.0),  # corner of A (and C)
        (2, 10.0, 5.0),  # on the shared edge: equal distance to A and B → A (ord 0)
        (3, 10.0, 10.0),  # corner of A, B
        (4, 30.0, 30.0),  # the zero-size box
        (5, 175.0, 0.0),  # inside W's span, but W holds nothing
        (6, 50.0, 50.0),  # nowhere
        (7, float("nan"), 5.0),
        (8, None, 5.0),
        (9, 12.0, 5.0),  # B only
    ]
    got = {r.id: r.region for r in _assign(spark, pts, boxes, strategy).collect()}
    assert got == {1: "A", 2: "A", 3: "A", 4: "P", 5: None, 6: None, 7: None, 8: None, 9: "B"}


def test_wrap_splits_antimeridian_box(spark):
    boxes = [("W", 0, 170.0, -10.0, -170.0, 10.0, 180.0, 0.0)]
    pts = [(1, 175.0, 0.0), (2, -175.0, 0.0), (3, 0.0, 0.0)]
    got = {r.id: r.region for r in _assign(spark, pts, boxes, "grid", wrap=True).collect()}
    assert got == {1: "W", 2: "W", 3: None}


def test_duplicates_kept(spark):
    pts = [(1, 5.0, 5.0), (1, 5.0, 5.0), (2, 50.0, 50.0)]
    out = _assign(spark, pts, [("A", 0, 0.0, 0.0, 10.0, 10.0, 5.0, 5.0)], "grid")
    assert out.count() == 3


def test_strategies_equal_brute_force(spark):
    rnd = random.Random(7)
    boxes = []
    for i in range(60):
        x, y = rnd.uniform(-180, 170), rnd.uniform(-90, 80)
        w, h = rnd.choice([0.0, 0.5, 3.0, 25.0]), rnd.choice([0.0, 0.5, 3.0, 25.0])
        boxes.append((f"R{i}", i, x, y, x + w, y + h, x + w / 2, y + h / 2))
    pts = [(i, round(rnd.uniform(-180, 180), 2), round(rnd.uniform(-90, 90), 2)) for i in range(3000)]
    pts += [(10_000 + i, b[2], b[3]) for i, b in enumerate(boxes)]  # box corners
    grid = rows(_assign(spark, pts, boxes, "broadcast"), "id", "region", "region_ord")
    rng = rows(_assign(spark, pts, boxes, "shuffle"), "id", "region", "region_ord")
    assert grid == rng
    # brute force on the driver, for the fixture only
    def best(lon, lat):
        hits = [
            (math.sqrt((b[7] - lat) ** 2 + (b[6] - lon) ** 2), b[1], b[0])
            for b in boxes
            if b[3] <= lat <= b[5] and b[2] <= lon <= b[4]
        ]
        return min(hits)[2] if hits else None

    assert {g[0]: g[1] for g in grid} == {p[0]: best(p[1], p[2]) for p in pts}


def test_listing_is_bounded_by_the_boxes(spark):
    rnd = random.Random(3)
    boxes = []
    for i in range(500):
        x, y, w = rnd.uniform(-180, 180), rnd.uniform(-90, 90), 10 ** rnd.uniform(-8, 2.5)
        boxes.append((f"R{i}", i, x, y, x + w, y + w / 3, x, y))
    good = geo.usable_boxes(spark.createDataFrame(boxes, BOX_SCHEMA))
    assert geo.listing(good).count() <= 4 * len(boxes)


def test_more_boxes_than_the_broadcast_bound(spark):
    """The default goes over to the shuffle join, with the same answers."""
    rnd = random.Random(4)
    boxes = [(f"R{i}", i, x, 0.0, x + 0.4, 0.4, x + 0.2, 0.2) for i, x in enumerate(rnd.uniform(0, 3) for _ in range(200))]
    pts = [(i, round(rnd.uniform(0, 3), 3), 0.1) for i in range(400)]
    over = geo.assign_region(
        spark.createDataFrame(pts, "id long, lon double, lat double"), spark.createDataFrame(boxes, BOX_SCHEMA), max_broadcast_boxes=20
    )
    want = rows(_assign(spark, pts, boxes, "broadcast"), "id", "region", "region_ord")
    assert rows(over, "id", "region", "region_ord") == want
    from tessera.plans.inspect import physical_operators

    assert "BroadcastNestedLoopJoin" not in physical_operators(over)
    with pytest.raises(ValueError, match="shuffle"):
        geo.assign_region(over.select("id", "lon", "lat"), spark.createDataFrame(boxes, BOX_SCHEMA), strategy="broadcast", max_broadcast_boxes=20)


def test_grid_plan_has_no_shuffle_of_points(spark):
    p = spark.range(100).selectExpr("id", "cast(id as double) as lon", "cast(id as double) / 2 as lat")
    b = spark.createDataFrame([("A", 0, 0.0, 0.0, 10.0, 10.0, 5.0, 5.0)], BOX_SCHEMA)
    from tessera.plans.inspect import physical_operators

    plan = physical_operators(geo.assign_region(p, b))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan

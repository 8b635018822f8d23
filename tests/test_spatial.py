"""Spatial joins against plain Python on a small grid of odd shapes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from civiframe.operators import spatial

CONCAVE = [(0, 0), (6000, 300), (5800, 6100), (3100, 2000), (200, 5900)]
HOLE = [(1000, 700), (2000, 700), (2000, 1500), (1000, 1500)]


def rings_of(dx, dy, hole):
    shift = [[(x + dx, y + dy) for x, y in ring] for ring in ([CONCAVE, HOLE] if hole else [CONCAVE])]
    return shift


POLYGONS = [(n, 1 if n < 5 else 0, rings_of(7000 * (n % 3), 7000 * (n // 3), n % 2 == 0)) for n in range(6)]


def edges_of(rings):
    return [(a, b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1])]


def inside(rings, x, y):
    crossings = 0
    for (x1, y1), (x2, y2) in edges_of(rings):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            crossings += 1
    return crossings % 2 == 1


def distance(rings, x, y):
    if inside(rings, x, y):
        return 0.0
    best = math.inf
    for (x1, y1), (x2, y2) in edges_of(rings):
        w = ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)
        w = max(0.0, min(1.0, w))
        best = min(best, math.hypot(x - (x1 + w * (x2 - x1)), y - (y1 + w * (y2 - y1))))
    return best


@pytest.fixture(scope="module")
def polygons(spark):
    rows = [(n, flag, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for n, flag, rings in POLYGONS]
    raw = spark.createDataFrame(
        rows, "code_insee int, commune_agglo int, rings array<array<struct<x:double,y:double>>>"
    )
    return spatial.prepare_polygons(raw)


@pytest.fixture(scope="module")
def points():
    rng = random.Random(11)
    near = [(rng.uniform(-3000, 24000), rng.uniform(-3000, 16000)) for _ in range(300)]
    far = [(-90_000.5, 40_000.5), (500_000.5, 7_000.5), (2_000_000.5, -900_000.5), (60_000_000.0, 1.5)]
    return [(i, x, y) for i, (x, y) in enumerate(near + far)] + [(900, *near[0]), (901, None, None)]


def test_containing(spark, polygons, points):
    df = spark.createDataFrame(points, "id int, px double, py double")
    got = spatial.attach_containing(df, polygons, ["code_insee"]).collect()
    expected = []
    for i, x, y in points:
        hits = [n for n, _, rings in POLYGONS if x is not None and inside(rings, x, y)]
        expected += [(i, n) for n in hits] or [(i, None)]
    assert sorted(((r.id, r.code_insee) for r in got), key=str) == sorted(expected, key=str)


def test_nearest_at_every_range(spark, polygons, points):
    df = spark.createDataFrame(points, "id int, px double, py double")
    rows = {(r.px, r.py): r for r in spatial.nearest_of(df, polygons, "code_insee").collect()}
    assert len(rows) == len({(x, y) for _, x, y in points if x is not None})
    for _, x, y in points:
        if x is None:
            continue
        best = min(distance(rings, x, y) for _, _, rings in POLYGONS)
        assert rows[x, y].distance == pytest.approx(best, abs=1e-6 * max(1.0, best))
        chosen = POLYGONS[rows[x, y].code_insee][2]
        assert distance(chosen, x, y) == pytest.approx(best, abs=1e-6 * max(1.0, best))


def test_point_on_the_outline_is_outside(spark, polygons):
    df = spark.createDataFrame([(1, 3000.0, 150.0), (2, 0.0, 0.0), (3, 1500.0, 1000.0)], "id int, px double, py double")
    got = {r.id: r.code_insee for r in spatial.attach_containing(df, polygons, ["code_insee"]).collect()}
    assert got == {1: None, 2: None, 3: None}  # on an edge, on a corner, in the hole


def test_places_take_the_nearest_agglomeration_area(spark):
    """A fact outside every area gets the nearest one; without position it gets none."""
    x, y = 1_700_000.0, 7_200_000.0
    square = [[{"x": x + a, "y": y + b} for a, b in ((0, 0), (900, 0), (900, 900), (0, 900))]]
    other = [[{"x": x + a, "y": y + b} for a, b in ((950, 0), (1900, 0), (1900, 900), (950, 900))]]
    raw = spark.createDataFrame(
        [(35001, 1, square), (35002, 0, other)],
        "code_insee int, commune_agglo int, rings array<array<struct<x:double,y:double>>>",
    )
    municipalities = spatial.prepare_polygons(raw)
    districts = municipalities.select((F.col("code_insee") - 35000).alias("nuquart"), "pieces")
    facts = spark.createDataFrame(
        [("in", "48.004", "3.006"), ("beyond", "48.004", "3.02"), ("nowhere", None, "3.0")],
        "name string, latitude string, longitude string",
    )
    got = {r.name: (r.code_insee, r.code_quartier) for r in spatial.attribute_places(facts, municipalities, districts).collect()}
    assert got == {"in": (35001, 1), "beyond": (35001, 2), "nowhere": (None, None)}


def test_no_nested_loop_join(spark, polygons, points):
    df = spark.createDataFrame(points, "id int, px double, py double")
    for frame in (spatial.nearest_of(df, polygons, "code_insee"), spatial.attach_containing(df, polygons, ["code_insee"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_facts_are_not_sorted_to_get_their_places(spark, polygons):
    """A sort would hold a task's facts beside the state of what follows the join."""
    facts = spark.createDataFrame([(1, 48.1, 3.0), (2, 48.1, 3.0), (3, None, None), (4, None, 3.0)], "id int, latitude double, longitude double")
    areas = polygons.select("code_insee", F.lit(1).alias("commune_agglo"), "pieces")
    quarters = polygons.select((F.col("code_insee") + 100).alias("nuquart"), "pieces")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = spatial.attribute_places(facts, areas, quarters)
        plan = placed._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join " in line]
        assert "latitude" in joins[0] and "ShuffledHashJoin" in joins[0]
        found = {r.id: r.code_insee for r in placed.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert set(found) == {1, 2, 3, 4} and found[1] == found[2] is not None and found[3] is None and found[4] is None


def ragged(n, x, y, radius, rough=0.3):
    """A star-like outline of ``n`` edges whose corners lie up to ``rough`` of the radius inside it."""
    rng = random.Random(n)
    spokes = [(2 * math.pi * k / n, radius * rng.uniform(1 - rough, 1.0)) for k in range(n)]
    return [(x + r * math.cos(a), y + r * math.sin(a)) for a, r in spokes]


def outlines(spark, rings_by_code):
    rows = [(code, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for code, rings in rings_by_code.items()]
    return spatial.prepare_polygons(spark.createDataFrame(rows, "code_insee int, rings array<array<struct<x:double,y:double>>>"))


def test_a_long_outline_is_stored_about_once(spark):
    """10,000 edges over some 100 cells; cells wholly inside hold none."""
    ring, hole = ragged(10_000, 50_000, 80_000, 11_000, 0.01), ragged(200, 51_000, 81_000, 2_500)
    polygons = outlines(spark, {1: [ring, hole]})
    pieces = polygons.select(F.explode("pieces").alias("p")).select("p.*")
    stored, cells, plain = pieces.agg(F.sum(F.size("edges")), F.count("*"), F.count_if(F.size("edges") == 0)).first()
    assert 60 < cells < 140 and plain > 5 and stored < 1.5 * 10_200
    rng = random.Random(9)
    points = [(i, rng.uniform(38_000, 62_000), rng.uniform(68_000, 92_000)) for i in range(400)]
    points += [(1000 + i, x, y + 0.5) for i, (x, y) in enumerate(ring[::100])]
    got = spatial.attach_containing(spark.createDataFrame(points, "id int, px double, py double"), polygons, ["code_insee"])
    assert {r.id: r.code_insee == 1 for r in got.collect()} == {i: inside([ring, hole], x, y) for i, x, y in points}


def test_upright_level_and_tiny_outlines(spark):
    """Squares smaller and much larger than a cell, with sides along the axes, and one that repeats a corner."""
    square = lambda x, y, side: [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]
    shapes = {1: [square(0, 0, 9000)], 2: [square(-5000, -5000, 10)], 3: [square(4000, 4000, 0.5)], 4: [[(0, 0), (0, 0), (-3000, 0), (-3000, 4000)]]}
    rng = random.Random(2)
    points = [(i, round(rng.uniform(-6000, 10_000), 1), round(rng.uniform(-6000, 10_000), 1)) for i in range(500)]
    points += [(600 + i, x + 0.2, y + 0.2) for i, (x, y) in enumerate([(0, 0), (8999, 8999), (-5000, -5000), (4000, 4000), (4000.4, 4000), (-3000, 0)])]
    df = spark.createDataFrame(points, "id int, px double, py double")
    polygons = outlines(spark, shapes)
    got = sorted(((r.id, r.code_insee) for r in spatial.attach_containing(df, polygons, ["code_insee"]).collect()), key=str)
    wanted = []
    for i, x, y in points:
        hits = [c for c, rings in shapes.items() if inside_of(rings, x, y)]
        wanted += [(i, c) for c in hits] or [(i, None)]
    assert got == sorted(wanted, key=str)
    assert rows_of_empty(spark, df)


def inside_of(rings, x, y):
    return inside([[p for k, p in enumerate(ring) if p != ring[k - 1]] for ring in rings], x, y)


def rows_of_empty(spark, df):
    none = spatial.prepare_polygons(spark.createDataFrame([], "code_insee int, rings array<array<struct<x:double,y:double>>>"))
    left = spatial.attach_containing(df, none, ["code_insee"])
    return left.count() == df.count() and left.where("code_insee is not null").isEmpty() and spatial.nearest_of(df, none, "code_insee").isEmpty()


def test_far_points_meet_few_cells(spark):
    """400 polygons; a point meets a bounded number of cells whether it is near or 500 km away."""
    from civiframe.session import Staged

    polygons = outlines(spark, {n: [ragged(12, 9000 * (n % 20), 9000 * (n // 20), 3000)] for n in range(400)})
    rng = random.Random(5)
    near = [(rng.uniform(0, 170_000), rng.uniform(0, 170_000)) for _ in range(50)]
    far = [(500_000 * math.cos(a), 500_000 * math.sin(a)) for a in range(50)] + [(9e6, -4e7)]
    df = spark.createDataFrame(near + far, "px double, py double")
    with Staged(spark) as work:
        met = {(r.px, r.py): r["count"] for r in spatial.nearest_cells(df, polygons, work).groupBy("px", "py").count().collect()}
        assert len(met) == 101 and max(met.values()) < 60
    cells = polygons.select(F.explode("pieces").alias("p")).select("p.cx", "p.cy").distinct().count()
    assert cells > 3000

"""Areas of several parts with holes against plain geometry: points, tiles, shared places and overlaps."""

import math
import random

import pytest
from pyspark.sql import functions as F

from pednet.functions.geo import tile_bounds
from pednet.operators import polygons as G

SCHEMA = "area_id long, ring int, coords array<struct<lon:double,lat:double>>"


def star(r, x, y, size, n):
    return [(x + size * (0.3 + 0.7 * r.random()) * math.cos(2 * math.pi * i / n), y + size * (0.3 + 0.7 * r.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]


def diamond(x, y, size):
    return [(x + size, y), (x, y + size), (x - size, y), (x, y - size)]


def shapes(seed):
    """Areas: a star with a hole, two parts, a part inside a hole, a large one of many vertices, one line, too few vertices."""
    r = random.Random(seed)
    areas = {}
    for i in range(6):
        x, y = r.uniform(-50, -49), r.uniform(-26, -25)
        areas[i] = [star(r, x, y, 0.3, 15), [(x + 0.05 * math.cos(k), y + 0.05 * math.sin(k)) for k in range(6)]]
        if i % 2:
            areas[i] += [star(r, x + 1, y, 0.1, 7), diamond(x, y, 0.01)]
    areas[7] = [star(r, -49.5, -25.5, 0.8, 700)]
    areas[8] = [[(-49.0, -25.0), (-49.1, -25.1)], [(-49.0, -25.0), (-49.0, -25.0), (-49.0, -25.0)]]
    return areas


def table(spark, areas, closed=False):
    rows = [(a, i, ring + ring[:1] if closed else ring) for a, rings in areas.items() for i, ring in enumerate(rings)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def edges(rings):
    return [(a, b) for ring in rings for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]


def inside(x, y, rings):
    return sum((y1 <= y) != (y2 <= y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1) for (x1, y1), (x2, y2) in edges(rings)) % 2 == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_points(spark, seed):
    areas, r = shapes(seed), random.Random(seed + 10)
    points = [(i, r.uniform(-51, -48), r.uniform(-27, -24)) for i in range(3000)] + [(9001, None, 1.0), (9002, float("nan"), 0.0), (9003, 0.0, float("inf")), (9004, 179.9, 89.0)]
    df = spark.createDataFrame(points, "id long, lon double, lat double").repartition(4)
    got = {(x["id"], x["area_id"]) for x in G.points_in_areas(df, G.cover(table(spark, areas, seed == 1)), ["id"]).collect()}
    want = {(i, a) for i, x, y in points[:3000] for a, rings in areas.items() if inside(x, y, rings)}
    assert got == want and len(want) > 500
    none = table(spark, {8: areas[8]})
    assert G.points_in_areas(df, G.cover(none), ["id"]).count() == 0 and G.points_in_areas(df.limit(0), G.cover(table(spark, areas)), ["id"]).count() == 0


def meets(box, rings):
    """Whether an edge passes the box (Cohen and Sutherland by halving the parameter range), or its corner is inside."""
    w, s, e, n = box
    for (x1, y1), (x2, y2) in edges(rings):
        t0, t1 = 0.0, 1.0
        for d, lo, hi, at in ((x2 - x1, w, e, x1), (y2 - y1, s, n, y1)):
            if d == 0:
                if not lo <= at <= hi:
                    t0, t1 = 1.0, 0.0
            else:
                a, b = sorted(((lo - at) / d, (hi - at) / d))
                t0, t1 = max(t0, a), min(t1, b)
        if t0 <= t1:
            return True
    return inside(w, s, rings)


def test_tiles(spark):
    areas = {a: r for a, r in shapes(3).items() if a in (0, 1, 7)}
    got = {(r["area_id"], r["x"], r["y"]) for r in G.tiles_x_areas(table(spark, areas), 13).collect()}
    xs, ys = [x for _, x, _ in got], [y for *_, y in got]
    box = tile_bounds("x", "y", 13)
    grid = spark.range(min(xs) - 2, max(xs) + 3).withColumnRenamed("id", "x").withColumn("y", F.explode(F.sequence(F.lit(min(ys) - 2), F.lit(max(ys) + 2)))).select("x", "y", box.alias("b")).collect()
    assert got == {(a, t["x"], t["y"]) for t in grid for a, rings in areas.items() if meets(tuple(t["b"]), rings)} and len(got) > 300


def rotated(x1, y1, r1, x2, y2, r2):
    """What two diamonds share: squares by x + y and x - y."""
    side = [min(a + r1, b + r2) - max(a - r1, b - r2) for a, b in ((x1 + y1, x2 + y2), (x1 - y1, x2 - y2))]
    return max(0.0, side[0]) * max(0.0, side[1]) / 2


def test_overlaps(spark):
    """Diamonds with diamond holes, at random; closed forms."""
    r = random.Random(5)
    one = {i: (r.uniform(0, 1), r.uniform(0, 1), r.uniform(0.1, 0.3)) for i in range(12)}
    two = {i: (r.uniform(0, 1), r.uniform(0, 1), r.uniform(0.1, 0.3)) for i in range(12)}
    a = table(spark, {i: [diamond(*d), diamond(d[0], d[1], d[2] / 2)[::-1 if i % 2 else 1]] for i, d in one.items()})
    b = table(spark, {i: [diamond(*d)[::-1 if i % 3 else 1]] for i, d in two.items()})
    want = {(i, j): rotated(*x, *y) - rotated(x[0], x[1], x[2] / 2, *y) for i, x in one.items() for j, y in two.items()}
    got = {(r["area_id"], r["other_id"]): r["overlap"] for r in G.overlaps(a, b).collect()}
    for k, v in want.items():
        assert got.get(k, 0.0) == pytest.approx(v, abs=1e-8), k
    near = {(r["area_id"], r["other_id"]) for r in G.meeting_areas(a, b).collect()}
    assert {k for k, v in want.items() if v > 1e-9} <= near and all(want[k] > -1e-9 for k in near) and len(near) < len(want)


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]


def test_edges_upon_edges(spark):
    """The same square, its neighbour, a half, one within along an edge."""
    one = table(spark, {1: [square(0.0, 0.0, 1.0)]})
    two = table(spark, {1: [square(0.0, 0.0, 1.0)], 2: [square(1.0, 0.0, 1.0)], 3: [[(0.5, 0.0), (1.0, 0.0), (1.0, 1.0), (0.5, 1.0)]], 4: [square(0.25, 0.0, 0.5)], 5: [square(3.0, 3.0, 1.0)], 6: [square(-1.0, -1.0, 4.0)], 7: [square(-1.0, -1.0, 4.0), square(0.0, 0.0, 1.0)]})
    got = {r["other_id"]: r["overlap"] for r in G.overlaps(one, two).collect()}
    for k, v in {1: 1.0, 2: 0.0, 3: 0.5, 4: 0.25, 5: 0.0, 6: 1.0, 7: 0.0}.items():
        assert got.get(k, 0.0) == pytest.approx(v, abs=1e-9), k


def test_local_projects(spark):
    boundary = table(spark, {99: [square(0.0, 0.0, 1.0), square(0.4, 0.4, 0.2)]})
    areas = {1: [square(0.1, 0.1, 0.1)], 2: [square(5.0, 5.0, 0.1)], 3: [square(-9.0, -9.0, 20.0)], 4: [square(-0.1, -0.1, 1.3)], 5: [square(0.45, 0.45, 0.1)]}
    projects = spark.createDataFrame([(i, "p") for i in (1, 2, 3, 4, 5, 6)], "project_id long, name string")
    got = G.local_projects_by_area(projects, table(spark, areas), boundary)
    assert {r["project_id"] for r in got.collect()} == {1, 4, 6} and got.columns == ["project_id", "name"]  # 5 lies in the hole


def test_touching_decimals(spark):
    """Diamonds that touch along an edge or at a corner by their decimals meet, whichever way doubles round them; those a little farther off don't."""
    x, y, size = -49.2999, -25.4699, 0.012
    one, want = {}, set()
    for i in range(1, 13):
        for j in range(0, 12 + i + 1):
            for far in (0, 1):  # steps of 0.001 from the middle, in all 12 + i (touching), or 1e-7 more
                k = 1000 * i + 10 * j + far
                one[k] = [diamond(round(x + 0.001 * j + far * 1e-7, 7), round(y + 0.001 * (12 + i - j), 7), 0.001 * i)]
                want |= set() if far else {k}
    got = G.meeting_areas(table(spark, one), table(spark, {1: [diamond(x, y, size)]}))
    assert {r["area_id"] for r in got.collect()} == want


def test_same_shapes(spark):
    """Areas of the same rings, in any order of these, are one shape."""
    a, b, c = square(0.0, 0.0, 1.0), square(3.0, 0.0, 1.0), square(0.0, 0.0, 2.0)
    shapes, members = G.by_shape(table(spark, {1: [a, b], 2: [c], 3: [b, a], 4: [a], 5: [c]}))
    assert {(r["area_id"], r["shape_id"]) for r in members.collect()} == {(1, 1), (2, 2), (3, 1), (4, 4), (5, 2)}
    assert sorted(r["area_id"] for r in shapes.collect()) == [1, 1, 2, 4]


def test_overlaps_of_a_crowd(spark):
    """What a pair costs doesn't go with the crowd around it: steps are those of each area's few tiles."""
    at = {i: [diamond(0.0005 * (i % 10), 0.0005 * (i // 10), 0.00413)] for i in range(100)}
    edges = G._oriented(table(spark, at)).withColumn("own", F.lit(16))
    assert G._steps(edges, [16]).count() <= 40 * len(at)
    got = {(r["area_id"], r["other_id"]): r["overlap"] for r in G.overlaps(table(spark, at), table(spark, at)).collect()}
    for k in ((0, 0), (0, 9), (0, 99), (55, 44), (90, 9)):
        p, q = (((0.0005 * (i % 10)), 0.0005 * (i // 10), 0.00413) for i in k)
        assert got.get(k, 0.0) == pytest.approx(rotated(*p, *q), abs=1e-12), k


def test_plan_without_vertices(spark):
    """The plan of a cover is the same for three vertices and for many."""
    r = random.Random(1)
    size = [len(G.area_edges(table(spark, {1: [star(r, 0.0, 0.0, 1.0, n)]}))._jdf.queryExecution().analyzed().toString()) for n in (3, 900)]
    assert abs(size[0] - size[1]) < 200


def test_mask(spark):
    dem = spark.range(900).select((F.col("id") % 30).alias("px"), F.floor(F.col("id") / 30).alias("py"), F.lit(1.0).alias("elev"))
    areas = {1: [square(0.0513, -0.2513, 0.2), square(0.1013, -0.1913, 0.09)]}
    got = {(r["px"], r["py"]) for r in G.mask_to_areas(dem, table(spark, areas), 0.0, 0.0, 0.01).collect()}
    assert got == {(x, y) for x in range(30) for y in range(30) if inside((x + 0.5) * 0.01, -(y + 0.5) * 0.01, areas[1])} and len(got) > 100

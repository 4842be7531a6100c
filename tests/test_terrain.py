"""Rasters in blocks against plain loops: gaps, nulls, NaN, negative pixels, blocks smaller than the raster; one shuffle."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pednet.operators import terrain as R


def raster(seed):
    r = random.Random(seed)
    out = {}
    for x in range(-7, 30):
        for y in range(-3, 25):
            if r.random() < 0.9:
                out[x, y] = r.choice([None, float("nan")]) if r.random() < 0.05 else 100 + 10 * math.sin(x / 4) + y + r.random()
    return out


def smooth(dem, sigma):
    n = math.ceil(3 * sigma)
    for dx, dy in ((1, 0), (0, 1)):
        out = {}
        for (x, y), h in dem.items():
            near = [(math.exp(-k * k / (2 * sigma * sigma)), dem.get((x + k * dx, y + k * dy))) for k in range(-n, n + 1)]
            near = [(w, v) for w, v in near if v is not None and not math.isnan(v)]
            out[x, y] = None if h is None or not near else sum(w * v for w, v in near) / sum(w for w, _ in near)
        dem = out
    return dem


def slope(dem, lat0, pixel):
    out = {}
    for (x, y), h in dem.items():
        parts = []
        for dx, dy, size in ((1, 0, pixel * R.DEGREE_M * math.cos(math.radians(lat0 - (y + 0.5) * pixel))), (0, 1, pixel * R.DEGREE_LAT_M)):
            (a, i), (b, j) = ((dem[x + k * dx, y + k * dy], k) if (x + k * dx, y + k * dy) in dem else (h, 0) for k in (-1, 1))
            parts.append(0.0 if a is None or b is None or i == j else (b - a) / (j - i) / size)
        out[x, y] = math.hypot(*parts) * 100
    return out


def same(got, want):
    assert set(got) == set(want)
    for k, v in want.items():
        assert (got[k] is None) == (v is None) and (v is None or (math.isnan(v) and math.isnan(got[k])) or got[k] == pytest.approx(v, rel=1e-9)), k


@pytest.mark.parametrize("block", [8, 256])
@pytest.mark.parametrize("sigma", [0.5, 1.3])
def test_blocks(spark, monkeypatch, block, sigma):
    monkeypatch.setattr(R, "BLOCK", block)
    dem = raster(block)
    df = spark.createDataFrame([(x, y, h, "k") for (x, y), h in dem.items()], "px long, py long, elev double, note string").repartition(3)
    got = R.smooth_gaussian(df, sigma)
    assert got.columns == ["px", "py", "elev", "note"]
    same({(r["px"], r["py"]): r["elev"] for r in got.collect()}, smooth(dem, sigma))
    got = R.terrain(df, sigma, -25.0, 0.0003)
    want = slope(smooth(dem, sigma), -25.0, 0.0003)
    same({(r["px"], r["py"]): r["slope_percent"] for r in got.collect()}, want)
    assert {(r["px"], r["py"]): r["terrain"] for r in got.collect()} == {k: sum(v > t for t in R.THRESHOLDS) for k, v in want.items()}


def test_one_shuffle(spark):
    df = spark.range(900).select((F.col("id") % 30).alias("px"), F.floor(F.col("id") / 30).alias("py"), F.rand(1).alias("elev"))
    plan = R.terrain(df, 1.0, 0.0, 0.0003)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "collect_list" not in plan
    assert R.terrain(df.limit(0), 1.0, 0.0, 0.0003).count() == 0


LINE = "id long, coords array<struct<lon:double,lat:double>>, incline string"


def walk(line, baseline, n):
    """Places along a line whose ends are drawn out, by walking its steps in metres."""
    lats = [p[1] for p in line]
    k = math.cos(math.radians((min(lats) + max(lats)) / 2)) * R.DEGREE_M
    xy = [(p[0] * k, p[1] * R.DEGREE_LAT_M) for p in line]
    xy = [p for i, p in enumerate(xy) if i == 0 or p != xy[i - 1]]
    grow = max(0.0, baseline - sum(math.dist(a, b) for a, b in zip(xy, xy[1:], strict=False))) / 2
    far = lambda p, q: (p[0] + (p[0] - q[0]) / math.dist(p, q) * grow, p[1] + (p[1] - q[1]) / math.dist(p, q) * grow)
    xy = [far(xy[0], xy[1]), *xy[1:-1], far(xy[-1], xy[-2])]
    total, out = sum(math.dist(a, b) for a, b in zip(xy, xy[1:], strict=False)), []
    for i in range(n):
        left = d = total * i / (n - 1)
        for j, (a, b) in enumerate(zip(xy, xy[1:], strict=False)):
            m = math.dist(a, b)
            if left <= m or j == len(xy) - 2:
                t = left / m
                out.append((d, (a[0] + t * (b[0] - a[0])) / k, (a[1] + t * (b[1] - a[1])) / R.DEGREE_LAT_M))
                break
            left -= m
    return out


def test_places_along_lines(spark):
    r = random.Random(3)
    lines = {i: [(-49.0 + r.random() * 0.003, -25.0 + r.random() * 0.003) for _ in range(r.randrange(2, 9))] for i in range(40)}
    lines[50] = [(-49.0, -25.0), (-49.0, -25.0), (-49.0, -25.0001), (-49.0, -25.0001)]
    rows = [(i, c, None) for i, c in lines.items()] + [(60, [(-49.0, -25.0)] * 3, None), (61, [(-49.0, None), (-49.0, -25.0)], None), (62, None, None), (63, [], None)]
    for baseline, n in ((0.0, 5), (500.0, 7)):
        got = {}
        for x in R.sample_along(spark.createDataFrame(rows, LINE).repartition(3), baseline, n).collect():
            got.setdefault(x["id"], {})[x["i"]] = (x["distance_m"], x["lon"], x["lat"])
        assert set(got) == set(lines)
        for i, c in lines.items():
            for j, want in enumerate(walk(c, baseline, n)):
                assert got[i][j] == pytest.approx(want, abs=1e-7), (i, j)
    with pytest.raises(ValueError):
        R.sample_along(spark.createDataFrame(rows, LINE), 0.0, 1)


def test_providers_in_order(spark):
    """Fine pixels in the west with a gap, coarse ones beyond; the fine source goes first, implausible slopes go on to the next source."""
    tilt = lambda x, y: 100 + 0.5 * x
    fine = spark.createDataFrame([(x, y, float("nan") if x < 2 else 5000.0 * x if y > 45 else tilt(x, y)) for x in range(50) for y in range(60)], "px long, py long, elev double")
    coarse = spark.createDataFrame([(x, y, tilt(10 * x, 10 * y)) for x in range(10) for y in range(6)], "px long, py long, elev double")
    providers = [R.Provider("coarse", coarse, 0.0, 0.0, 0.001, 90, priority=1, confidence=55), R.Provider("fine", fine, 0.0, 0.0, 0.0001, 10, priority=5, confidence=80, baseline_m=60.0)]
    east = lambda x0, x1, y: [(x0, y), ((x0 + x1) / 2, y), (x1, y)]
    lines = {1: (east(0.0011, 0.0031, -0.001), None), 2: (east(0.0061, 0.0085, -0.001), " Up "), 3: (east(0.5, 0.51, -0.001), "up"), 4: (east(0.0011, 0.0031, -0.0055), "down"), 5: (east(0.0031, 0.0011, -0.001), "downhill"), 6: (east(0.00001, 0.0014, -0.001), "5%")}
    got = {x["id"]: x for x in R.resolve_slopes(spark.createDataFrame([(i, c, w) for i, (c, w) in lines.items()], LINE), providers).collect()}
    assert {i: x["slope_source"] for i, x in got.items()} == {1: "fine", 2: "coarse", 3: "missing", 4: "coarse", 5: "fine", 6: "fine"}
    slope = 0.5 / (0.0001 * R.DEGREE_M) * 100
    for i, sign in ((1, 1), (2, 1), (4, -1), (5, -1)):
        assert got[i]["slope_percent"] == pytest.approx(sign * slope, rel=0.25), i
    assert got[3]["slope_percent"] is None and (got[3]["slope_confidence"], got[3]["slope_samples"], got[3]["slope_resolution_m"]) == (0, 0, None)
    assert got[1]["slope_confidence"] == 80 and got[2]["slope_confidence"] == got[4]["slope_confidence"] == got[5]["slope_confidence"] == R.QUALITATIVE
    assert got[6]["slope_samples"] < 7 and got[6]["slope_confidence"] == round(80 * got[6]["slope_samples"] / 7)
    assert got[1]["slope_resolution_m"] == 10 and got[2]["slope_resolution_m"] == 90
    shares = {x["slope_source"]: (x["n"], x["share"]) for x in R.coverage(spark.createDataFrame(list(got.values()), T._parse_datatype_string("id long, slope_percent double, slope_source string, slope_confidence int, slope_resolution_m double, slope_samples int"))).collect()}
    assert shares == {"fine": (3, 0.5), "coarse": (2, 2 / 6), "missing": (1, 1 / 6)}
    assert {x["slope_source"] for x in R.resolve_slopes(spark.createDataFrame([(1, lines[1][0], None)], LINE), []).collect()} == {"missing"}


def test_slope_at_the_limit(spark):
    """A median of exactly 40 % isn't steeper than 40, though its parts are no round doubles."""
    lines = {1: ((20.0, 0.0), (40.0, 49.0), (40.0, -33.0)), 2: ((20.0, 0.0), (40.0, -49.0), (40.0, 33.0)), 3: ((20.0, 0.0), (40.0, 49.1), (40.0, -33.0))}
    rows = spark.createDataFrame([(i, d, h) for i, v in lines.items() for d, h in v], "id long, distance_m double, elev double")
    got = {r["id"]: (r["slope_percent"], r["slope_confidence"]) for r in R.edge_slope(rows, 70).collect()}
    assert got == {1: (40.0, 30), 2: (-40.0, 30), 3: (None, 0)}

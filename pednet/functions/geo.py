"""Distances, projection, tiles and clipping as column expressions (lon, lat in degrees)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from pednet.functions.normalize import col

# Mean earth radius in metres; metres in a degree as used for small boxes and for rasters; vertex tolerance in degrees.
EARTH_M = 6_371_008.8
DEGREE_M = 111_320.0
DEGREE_LAT_M = 110_574.0
TOLERANCE = 1e-5

_A, _F = 6_378_137.0, 1 / 298.257223563  # WGS 84


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in metres (N19); null where a coordinate is."""
    lon1, lat1, lon2, lat2 = map(col, (lon1, lat1, lon2, lat2))
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.when(a > 1, 1.0).otherwise(F.sqrt(a)))  # least() would skip a null


def utm_zone(lon) -> Column:
    """The UTM zone, 1 to 60."""
    return F.least(F.lit(60), F.greatest(F.lit(1), F.floor((col(lon) + 180) / 6) + 1)).cast("int")


def zone_of(lon: float) -> int:
    return min(60, max(1, math.floor((lon + 180) / 6) + 1))


def utm(lon, lat, zone: int) -> tuple[Column, Column]:
    """Easting and northing (no false northing) of a fixed zone, by Krueger's series to the third order."""
    n = _F / (2 - _F)
    radius = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    e = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(col(lat)), F.radians(col(lon) - (zone * 6 - 183))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500_000 + 0.9996 * radius * east, 0.9996 * radius * north


def planar_m(lon1, lat1, lon2, lat2, zone: int) -> Column:
    """Distance in metres in a UTM zone."""
    (x1, y1), (x2, y2) = utm(lon1, lat1, zone), utm(lon2, lat2, zone)
    return F.hypot(x2 - x1, y2 - y1)


def length_m(coords, zone: int) -> Column:
    """Planar length of a polyline: array<struct<lon, lat>> (N16); points have 0."""
    c = col(coords)
    steps = F.zip_with(F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), lambda a, b: planar_m(a["lon"], a["lat"], b["lon"], b["lat"], zone))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x)


def ring_area(coords, zone: int) -> Column:
    """Planar area of a closed ring by the shoelace formula."""
    c = col(coords)
    n = F.greatest(F.size(c) - 1, F.lit(0))

    def cross(a, b):
        (x1, y1), (x2, y2) = utm(a["lon"], a["lat"], zone), utm(b["lon"], b["lat"], zone)
        return x1 * y2 - x2 * y1

    return F.abs(F.aggregate(F.zip_with(F.slice(c, F.lit(1), n), F.slice(c, F.lit(2), n), cross), F.lit(0.0), lambda s, x: s + x)) / 2


def bounds(coords) -> Column:
    """struct(xmin, ymin, xmax, ymax) of a vertex array."""
    c = col(coords)
    lon, lat = F.transform(c, lambda p: p["lon"]), F.transform(c, lambda p: p["lat"])
    return F.struct(F.array_min(lon).alias("xmin"), F.array_min(lat).alias("ymin"), F.array_max(lon).alias("xmax"), F.array_max(lat).alias("ymax"))


def representative_point(coords) -> Column:
    """The middle vertex."""
    return F.element_at(col(coords), (F.floor(F.size(col(coords)) / 2) + 1).cast("int"))


def tile_x(lon, zoom) -> Column:
    return F.floor((col(lon) + 180) / 360 * F.pow(F.lit(2.0), zoom if isinstance(zoom, Column) else F.lit(zoom))).cast("long")


def tile_y(lat, zoom) -> Column:
    rad = F.radians(col(lat))
    return F.floor((1 - F.asinh(F.tan(rad)) / math.pi) / 2 * F.pow(F.lit(2.0), zoom if isinstance(zoom, Column) else F.lit(zoom))).cast("long")


def tile_bounds(x, y, zoom: int) -> Column:
    """struct(w, s, e, n) of an XYZ tile."""
    n = float(1 << zoom)
    lat = lambda v: F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * v / n))))
    x, y = col(x), col(y)
    return F.struct((x / n * 360 - 180).alias("w"), lat(y + 1).alias("s"), ((x + 1) / n * 360 - 180).alias("e"), lat(y).alias("n"))


def tile_id(z, x, y) -> Column:
    return F.concat_ws("/", col(z).cast("string"), col(x).cast("string"), col(y).cast("string"))


def tile_parent(x, y, up: int = 1) -> tuple[Column, Column]:
    """x, y of the tile `up` zooms above."""
    return F.shiftright(col(x), up), F.shiftright(col(y), up)


def tile_children(x, y) -> Column:
    """Array of (x, y) of the four tiles a zoom below."""
    x, y = col(x), col(y)
    return F.array(*[F.struct((2 * x + i).alias("x"), (2 * y + j).alias("y")) for j in (0, 1) for i in (0, 1)])


def parse_tile(c) -> Column:
    """struct(z, x, y) of a z/x/y text; null where it isn't one."""
    part = lambda i: F.regexp_extract(col(c), r"^(\d+)/(\d+)/(\d+)$", i).try_cast("long")
    return F.when(part(1).isNotNull(), F.struct(part(1).cast("int").alias("z"), part(2).alias("x"), part(3).alias("y")))


def line_length_in_bounds(parts, w: float, s: float, e: float, n: float) -> Column:
    """Metres of a line of several parts (arrays of lon, lat) inside a box, to six places."""
    box = [F.lit(float(v)) for v in (w, s, e, n)]

    def inside(p):
        k = F.greatest(F.size(p) - 1, F.lit(0))
        c = F.zip_with(F.slice(p, F.lit(1), k), F.slice(p, F.lit(2), k), lambda a, b: clip(a["lon"], a["lat"], b["lon"], b["lat"], *box))
        return F.transform(c, lambda x: F.coalesce(haversine_m(x["lon1"], x["lat1"], x["lon2"], x["lat2"]), F.lit(0.0)))

    return F.round(F.aggregate(F.flatten(F.transform(col(parts), inside)), F.lit(0.0), lambda a, x: a + x), 6)


def vertex_key(lon, lat, tolerance: float = TOLERANCE) -> tuple[Column, Column]:
    """Lattice coordinates of a vertex (N24); null where not finite."""
    ok = (F.abs(col(lon)) < float("inf")) & (F.abs(col(lat)) < float("inf"))
    return F.when(ok, F.floor(col(lon) / tolerance + 0.5)).cast("long"), F.when(ok, F.floor(col(lat) / tolerance + 0.5)).cast("long")


def clip(lon1, lat1, lon2, lat2, w, s, e, n) -> Column:
    """struct(lon1, lat1, lon2, lat2) of a segment within a box (Liang and Barsky), null if outside."""
    x1, y1, x2, y2, w, s, e, n = map(col, (lon1, lat1, lon2, lat2, w, s, e, n))
    dx, dy = x2 - x1, y2 - y1
    low, high = [F.lit(0.0)], [F.lit(1.0)]
    for d, near, far, at in ((dx, w, e, x1), (dy, s, n, y1)):
        a, b = (near - at) / F.nullif(d, F.lit(0.0)), (far - at) / F.nullif(d, F.lit(0.0))
        low.append(F.when(d != 0, F.least(a, b)).otherwise(F.when((at >= near) & (at <= far), 0.0).otherwise(2.0)))
        high.append(F.when(d != 0, F.greatest(a, b)).otherwise(1.0))
    t0, t1 = F.greatest(*low), F.least(*high)
    return F.when(t0 <= t1, F.struct((x1 + t0 * dx).alias("lon1"), (y1 + t0 * dy).alias("lat1"), (x1 + t1 * dx).alias("lon2"), (y1 + t1 * dy).alias("lat2")))


def project_on_segment(lon, lat, lon1, lat1, lon2, lat2) -> Column:
    """struct(t, lon, lat, distance_m): the nearest place on a segment, in metres at the point's latitude."""
    lon, lat, lon1, lat1, lon2, lat2 = map(col, (lon, lat, lon1, lat1, lon2, lat2))
    k = F.cos(F.radians(lat)) * math.pi / 180 * EARTH_M
    m = math.pi / 180 * EARTH_M
    ax, ay, dx, dy = (lon1 - lon) * k, (lat1 - lat) * m, (lon2 - lon1) * k, (lat2 - lat1) * m
    size = dx * dx + dy * dy
    t = F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), -(ax * dx + ay * dy) / size))).otherwise(0.0)
    return F.struct(t.alias("t"), (lon1 + t * (lon2 - lon1)).alias("lon"), (lat1 + t * (lat2 - lat1)).alias("lat"), F.hypot(ax + t * dx, ay + t * dy).alias("distance_m"))


def square(lat: float, lon: float, size_m: float = 1000) -> tuple[float, float, float, float]:
    """w, s, e, n of a square of size_m metres around a point."""
    if not all(map(math.isfinite, (lat, lon, size_m))) or not (-90 < lat < 90 and -180 <= lon <= 180 and size_m > 0):
        raise ValueError("no square of that place and size")
    dy = size_m / 2 / DEGREE_M
    dx = size_m / 2 / (DEGREE_M * math.cos(math.radians(lat)))
    return round(lon - dx, 6), round(lat - dy, 6), round(lon + dx, 6), round(lat + dy, 6)


def in_bounds(df, w: float, s: float, e: float, n: float):
    """Rows whose xmin, ymin, xmax, ymax meet the box (F6); reaches the Parquet scan as min and max filters."""
    return df.where((F.col("xmin") <= e) & (F.col("xmax") >= w) & (F.col("ymin") <= n) & (F.col("ymax") >= s))


def robust_slope(distances, elevations) -> Column:
    """Median of the slopes of all pairs of valid samples, in percent; null with fewer than two."""
    both = F.filter(F.arrays_zip(col(distances).alias("d"), col(elevations).alias("h")), lambda p: p["d"].isNotNull() & p["h"].isNotNull() & ~F.isnan(p["d"]) & ~F.isnan(p["h"]))
    pairs = F.flatten(F.transform(both, lambda p: F.transform(F.filter(both, lambda q: q["d"] > p["d"]), lambda q: 100 * (q["h"] - p["h"]) / (q["d"] - p["d"]))))
    s = F.array_sort(pairs)
    k = F.size(s)
    half = lambda i: F.get(s, i.cast("int"))
    return F.when(k > 0, (half(F.floor((k - 1) / 2)) + half(F.floor(k / 2))) / 2)

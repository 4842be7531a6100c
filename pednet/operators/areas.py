"""Polygons: points and tiles in an area, projects near it, and rasters cut to it. An area is a ring of (lon, lat) given by the caller."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pednet.functions.geo import clip, tile_bounds, tile_x, tile_y


def in_ring(lon: Column, lat: Column, ring: list[tuple[float, float]]) -> Column:
    """Whether a point lies within a ring, by the parity of edges that a ray crosses."""
    n = F.lit(0)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        if y1 != y2:
            cross = ((lat < y1) != (lat < y2)) & (lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1)
            n = n + cross.cast("int")
    return n % 2 == 1


def ring_meets_box(ring: list[tuple[float, float]], w: Column, s: Column, e: Column, n: Column) -> Column:
    """Whether a box meets an area: one of its corners is inside, or an edge of the ring passes through it."""
    test = in_ring(w, s, ring)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        test = test | clip(F.lit(float(x1)), F.lit(float(y1)), F.lit(float(x2)), F.lit(float(y2)), w, s, e, n).isNotNull()
    return test


def tiles_x_boundary(spark, ring: list[tuple[float, float]], zoom: int) -> DataFrame:
    """x, y of the tiles that meet an area."""
    lon, lat = [p[0] for p in ring], [p[1] for p in ring]
    one = spark.range(1)
    corners = one.select(tile_x(F.lit(float(min(lon))), zoom).alias("x0"), tile_x(F.lit(float(max(lon))), zoom).alias("x1"), tile_y(F.lit(float(max(lat))), zoom).alias("y0"), tile_y(F.lit(float(min(lat))), zoom).alias("y1"))
    tiles = corners.select(F.explode(F.sequence("x0", "x1")).alias("x"), "y0", "y1").select("x", F.explode(F.sequence("y0", "y1")).alias("y"))
    b = tile_bounds("x", "y", zoom)
    return tiles.where(ring_meets_box(ring, b["w"], b["s"], b["e"], b["n"]))


def local_projects(df: DataFrame, ring: list[tuple[float, float]], ratio: float = 2.0) -> DataFrame:
    """Projects whose box meets the area and is at most ratio times as large (F11); those without a box stay. df: w, s, e, n."""
    area = abs(sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True))) / 2
    own = (F.col("e") - F.col("w")) * (F.col("n") - F.col("s"))
    return df.where(F.coalesce(ring_meets_box(ring, F.col("w"), F.col("s"), F.col("e"), F.col("n")) & (own <= ratio * area), F.lit(True)))


def mask_to_boundary(dem: DataFrame, ring: list[tuple[float, float]], lon0: float, lat0: float, pixel: float) -> DataFrame:
    """Pixels whose centre lies in the area."""
    return dem.where(in_ring(lon0 + (F.col("px") + 0.5) * pixel, lat0 - (F.col("py") + 0.5) * pixel, ring))


def mosaic(first: DataFrame, second: DataFrame) -> DataFrame:
    """The first raster's pixels, and the second's where it has none."""
    return first.withColumnRenamed("elev", "a").join(second.withColumnRenamed("elev", "b"), ["px", "py"], "full_outer").select("px", "py", F.coalesce("a", "b").alias("elev"))


def downsample(dem: DataFrame, factor: int) -> DataFrame:
    """Means of factor x factor pixels."""
    return dem.groupBy(F.floor(F.col("px") / factor).alias("px"), F.floor(F.col("py") / factor).alias("py")).agg(F.avg("elev").alias("elev"))


def slope_cache(edges: DataFrame, cache: DataFrame, compute) -> DataFrame:
    """Slopes by fingerprint (R3): cached ones of current keys, and compute(edges) for the rest. Both have a fingerprint column."""
    known = cache.join(edges.select("fingerprint").distinct(), "fingerprint", "left_semi")
    return known.unionByName(compute(edges.join(known.select("fingerprint"), "fingerprint", "left_anti")), allowMissingColumns=True)


def dem_tile_name(lat: Column, lon: Column, metres: int) -> Column:
    """The name of an elevation tile of one degree."""
    if metres not in (30, 90):
        raise ValueError("elevation tiles have 30 or 90 metres")
    side = lambda v, plus, minus, width: F.concat(F.when(v >= 0, plus).otherwise(minus), F.lpad(F.abs(F.floor(v)).cast("string"), width, "0"), F.lit("_00"))
    return F.concat_ws("_", F.lit("Copernicus_DSM_COG"), F.lit("10" if metres == 30 else "30"), side(lat, "N", "S", 2), side(lon, "E", "W", 3), F.lit("DEM"))


def square_ring(w: float, s: float, e: float, n: float) -> list[tuple[float, float]]:
    if not all(map(math.isfinite, (w, s, e, n))):
        raise ValueError("bounds must be finite")
    return [(w, s), (e, s), (e, n), (w, n)]

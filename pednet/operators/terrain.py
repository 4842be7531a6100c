"""Slope from elevation tables: rasters are tables of (px, py, elev), each pixel once, processed in blocks with halos by windows along rows and columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pednet.functions.geo import DEGREE_LAT_M, DEGREE_M, robust_slope
from pednet.operators.shared import checkpointed
from pednet.operators.spatial import dem_sample

# Slopes in percent that separate terrain classes.
THRESHOLDS = (2.0, 5.0, 8.33, 12.5)


#: Pixels along a block of a raster. A task holds blocks, each with a halo of its neighbours' pixels.
BLOCK = 256
_AT = ["__bx", "__by"]


def blocks(dem: DataFrame, halo: int) -> DataFrame:
    """Pixels dealt to blocks (__bx, __by), and copied to those neighbours that they are within halo of, three at most (__own: a pixel's own block)."""
    size = max(BLOCK, 2 * halo)

    def near(c):
        inside = F.pmod(F.col(c), F.lit(size))
        return F.array_compact(F.array(F.lit(0), F.when(inside < halo, F.lit(-1)), F.when(inside >= size - halo, F.lit(1))))

    rows = dem.select("*", F.explode(near("px")).alias("__i")).select("*", F.explode(near("py")).alias("__j"))
    rows = rows.withColumns({"__bx": F.floor(F.col("px") / size) + F.col("__i"), "__by": F.floor(F.col("py") / size) + F.col("__j"), "__own": (F.col("__i") == 0) & (F.col("__j") == 0)})
    return rows.drop("__i", "__j").repartition(*_AT)


def own(rows: DataFrame) -> DataFrame:
    """Each pixel once, without the columns of blocks."""
    return rows.where("__own").drop("__own", *_AT)


def _smooth(rows: DataFrame, sigma: float) -> DataFrame:
    r = math.ceil(3 * sigma)
    for along, across in (("px", "py"), ("py", "px")):
        w = Window.partitionBy(*_AT, across).orderBy(along)
        valid = F.col("elev").isNotNull() & ~F.isnan("elev")
        rows = rows.withColumn("__p", F.struct(F.col(along).alias("p"), F.when(valid, F.col("elev")).alias("h")))
        rows = rows.withColumns({f"__{name}{k}": step("__p", k).over(w) for k in range(1, r + 1) for name, step in (("a", F.lag), ("b", F.lead))})
        near = [F.col("__p"), *[F.col(f"__{name}{k}") for k in range(1, r + 1) for name in "ab"]]
        weight = lambda x: F.when(x["h"].isNotNull() & (F.abs(x["p"] - F.col(along)) <= r), F.exp(-F.pow((x["p"] - F.col(along)).cast("double"), F.lit(2)) / (2 * sigma * sigma))).otherwise(0.0)  # noqa: E731, B023
        rows = rows.withColumns({"__w": sum((F.coalesce(weight(x), F.lit(0.0)) for x in near), F.lit(0.0)), "__s": sum((F.coalesce(weight(x) * x["h"], F.lit(0.0)) for x in near), F.lit(0.0))})
        rows = rows.withColumn("elev", F.when(F.col("elev").isNotNull(), F.col("__s") / F.nullif(F.col("__w"), F.lit(0.0))))
        rows = rows.drop("__p", "__w", "__s", *[f"__{name}{k}" for k in range(1, r + 1) for name in "ab"])
    return rows


def smooth_gaussian(dem: DataFrame, sigma: float) -> DataFrame:
    """Smoothed elevations (R4): a separable kernel of radius ceil(3 sigma), by the weight of the pixels that are there. One shuffle, by blocks."""
    return own(_smooth(blocks(dem, math.ceil(3 * sigma)), sigma))


def _slope(rows: DataFrame, lat0: float, pixel: float) -> DataFrame:
    for along, across, name in (("px", "py", "__dx"), ("py", "px", "__dy")):
        w = Window.partitionBy(*_AT, across).orderBy(along)
        here = F.struct(F.col(along), F.col("elev"))
        rows = rows.withColumns({"__a": F.lag(here).over(w), "__b": F.lead(here).over(w)})
        a, b = (F.when(F.abs(F.col(x)[along] - F.col(along)) == 1, F.col(x)).otherwise(here) for x in ("__a", "__b"))
        rows = rows.withColumn(name, (b["elev"] - a["elev"]) / F.nullif((b[along] - a[along]).cast("double"), F.lit(0.0))).drop("__a", "__b")
    lat = F.radians(lat0 - (F.col("py") + 0.5) * pixel)
    sx, sy = pixel * DEGREE_M * F.cos(lat), F.lit(pixel * DEGREE_LAT_M)
    return rows.withColumn("slope_percent", F.hypot(F.coalesce("__dx", F.lit(0.0)) / sx, F.coalesce("__dy", F.lit(0.0)) / sy) * 100).drop("__dx", "__dy")


def slope_percent(dem: DataFrame, lat0: float, pixel: float) -> DataFrame:
    """Slope of each pixel (R5): central differences, one-sided at edges and gaps, in metres at the row's latitude."""
    return own(_slope(blocks(dem, 1), lat0, pixel))


def terrain(dem: DataFrame, sigma: float, lat0: float, pixel: float, thresholds=THRESHOLDS) -> DataFrame:
    """Smoothed elevation, slope and class of each pixel (R4 to R6) in one shuffle."""
    return classify_terrain(own(_slope(_smooth(blocks(dem, math.ceil(3 * sigma) + 1), sigma), lat0, pixel)), thresholds)


def classify_terrain(dem: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Class 0 to 4 of each pixel (R6): how many thresholds its slope exceeds; NaN and null are 0."""
    s = F.coalesce(F.nanvl("slope_percent", F.lit(0.0)), F.lit(0.0))
    return dem.withColumn("terrain", sum(((s > t).cast("int") for t in thresholds), F.lit(0)))


def sample_positions(lines: DataFrame, baseline_m: float, n: int = 7) -> DataFrame:
    """n places along each straight line, both ends moved out evenly to reach the baseline (R1). lines: id, lon0, lat0, lon1, lat1."""
    point = lambda i: F.struct(F.col(f"lon{i}").alias("lon"), F.col(f"lat{i}").alias("lat"))
    out = sample_along(lines.select("id", F.array(point(0), point(1)).alias("coords")), baseline_m, n)
    return out.withColumn("distance_m", F.col("distance_m") - F.col("grow_m")).drop("grow_m")


def sample_along(lines: DataFrame, baseline_m: float, n: int = 7) -> DataFrame:
    """id, i, distance_m, grow_m, lon, lat: n places at even distances along lines of several vertices (R1). Lines shorter than the baseline are drawn out
    at both ends by grow_m, in the direction of their first and last steps; distance_m counts from the drawn-out start. lines: id, coords (array of
    lon, lat). Metres are those at the middle of the line's latitudes. Vertices that are null or repeat the one before are passed over; lines without
    a length have no places. One projection a line, and no shuffle."""
    if n < 2:
        raise ValueError("two places at least")
    c = F.filter("coords", lambda p: p["lon"].isNotNull() & p["lat"].isNotNull() & ~F.isnan(p["lon"]) & ~F.isnan(p["lat"]))
    rows = lines.select("id", c.alias("c")).where(F.size("c") > 1)
    lats = F.transform("c", lambda p: p["lat"])
    rows = rows.withColumn("k", F.cos(F.radians((F.array_min(lats) + F.array_max(lats)) / 2)) * DEGREE_M)
    # steps: where each starts, its direction per metre, its length
    step = lambda p, q: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"), (q["lon"] - p["lon"]).alias("dx"), (q["lat"] - p["lat"]).alias("dy"), F.hypot((q["lon"] - p["lon"]) * F.col("k"), (q["lat"] - p["lat"]) * DEGREE_LAT_M).alias("m"))
    m = F.size("c") - 1
    rows = rows.withColumn("s", F.filter(F.zip_with(F.slice("c", F.lit(1), m), F.slice("c", F.lit(2), m), step), lambda x: x["m"] > 0)).where(F.size("s") > 0)
    rows = rows.withColumn("length_m", F.aggregate("s", F.lit(0.0), lambda a, x: a + x["m"]))
    rows = rows.withColumn("grow_m", F.greatest(F.lit(0.0), (baseline_m - F.col("length_m")) / 2))
    begin = F.aggregate("s", F.array(F.lit(0.0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x["m"])))
    rows = rows.withColumn("begin", F.slice(begin, F.lit(1), F.size("s")))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i")).withColumn("distance_m", (F.col("length_m") + 2 * F.col("grow_m")) * F.col("i") / (n - 1))
    at = F.col("distance_m") - F.col("grow_m")
    j = F.greatest(F.lit(1), F.size(F.filter("begin", lambda b: b <= at)))  # the step that a place lies on; the first and last go on beyond their ends
    rows = rows.withColumns({"x": F.element_at("s", j), "t": (at - F.element_at("begin", j)) / F.element_at("s", j)["m"]})
    return rows.select("id", "i", "distance_m", "grow_m", (F.col("x.lon") + F.col("t") * F.col("x.dx")).alias("lon"), (F.col("x.lat") + F.col("t") * F.col("x.dy")).alias("lat"))


def edge_slope(samples: DataFrame, confidence: int, n: int = 7, most: float = 40.0) -> DataFrame:
    """Slope of each line from sampled elevations (R2): id, slope_percent, slope_confidence; steeper than `most` is rejected."""
    per = samples.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("distance_m", "elev"))).alias("s"))
    per = per.withColumn("slope", robust_slope(F.transform("s", lambda x: x["distance_m"]), F.transform("s", lambda x: x["elev"])))
    valid = F.size(F.filter("s", lambda x: x["elev"].isNotNull() & ~F.isnan(x["elev"])))
    ok = F.abs("slope") <= most
    return per.select("id", F.when(ok, F.bround("slope", 3)).alias("slope_percent"), F.when(ok, F.bround(confidence * valid / F.lit(n))).otherwise(0).cast("int").alias("slope_confidence"))


# --- several sources of elevation ----------------------------------------------------------------------------

#: Confidence in a slope whose direction alone is mapped (a fixed value of the policy of slopes).
QUALITATIVE = 35


@dataclass(frozen=True)
class Provider:
    """A source of elevations: a raster table (px, py, elev) with its north-west corner and pixel in degrees; those of higher priority are asked first."""

    name: str
    dem: DataFrame
    lon0: float
    lat0: float
    pixel: float
    resolution_m: float
    priority: int = 0
    confidence: int = 75
    baseline_m: float = 100.0
    samples: int = 7
    most: float = 40.0


def resolve_slopes(lines: DataFrame, providers: list[Provider]) -> DataFrame:
    """id, slope_percent, slope_source, slope_confidence, slope_resolution_m, slope_samples of each line by the first provider, in falling priority (of equal
    ones, the first given), that has a slope for it (R2): that is, two valid samples at least, and a slope no steeper than its most. Lines that
    none has one for are `missing`. lines: id (each once), coords, and incline, whose words up and down decide the sign and lower the confidence.

    Each provider is asked for those lines only that the ones before left open."""
    rows = lines.select("id", "coords", F.lower(F.trim("incline")).alias("way")) if "incline" in lines.columns else lines.select("id", "coords", F.lit(None).cast("string").alias("way"))
    left, found = rows.where("id is not null"), None
    for p in sorted(providers, key=lambda p: -p.priority):
        places = sample_along(left, p.baseline_m, p.samples)
        sampled = dem_sample(places.select(F.struct("id", "i").alias("od_id"), "distance_m", "lon", "lat"), p.dem, p.lon0, p.lat0, p.pixel)
        slopes = edge_slope(sampled.select("od_id.id", "distance_m", "elev"), p.confidence, p.samples, p.most).where("slope_percent is not null")
        valid = sampled.where("elev is not null and not isnan(elev)").groupBy(F.col("od_id.id").alias("id")).agg(F.count("*").cast("int").alias("slope_samples"))
        got = slopes.join(valid, "id").select("id", "slope_percent", "slope_confidence", "slope_samples", F.lit(p.name).alias("slope_source"), F.lit(float(p.resolution_m)).alias("slope_resolution_m"))
        got = checkpointed(got)
        found = got if found is None else found.unionByName(got)
        left = left.join(got.select("id"), "id", "left_anti")
    out = rows.where("id is not null").select("id", "way")
    if found is None:
        nothing = {"slope_percent": "double", "slope_confidence": "int", "slope_samples": "int", "slope_source": "string", "slope_resolution_m": "double"}
        out = out.withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()})
    else:
        out = out.join(found, "id", "left")
    up, down = F.col("way").isin("up", "uphill"), F.col("way").isin("down", "downhill")
    steep = F.abs("slope_percent")
    known = F.col("slope_source").isNotNull()
    return out.select(
        "id",
        F.when(up, steep).when(down, -steep).otherwise(F.col("slope_percent")).alias("slope_percent"),
        F.coalesce("slope_source", F.lit("missing")).alias("slope_source"),
        F.when(known & (up | down), F.least("slope_confidence", F.lit(QUALITATIVE))).otherwise(F.coalesce("slope_confidence", F.lit(0))).alias("slope_confidence"),
        "slope_resolution_m",
        F.coalesce("slope_samples", F.lit(0)).alias("slope_samples"),
    )


def coverage(resolved: DataFrame) -> DataFrame:
    """slope_source, n, share: how many lines each source answered."""
    total = Window.partitionBy()  # over a row a source
    return resolved.groupBy("slope_source").agg(F.count("*").alias("n")).select("slope_source", "n", (F.col("n") / F.sum("n").over(total)).alias("share"))

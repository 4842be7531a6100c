"""Spatial joins of segments and points by grid cells: equi-joins on cells, then exact distances. A point is a segment of no length.

Sides have lon0, lat0, lon1, lat1. Cells are CELL_M or the radius wide, so a pair meets in few cells; it counts only in the first cell that
both sides cover, which makes rows unique without another shuffle. Crowded cells are split by adaptive skew joins.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pednet.functions.geo import DEGREE_M, EARTH_M, clip, planar_m, tile_x, tile_y

CELL_M = 100.0
#: Beyond any distance on earth.
FAR_M = 1e8
ENDS = ("lon0", "lat0", "lon1", "lat1")


def _cells(df: DataFrame, cell: float, grow: float, prefix: str) -> DataFrame:
    """df with the range of cells of each row's box, grown by so many degrees."""
    k = F.cos(F.radians((F.col("lat0") + F.col("lat1")) / 2))
    x = lambda c: F.floor(c / cell).cast("long")
    return df.withColumns(
        {
            f"{prefix}x0": x(F.least("lon0", "lon1") - grow / k), f"{prefix}x1": x(F.greatest("lon0", "lon1") + grow / k),
            f"{prefix}y0": x(F.least("lat0", "lat1") - grow), f"{prefix}y1": x(F.greatest("lat0", "lat1") + grow),
        }
    )


def _point_segment(px, py, ax, ay, bx, by) -> Column:
    dx, dy = bx - ax, by - ay
    size = dx * dx + dy * dy
    t = F.when(size > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - ax) * dx + (py - ay) * dy) / size))).otherwise(0.0)
    return F.hypot(ax + t * dx - px, ay + t * dy - py)


def segment_distance_m(a: str, b: str) -> Column:
    """Least distance of two segments in metres, in the local plane of the first; 0 where they cross. a, b: prefixes of their ends."""
    m = math.pi / 180 * EARTH_M
    k = F.cos(F.radians(F.col(f"{a}lat0"))) * m
    c = {f"{p}{e}": (F.col(f"{p}{e}") - F.col(f"{a}{e[:3]}0")) * (k if e[:3] == "lon" else m) for p in (a, b) for e in ENDS}
    one, two = [c[f"{a}{e}"] for e in ENDS], [c[f"{b}{e}"] for e in ENDS]
    ends = F.least(_point_segment(*one[:2], *two), _point_segment(*one[2:], *two), _point_segment(*two[:2], *one), _point_segment(*two[2:], *one))
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    p, q, r, s = one[:2], one[2:], two[:2], two[2:]
    cross = (turn(p, q, r) * turn(p, q, s) < 0) & (turn(r, s, p) * turn(r, s, q) < 0)
    return F.when(cross, 0.0).otherwise(ends)


def distance_join(left: DataFrame, right: DataFrame, radius_m: float, how: str = "inner", cell_m: float | None = None) -> DataFrame:
    """Pairs within radius_m (J5), with distance_m. Columns come out as l_ and r_ plus their names; how: inner, left_semi or left_anti,
    the latter two giving rows of left."""
    cell = max(cell_m or CELL_M, radius_m) / DEGREE_M
    one = _cells(left.select(*[F.col(c).alias(c) for c in left.columns]), cell, radius_m / DEGREE_M, "__")
    two = _cells(right, cell, 0.0, "__")
    one = one.select(*[F.col(c).alias(f"l_{c}") for c in one.columns], F.explode(F.sequence("__x0", "__x1")).alias("cx")).select("*", F.explode(F.sequence("l___y0", "l___y1")).alias("cy"))
    two = two.select(*[F.col(c).alias(f"r_{c}") for c in two.columns], F.explode(F.sequence("__x0", "__x1")).alias("cx")).select("*", F.explode(F.sequence("r___y0", "r___y1")).alias("cy"))
    pairs = one.join(two, ["cx", "cy"]).where((F.col("cx") == F.greatest("l___x0", "r___x0")) & (F.col("cy") == F.greatest("l___y0", "r___y0")))
    pairs = pairs.withColumn("distance_m", segment_distance_m("l_", "r_")).where(F.col("distance_m") <= radius_m)
    pairs = pairs.drop("cx", "cy", *[c for c in pairs.columns if "___" in c])
    if how == "inner":
        return pairs
    keys = pairs.select(F.col("l_element").alias("element"), F.col("l_id").alias("id")).distinct()
    return left.join(keys, ["element", "id"], how)


def connected_to(df: DataFrame, reference: DataFrame, radius_m: float = 50.0) -> tuple[DataFrame, DataFrame]:
    """Rows within radius_m of the reference, and the others."""
    return distance_join(df, reference, radius_m, "left_semi"), distance_join(df, reference, radius_m, "left_anti")


def kerbs_without_crossing(kerbs: DataFrame, crossings: DataFrame, radius_m: float = 0.5) -> DataFrame:
    """Kerbs that touch no crossing."""
    return distance_join(kerbs, crossings, radius_m, "left_anti")


def crossings_lacking_kerbs(crossings: DataFrame, kerbs: DataFrame, radius_m: float = 0.2, least: int = 2) -> DataFrame:
    """Crossings with fewer kerbs than that, with n_kerbs."""
    n = distance_join(crossings, kerbs, radius_m).groupBy(F.col("l_element").alias("element"), F.col("l_id").alias("id")).agg(F.count("*").alias("n_kerbs"))
    return crossings.join(n, ["element", "id"], "left").withColumn("n_kerbs", F.coalesce("n_kerbs", F.lit(0))).where(F.col("n_kerbs") < least)


def nearest_within(left: DataFrame, right: DataFrame, radius_m: float = 2.0) -> DataFrame:
    """For each left row its nearest right row (J7), ties to the smaller id."""
    pairs = distance_join(left, right, radius_m)
    return pairs.groupBy("l_element", "l_id").agg(F.min_by(F.struct(*[c for c in pairs.columns if c.startswith("r_")], "distance_m"), F.struct("distance_m", "r_id")).alias("n")).select("l_element", "l_id", "n.*")


def crossing_context(crossings: DataFrame, kerbs: DataFrame, sidewalks: DataFrame, radius_m: float = 2.0) -> DataFrame:
    """Crossings with the kerbs, tactile paving and transition states within radius_m, by kerb id.
    kerbs: kerb, tactile_paving and, if there, kerb_surface; sidewalks: surface."""
    surface = nearest_within(kerbs, sidewalks.select("element", "id", "surface", *ENDS), radius_m).select(F.col("l_element").alias("element"), F.col("l_id").alias("id"), F.col("r_surface").alias("sidewalk_surface"))
    own = kerbs if "kerb_surface" in kerbs.columns else kerbs.withColumn("kerb_surface", F.lit(None).cast("string"))
    near = distance_join(crossings.select("element", "id", *ENDS), own.join(surface, ["element", "id"], "left").select("element", "id", "kerb", "tactile_paving", "kerb_surface", "sidewalk_surface", *ENDS), radius_m)
    state = F.struct(F.col("r_id").alias("k"), F.col("r_kerb").alias("kerb"), F.col("r_tactile_paving").alias("tactile_paving"), F.col("r_kerb_surface").alias("kerb_surface"), F.col("r_sidewalk_surface").alias("sidewalk_surface"))
    per = near.groupBy(F.col("l_element").alias("element"), F.col("l_id").alias("id")).agg(F.array_sort(F.collect_list(state)).alias("s"))
    known = lambda c: F.filter(F.transform("s", lambda x: x[c]), lambda v: v.isNotNull() & (v != "?"))
    per = per.select("element", "id", known("kerb").alias("associated_kerbs"), known("tactile_paving").alias("associated_tactile_paving"), F.transform("s", lambda x: x.dropFields("k")).alias("associated_transition_states"))
    return crossings.join(per, ["element", "id"], "left")


def features_x_tiles(lines: DataFrame, zoom: int) -> DataFrame:
    """Segments by the tiles they meet (J8), clipped: x, y and clon0 ... clat1."""
    rows = lines.withColumns({"__x0": tile_x(F.least("lon0", "lon1"), zoom), "__x1": tile_x(F.greatest("lon0", "lon1"), zoom), "__y0": tile_y(F.greatest("lat0", "lat1"), zoom), "__y1": tile_y(F.least("lat0", "lat1"), zoom)})
    rows = rows.select("*", F.explode(F.sequence("__x0", "__x1")).alias("x")).select("*", F.explode(F.sequence("__y0", "__y1")).alias("y")).drop("__x0", "__x1", "__y0", "__y1")
    n = float(1 << zoom)
    lat = lambda y: F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * y / n))))
    c = clip("lon0", "lat0", "lon1", "lat1", F.col("x") / n * 360 - 180, lat(F.col("y") + 1), (F.col("x") + 1) / n * 360 - 180, lat(F.col("y")))
    return rows.withColumn("__c", c).where("__c is not null").select("*", F.col("__c.lon1").alias("clon0"), F.col("__c.lat1").alias("clat0"), F.col("__c.lon2").alias("clon1"), F.col("__c.lat2").alias("clat1")).drop("__c")


def tile_lengths(lines: DataFrame, zoom: int, zone: int) -> DataFrame:
    """Metres of line in each tile (A14); tiles without any don't appear."""
    return features_x_tiles(lines, zoom).groupBy("x", "y").agg(F.sum(planar_m("clon0", "clat0", "clon1", "clat1", zone)).alias("length_m"))


def snap(points: DataFrame, segments: DataFrame, first_m: float = 100.0) -> DataFrame:
    """Each point's nearest segment (J15): od_id, segment_id, t, lon, lat, distance_m. Rings double until every point has one, however far
    it is; each ring is cut from the plan of those before. Without segments there are no rows. points: od_id, lon, lat."""
    from pednet.functions.geo import project_on_segment
    from pednet.operators.shared import checkpointed

    left = points.select(F.lit("point").alias("element"), F.col("od_id").alias("id"), *[F.col(c).cast("double").alias(f"{c}{i}") for i in (0, 1) for c in ("lon", "lat")]).where("not isnan(lon0) and not isnan(lat0)")
    right = segments.select(F.lit("segment").alias("element"), F.col("segment_id").alias("id"), *ENDS)
    right = right.where(" and ".join(f"{c} is not null" for c in ENDS))
    p = project_on_segment("lon", "lat", "r_lon0", "r_lat0", "r_lon1", "r_lat1")
    out, ring, some = None, first_m, not right.isEmpty()
    while some and ring < FAR_M and not left.isEmpty():
        found = checkpointed(nearest_within(left, right, ring))
        left = checkpointed(left.join(found.select(F.col("l_id").alias("id")), "id", "left_anti"))
        out = found if out is None else out.unionByName(found)
        ring *= 2
    out = nearest_within(left, right, ring) if out is None else out
    at = out.join(points.select(F.col("od_id").alias("l_id"), "lon", "lat"), "l_id")
    return at.select(F.col("l_id").alias("od_id"), F.col("r_id").alias("segment_id"), p.alias("p")).select("od_id", "segment_id", "p.*")


def dem_sample(points: DataFrame, dem: DataFrame, lon0: float, lat0: float, pixel: float) -> DataFrame:
    """The elevation of each point's pixel (J12): px east of lon0, py south of lat0; outside: null."""
    at = points.withColumns({"px": F.floor((F.col("lon") - lon0) / pixel).cast("long"), "py": F.floor((lat0 - F.col("lat")) / pixel).cast("long")})
    return at.join(dem.select("px", "py", "elev"), ["px", "py"], "left")


def zoom_rollup(df: DataFrame, from_z: int, to_z: int, value: str = "length_m") -> DataFrame:
    """Sums of every zoom from from_z down to to_z (A15), by one explode and one aggregation."""
    rows = df.select(F.explode(F.sequence(F.lit(to_z), F.lit(from_z))).alias("z"), "x", "y", value)
    d = F.pow(F.lit(2.0), F.lit(from_z) - F.col("z"))
    return rows.groupBy("z", F.floor(F.col("x") / d).cast("long").alias("x"), F.floor(F.col("y") / d).cast("long").alias("y")).agg(F.sum(value).alias(value))


def disaggregate(totals: DataFrame, weights: DataFrame, up: int = 2) -> DataFrame:
    """A total of each parent tile shared over its children by weight; evenly if all weights are zero (T2). totals: x, y, total;
    weights: x, y, weight, `up` zooms below."""
    w = weights.withColumns({"px": F.shiftright("x", up), "py": F.shiftright("y", up)})
    all_ = Window.partitionBy("px", "py")
    w = w.withColumns({"s": F.sum("weight").over(all_), "n": F.count("*").over(all_)})
    t = totals.select(F.col("x").alias("px"), F.col("y").alias("py"), "total")
    return w.join(t, ["px", "py"]).select("x", "y", F.when(F.col("s") > 0, F.col("total") * F.col("weight") / F.col("s")).otherwise(F.col("total") / F.col("n")).alias("value"))

"""Registered queries over areas: diamonds around places of the adapter views, with holes and a second part, against points, tiles, pixels and one another."""

from __future__ import annotations

from pyspark.sql import functions as F

from pednet.functions import geo
from pednet.operators import polygons as G
from pednet.plans.catalogue import query
from pednet.plans.network_views import view

#: Half the width of an area, of its hole, and of its second part, which stands STEP to the east.
OUTER, HOLE, PART, STEP = 0.00413, 0.00207, 0.00111, 0.00617


def _diamond(x, y, size):
    point = lambda dx, dy: F.struct((x + dx * size).alias("lon"), (y + dy * size).alias("lat"))
    return F.array(point(1, 0), point(0, 1), point(-1, 0), point(0, -1))


def areas(spark, d, suffix: str = "a", scale: float = 1.0):
    """An area for each place of net_od: a diamond with a hole, and a smaller one beside it."""
    x, y = F.col(f"lon_{suffix}").cast("double"), F.col(f"lat_{suffix}").cast("double")
    rings = F.array(_diamond(x, y, OUTER * scale), _diamond(x, y, HOLE * scale), _diamond(x + STEP, y, PART * scale))
    return view(spark, d, "net_od").select(F.col("od_id").alias("area_id"), F.posexplode(rings).alias("ring", "coords"))


def _inside(x: str, y: str, a: str = "a") -> str:
    """SQL: whether a place lies in the area around lon_<a>, lat_<a>."""
    d = f"abs({x} - lon_{a}::DOUBLE{{0}}) + abs({y} - lat_{a}::DOUBLE)"
    return f"(({d.format('')} < {OUTER} AND {d.format('')} > {HOLE}) OR {d.format(f' - {STEP}')} < {PART})"


@query("kerbs_in_areas", f"SELECT od_id AS area_id, count(*) AS n, sum(k.id)::BIGINT AS ids FROM net_kerbs k JOIN net_od o ON {_inside('k.lon::DOUBLE', 'k.lat::DOUBLE')} GROUP BY od_id")
def kerbs_in_areas(spark, d):
    kerbs = view(spark, d, "net_kerbs").select("id", F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"))
    shapes, members = G.by_shape(areas(spark, d))
    held = G.points_in_areas(kerbs, G.cover(shapes), ["id"]).groupBy(F.col("area_id").alias("shape_id")).agg(F.count("*").alias("n"), F.sum("id").alias("ids"))
    return members.join(held, "shape_id").select("area_id", "n", "ids")


@query("pixels_in_areas", f"SELECT od_id AS area_id, count(*) AS n, round(avg(elev::DOUBLE), 6) AS elev FROM net_dem e JOIN net_od o ON {_inside('(-49.3 + (e.px + 0.5) * 0.0003)', '(-25.46 - (e.py + 0.5) * 0.0003)')} GROUP BY od_id")
def pixels_in_areas(spark, d):
    dem = view(spark, d, "net_dem").withColumn("elev", F.col("elev").cast("double"))
    shapes, members = G.by_shape(areas(spark, d))
    held = G.mask_to_areas(dem, shapes, -49.3, -25.46, 0.0003).groupBy(F.col("area_id").alias("shape_id")).agg(F.count("*").alias("n"), F.round(F.avg("elev"), 6).alias("elev"))
    return members.join(held, "shape_id").select("area_id", "n", "elev")


_ZOOM = 17
_N = 1 << _ZOOM


def _box_sql(x: str, y: str, size: float, least: bool) -> str:
    """SQL: the least or greatest distance, by x and y together, of a tile's box from a place."""
    part = lambda at, lo, hi: f"greatest({lo} - {at}, {at} - {hi}, 0)" if least else f"greatest(abs({lo} - {at}), abs({hi} - {at}))"
    return f"{part(x, 'w', 'e')} + {part(y, 's', 'n')}"


_TILES = f"""SELECT od_id, lon_a::DOUBLE AS x0, lat_a::DOUBLE AS y0, tx, ty, tx * 360.0 / {_N} - 180 AS w, (tx + 1) * 360.0 / {_N} - 180 AS e,
       degrees(atan(sinh(pi() * (1 - 2 * (ty + 1) / {_N}.0)))) AS s, degrees(atan(sinh(pi() * (1 - 2 * ty / {_N}.0)))) AS n FROM (
       SELECT *, unnest(range(floor((lon_a::DOUBLE - {OUTER} + 180) / 360 * {_N})::BIGINT, floor((lon_a::DOUBLE + {STEP} + {PART} + 180) / 360 * {_N})::BIGINT + 1)) AS tx FROM net_od) a,
       (SELECT unnest(range(floor((1 - asinh(tan(radians(-25.45))) / pi()) / 2 * {_N})::BIGINT, floor((1 - asinh(tan(radians(-25.48))) / pi()) / 2 * {_N})::BIGINT + 1)) AS ty) b"""


@query("tiles_of_areas", f"""SELECT od_id AS area_id, count(*) AS tiles, sum(tx)::BIGINT AS xs, sum(ty)::BIGINT AS ys FROM ({_TILES}) t
       WHERE ({_box_sql('x0', 'y0', OUTER, True)} <= {OUTER} AND {_box_sql('x0', 'y0', HOLE, False)} >= {HOLE}) OR {_box_sql(f'(x0 + {STEP})', 'y0', PART, True)} <= {PART} GROUP BY od_id""")
def tiles_of_areas(spark, d):
    shapes, members = G.by_shape(areas(spark, d))
    tiles = G.tiles_x_areas(shapes, _ZOOM).groupBy(F.col("area_id").alias("shape_id")).agg(F.count("*").alias("tiles"), F.sum("x").alias("xs"), F.sum("y").alias("ys"))
    return members.join(tiles, "shape_id").select("area_id", "tiles", "xs", "ys")


def _shared(r1: float, r2: float, dx: float = 0.0) -> str:
    """SQL: what two diamonds share, the second's centre moved by dx: squares by x + y and x - y."""
    side = [f"greatest(0, least(u + {r1}, v + {r2 + dx}) - greatest(u - {r1}, v + {dx - r2}))", f"greatest(0, least(p + {r1}, q + {r2 + dx}) - greatest(p - {r1}, q + {dx - r2}))"]
    return f"{side[0]} * {side[1]} / 2"


_PARTS = ((OUTER, 0.0, 1), (HOLE, 0.0, -1), (PART, STEP, 1))
_OVERLAP = " + ".join(f"{s1 * s2} * ({_shared(r1, r2 * 0.9, m2 - m1)})" for r1, m1, s1 in _PARTS for r2, m2, s2 in _PARTS)


@query("overlaps_of_areas", f"""SELECT count(*) FILTER (WHERE round(1e9 * o) > 0) AS pairs, round(1e6 * sum(o), 4) AS area FROM (SELECT {_OVERLAP} AS o FROM (
       SELECT a.lon_a::DOUBLE + a.lat_a::DOUBLE AS u, a.lon_a::DOUBLE - a.lat_a::DOUBLE AS p, b.lon_b::DOUBLE + b.lat_b::DOUBLE AS v, b.lon_b::DOUBLE - b.lat_b::DOUBLE AS q FROM net_od a, net_od b) t) w WHERE o > 1e-13""")
def overlaps_of_areas(spark, d):
    """What the areas around the origins share with somewhat smaller ones around the destinations, in millionths of square degrees. Areas of the same shape are
    compared once and count as often as they occur."""
    (a, of_a), (b, of_b) = G.by_shape(areas(spark, d)), G.by_shape(areas(spark, d, "b", 0.9))
    o = G.overlaps(a, b).where("overlap > 1e-13")
    times = lambda members, name: members.groupBy(F.col("shape_id").alias(name)).agg(F.count("*").alias(f"n_{name}"))
    o = o.join(times(of_a, "area_id"), "area_id").join(times(of_b, "other_id"), "other_id").withColumn("n", F.col("n_area_id") * F.col("n_other_id"))
    return o.agg(F.sum(F.when(F.round(1e9 * F.col("overlap")) > 0, F.col("n")).otherwise(0)).alias("pairs"), F.round(1e6 * F.sum(F.col("overlap") * F.col("n")), 4).alias("area"))


@query("local_projects", f"""SELECT o.od_id AS project_id FROM net_od o, (SELECT lon_a AS x, lat_a AS y FROM net_od ORDER BY od_id LIMIT 1) c
       WHERE o.od_id % 7 = 3 OR (abs(lon_b - x) + abs(lat_b - y) <= 0.012 + 0.001 * (1 + o.od_id % 12) AND power(0.001 * (1 + o.od_id % 12), 2) <= 0.7 * power(0.012, 2))""")
def local_projects(spark, d):
    """Projects of several sizes around the destinations, some without a shape, that are local to the area of the first origin; those that
    only touch it too, so the SQL compares decimals."""
    od = view(spark, d, "net_od")
    first = od.orderBy("od_id").limit(1)
    boundary = first.select(F.lit(0).cast("long").alias("area_id"), F.lit(0).alias("ring"), _diamond(F.col("lon_a").cast("double"), F.col("lat_a").cast("double"), 0.012).alias("coords"))
    shapes = od.where("od_id % 7 <> 3").select(F.col("od_id").alias("area_id"), F.lit(0).alias("ring"), _diamond(F.col("lon_b").cast("double"), F.col("lat_b").cast("double"), 0.001 * (1 + F.col("od_id") % 12)).alias("coords"))
    return G.local_projects_by_area(od.select(F.col("od_id").alias("project_id")), shapes, boundary, 0.7)

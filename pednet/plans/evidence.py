"""Registered queries of operators that others don't show: kerbs at real distances, slopes of two sources, diffs by layer, projects, histories of tiles."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from pednet.functions import geo
from pednet.operators import completeness as K
from pednet.operators import features as E
from pednet.operators import network as N
from pednet.operators import spatial as S
from pednet.operators import terrain as R
from pednet.operators import themes as T
from pednet.plans.catalogue import _crossings, _kerbs, _lines, query
from pednet.plans.network_views import view, ways

# --- kerbs 0 to 6 metres from the ends of crossings ---------------------------------------------------------

#: Degrees that a kerb is moved by, times the remainder of its number.
EAST, NORTH = (1.3e-6, 40), (0.7e-6, 11)


def shifted_kerbs(spark, d):
    k = _kerbs(spark, d)
    east, north = F.col("id") % EAST[1] * EAST[0], F.col("id") % NORTH[1] * NORTH[0]
    return k.withColumns({f"lon{i}": F.col(f"lon{i}") + east for i in (0, 1)} | {f"lat{i}": F.col(f"lat{i}") + north for i in (0, 1)})


_M = math.pi / 180 * geo.EARTH_M
_NEAR = f"""SELECT kerb, id, sqrt(power(ax + t * dx, 2) + power(ay + t * dy, 2)) AS m FROM (
  SELECT *, CASE WHEN dx * dx + dy * dy > 0 THEN least(1.0, greatest(0.0, -(ax * dx + ay * dy) / (dx * dx + dy * dy))) ELSE 0.0 END AS t FROM (
  SELECT kerb, id, (lon0 - lon) * cos(radians({{at}})) * {_M} AS ax, (lat0 - lat) * {_M} AS ay, (lon1 - lon0) * cos(radians({{at}})) * {_M} AS dx, (lat1 - lat0) * {_M} AS dy FROM
  (SELECT id AS kerb, lon::DOUBLE + (id % {EAST[1]}) * {EAST[0]}::DOUBLE AS lon, lat::DOUBLE + (id % {NORTH[1]}) * {NORTH[0]}::DOUBLE AS lat FROM net_kerbs) k JOIN
  (SELECT id, lon0::DOUBLE AS lon0, lat0::DOUBLE AS lat0, lon1::DOUBLE AS lon1, lat1::DOUBLE AS lat1 FROM net_ways WHERE footway = 'crossing') c
  ON lon BETWEEN least(lon0, lon1) - 1e-4 AND greatest(lon0, lon1) + 1e-4 AND lat BETWEEN least(lat0, lat1) - 1e-4 AND greatest(lat0, lat1) + 1e-4) a) b"""


@query("shifted_kerb_pairs", f"SELECT kerb AS kerb_id, id AS crossing_id, round(m, 4) AS distance_m FROM ({_NEAR.format(at='lat')}) n WHERE m <= 2.5")
def shifted_kerb_pairs(spark, d):
    return S.distance_join(shifted_kerbs(spark, d), _crossings(spark, d), 2.5).select(F.col("l_id").alias("kerb_id"), F.col("r_id").alias("crossing_id"), F.round("distance_m", 4).alias("distance_m"))


@query("shifted_nearest_crossing", f"SELECT kerb AS kerb_id, round(min(m), 4) AS distance_m FROM ({_NEAR.format(at='lat')}) n WHERE m <= 4 GROUP BY kerb")
def shifted_nearest_crossing(spark, d):
    """How far the nearest crossing is; which it is, `nearest_crossing` compares, as here crossings that end at one place are apart by rounding only."""
    n = S.nearest_within(shifted_kerbs(spark, d), _crossings(spark, d), 4.0)
    return n.select(F.col("l_id").alias("kerb_id"), F.round("distance_m", 4).alias("distance_m"))


@query("shifted_kerbs_without_crossing", f"SELECT id FROM net_kerbs WHERE id NOT IN (SELECT kerb FROM ({_NEAR.format(at='lat')}) n WHERE m <= 1.5)")
def shifted_kerbs_without_crossing(spark, d):
    return S.kerbs_without_crossing(shifted_kerbs(spark, d), _crossings(spark, d), 1.5).select("id")


@query("shifted_crossings_lacking_kerbs", f"SELECT w.id, coalesce(n, 0) AS n_kerbs FROM net_ways w LEFT JOIN (SELECT id, count(*) AS n FROM ({_NEAR.format(at='lat0')}) n WHERE m <= 2 GROUP BY id) k ON k.id = w.id WHERE footway = 'crossing' AND coalesce(n, 0) < 2")
def shifted_crossings_lacking_kerbs(spark, d):
    return S.crossings_lacking_kerbs(_crossings(spark, d), shifted_kerbs(spark, d), 2.0).select("id", "n_kerbs")


@query("shifted_connected_kerbs", f"SELECT kerb AS id, bool_or(m <= 3) AS connected FROM (SELECT id AS kerb, 1e9 AS m FROM net_kerbs UNION ALL SELECT kerb, m FROM ({_NEAR.format(at='lat')}) n) u GROUP BY kerb")
def shifted_connected_kerbs(spark, d):
    near, far = S.connected_to(shifted_kerbs(spark, d), _crossings(spark, d), 3.0)
    return near.select("id", F.lit(True).alias("connected")).unionByName(far.select("id", F.lit(False).alias("connected")))


# --- slopes of two sources ----------------------------------------------------------------------------------

_FINE = "SELECT px, py, elev::DOUBLE AS elev FROM net_dem WHERE px < 25"
_COARSE = "SELECT px // 3 AS px, py // 3 AS py, avg(elev::DOUBLE) AS elev FROM net_dem GROUP BY 1, 2"


def _source_sql(name: str, table: str, pixel: float, baseline: float, confidence: int, most: float) -> str:
    """CTEs of one source: <name>(id, slope, valid) of the lines that it has a slope for."""
    return f"""{name}_s AS (SELECT id, i, (len + 2 * grow) * i / 6 AS d, lon0 + ((len + 2 * grow) * i / 6 - grow) / len * (lon1 - lon0) AS lon, lat0 + ((len + 2 * grow) * i / 6 - grow) / len * (lat1 - lat0) AS lat
  FROM (SELECT *, greatest(0, ({baseline} - len) / 2)::DOUBLE AS grow, unnest(range(7))::DOUBLE AS i FROM l) x),
{name}_e AS (SELECT s.id, s.i, s.d, e.elev FROM {name}_s s JOIN ({table}) e ON e.px = floor((s.lon + 49.30007) / {pixel})::BIGINT AND e.py = floor((-25.46007 - s.lat) / {pixel})::BIGINT),
{name} AS (SELECT p.id, slope, valid, {confidence} AS confidence FROM (SELECT a.id, median((b.elev - a.elev) / (b.d - a.d) * 100) AS slope FROM {name}_e a JOIN {name}_e b ON a.id = b.id AND b.i > a.i GROUP BY a.id) p
  JOIN (SELECT id, count(*) AS valid FROM {name}_e GROUP BY id) n ON n.id = p.id WHERE abs(slope) <= {most})"""


_LENGTHS = """l AS (SELECT *, sqrt(power((lon1 - lon0) * 111320.0::DOUBLE * cos(radians((lat0 + lat1) / 2)), 2) + power((lat1 - lat0) * 110574.0::DOUBLE, 2)) AS len FROM
  (SELECT id, incline, lon0::DOUBLE AS lon0, lat0::DOUBLE AS lat0, lon1::DOUBLE AS lon1, lat1::DOUBLE AS lat1 FROM net_ways) w)"""


@query("provider_slopes", f"""WITH {_LENGTHS}, {_source_sql('fine', _FINE, 0.0003, 60.0, 75, 25.0)}, {_source_sql('coarse', _COARSE, 0.0009, 200.0, 45, 40.0)},
  r AS (SELECT l.id, l.incline, CASE WHEN f.id IS NOT NULL THEN 'fine' WHEN c.id IS NOT NULL THEN 'coarse' ELSE 'missing' END AS slope_source, round_even(coalesce(f.slope, c.slope), 3) AS slope,
    coalesce(f.valid, c.valid, 0)::INT AS slope_samples, coalesce(round_even(f.confidence * f.valid / 7.0, 0), round_even(c.confidence * c.valid / 7.0, 0), 0)::INT AS confidence
    FROM l LEFT JOIN fine f ON f.id = l.id LEFT JOIN coarse c ON c.id = l.id)
  SELECT id, slope_source, slope_samples, CASE incline WHEN 'up' THEN abs(slope) WHEN 'down' THEN -abs(slope) ELSE slope END AS slope_percent,
    CASE WHEN incline IN ('up', 'down') THEN least(confidence, 35) ELSE confidence END AS slope_confidence FROM r""")
def provider_slopes(spark, d):
    """Slopes of the ways: fine pixels in the west first, where these give none or an implausible one coarse pixels."""
    dem = view(spark, d, "net_dem").withColumn("elev", F.col("elev").cast("double"))
    coarse = dem.groupBy(F.floor(F.col("px") / 3).alias("px"), F.floor(F.col("py") / 3).alias("py")).agg(F.avg("elev").alias("elev"))
    at = (-49.30007, -25.46007)
    providers = [R.Provider("coarse", coarse, *at, 0.0009, 90, priority=1, confidence=45, baseline_m=200.0), R.Provider("fine", dem.where("px < 25"), *at, 0.0003, 30, priority=2, confidence=75, baseline_m=60.0, most=25.0)]
    return R.resolve_slopes(ways(spark, d).select("id", "coords", "incline"), providers).select("id", "slope_source", "slope_samples", "slope_percent", "slope_confidence")


# --- diffs, projects, tiles, segments -----------------------------------------------------------------------

@query("element_classes", """SELECT layer, count(*) AS n FROM (SELECT CASE WHEN element = 'way' AND footway = 'sidewalk' THEN 'sidewalks' WHEN element = 'way' AND footway = 'crossing' THEN 'crossings' WHEN element = 'node' AND barrier = 'kerb' THEN 'kerbs'
       WHEN element = 'way' AND highway IN ('footway', 'steps', 'path') THEN 'other_footways' END AS layer FROM (
       SELECT CASE WHEN id % 9 = 0 THEN 'relation' ELSE element END AS element, footway, NULL AS barrier, CASE WHEN id % 7 = 0 THEN 'primary' ELSE highway END AS highway FROM net_ways UNION ALL SELECT element, NULL, barrier, NULL FROM net_kerbs) a) b GROUP BY layer""")
def element_classes(spark, d):
    """The layers of elements of all types, roads and relations among them."""
    none = F.lit(None).cast("string")
    w = view(spark, d, "net_ways").select(F.when(F.col("id") % 9 == 0, "relation").otherwise(F.col("element")).alias("element"), "footway", none.alias("kerb"), none.alias("barrier"), F.when(F.col("id") % 7 == 0, "primary").otherwise(F.col("highway")).alias("highway"), none.alias("foot"))
    k = view(spark, d, "net_kerbs").select("element", none.alias("footway"), "kerb", "barrier", none.alias("highway"), none.alias("foot"))
    return w.unionByName(k).groupBy(E.classify_element().alias("layer")).agg(F.count("*").alias("n"))


@query("merged_projects", """SELECT service, instance, id, string_agg(DISTINCT w, ',' ORDER BY w) AS keywords, arg_min(title, p) AS title FROM (
       SELECT o_orderpriority AS service, o_orderstatus AS instance, o_custkey % 50 AS id, o_orderkey AS p, 2 * o_orderkey AS title, unnest([o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN 'kerb' ELSE 'sidewalk' END]) AS w FROM orders) t GROUP BY 1, 2, 3""")
def merged_projects(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    words = F.array("o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "kerb").otherwise("sidewalk"))
    rows = o.select(F.col("o_orderpriority").alias("service"), F.col("o_orderstatus").alias("instance"), (F.col("o_custkey") % 50).alias("id"), F.col("o_orderkey").alias("position"), (2 * F.col("o_orderkey")).alias("title"), words.alias("matched_keywords"))
    return E.merge_projects(rows).select("service", "instance", "id", F.array_join("matched_keywords", ",").alias("keywords"), "title")


@query("tile_histories", """SELECT z, x, y, string_agg(day || ':' || n, ',' ORDER BY day) AS entries FROM (SELECT 16 AS z, id % 40 AS x, id % 3 AS y, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM net_changes GROUP BY 1, 2, 3, 4) t GROUP BY 1, 2, 3""")
def tile_histories(spark, d):
    """What each tile had on each day, in the order of days."""
    t = _tile_days(spark, d)
    out = K.tile_history(t.select("z", "x", "y", F.col("day").alias("timestamp"), F.col("n").alias("footway_ratio"), F.lit(0.0).alias("sidewalk_ratio")))
    return out.select("z", "x", "y", F.array_join(F.transform("entries", lambda e: F.concat_ws(":", e["timestamp"], e["footway_ratio"].cast("string"))), ",").alias("entries"))


def _tile_days(spark, d):
    c = view(spark, d, "net_changes")
    return c.groupBy(F.lit(16).alias("z"), (F.col("id") % 40).alias("x"), (F.col("id") % 3).alias("y"), F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query("tiles_by_layer", "SELECT z, x, y, count(*) FILTER (WHERE layer = 'sidewalks') AS sidewalks, count(*) FILTER (WHERE layer = 'kerbs') AS kerbs FROM (SELECT 16 AS z, id % 40 AS x, id % 3 AS y, layer FROM net_changes) t GROUP BY 1, 2, 3")
def tiles_by_layer(spark, d):
    """One row a tile, one column a layer."""
    c = view(spark, d, "net_changes").groupBy(F.lit(16).alias("z"), (F.col("id") % 40).alias("x"), (F.col("id") % 3).alias("y"), F.col("layer").alias("timestamp")).agg(F.count("*").alias("footway_ratio"))
    return K.tile_feature_table(c, ["sidewalks", "kerbs"]).select("z", "x", "y", F.coalesce("sidewalks", F.lit(0)).alias("sidewalks"), F.coalesce("kerbs", F.lit(0)).alias("kerbs"))


@query("latest_changes", "SELECT CAST(max(ts) AS VARCHAR) AS latest FROM net_changes")
def latest_changes(spark, d):
    return T.latest_registry(view(spark, d, "net_changes")).select(F.regexp_replace(F.date_format("latest", "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0+$", "").alias("latest"))


@query("undirected_segments", """SELECT count(*) AS segments FROM (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM (SELECT round((lon0 + 49.30) / 0.0005)::BIGINT * 1000000 + round((lat0 + 25.47) / 0.0005)::BIGINT AS a,
       round((lon1 + 49.30) / 0.0005)::BIGINT * 1000000 + round((lat1 + 25.47) / 0.0005)::BIGINT AS b FROM net_ways) t) u""")
def undirected_segments(spark, d):
    from pednet.policies.profiles import DISTANCE

    lines = _lines(spark, d)
    return N.undirected(N.build_edges(lines, N.build_vertices(lines), (DISTANCE,))).agg(F.count("*").alias("segments"))

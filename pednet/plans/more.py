"""More registered queries: scalar functions, lookups, tiles, rules and views over the adapter views and the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pednet.functions import geo, normalize
from pednet.operators import areas as X
from pednet.operators import changes as C
from pednet.operators import completeness as K
from pednet.operators import features as E
from pednet.operators import grading as G
from pednet.operators import hazards as H
from pednet.operators import network as N
from pednet.operators import quality as Q
from pednet.operators import spatial as S
from pednet.operators import summaries as A
from pednet.operators import terrain as R
from pednet.operators import themes as T
from pednet.plans.catalogue import _crossings, _ends, _kerbs, _KERB_SQL, _ENDS_SQL, _lines, _tagged, query
from pednet.plans.network_views import LAYER, view, ways
from pednet.policies.hazards import CATEGORIES, RULES, TRAVERSABILITY
from pednet.policies.profiles import PROFILES
from pednet.sources import layers as L

_UNKNOWN = "('', '?', 'unknown', 'unset', 'none', 'null', 'nan')"


@query("unknown_values", f"SELECT id, surface IS NULL OR lower(trim(surface)) IN {_UNKNOWN} AS is_unknown, lower(trim(surface)) AS normal FROM net_ways")
def unknown_values(spark, d):
    return view(spark, d, "net_ways").select("id", normalize.is_unknown("surface").alias("is_unknown"), normalize.normalize_categorical("surface").alias("normal"))


@query("sequence_normal", f"SELECT id, coalesce(array_to_string(list_filter(list_transform([surface, smoothness, crossing], lambda x: lower(trim(x))), lambda x: x IS NOT NULL AND x NOT IN {_UNKNOWN}), ','), '') AS items FROM net_ways")
def sequence_normal(spark, d):
    return view(spark, d, "net_ways").select("id", F.array_join(normalize.normalize_sequence(F.array("surface", "smoothness", "crossing")), ",").alias("items"))


@query("first_numbers", "SELECT id, CASE incline WHEN '5%' THEN 5 WHEN '-10%' THEN -10 WHEN '5°' THEN 5 WHEN '0%' THEN 0 WHEN '12.6%' THEN 12.6 END::DOUBLE AS n, CASE width WHEN '1.5' THEN 1.5 WHEN '1,25 m' THEN 1.25 WHEN '4''6\"' THEN 4 WHEN '1.5;0.9' THEN 1.5 WHEN '90 cm' THEN 90 WHEN '6 ft' THEN 6 END::DOUBLE AS m FROM net_ways")
def first_numbers(spark, d):
    return view(spark, d, "net_ways").select("id", normalize.parse_number("incline").alias("n"), normalize.parse_number("width").alias("m"))


@query("filled_unknown", "SELECT coalesce(surface, '?') AS surface, coalesce(smoothness, '?') AS smoothness, count(*) AS n FROM net_ways GROUP BY 1, 2")
def filled_unknown(spark, d):
    return normalize.fill_unknown(view(spark, d, "net_ways").select("id", "surface", "smoothness")).groupBy("surface", "smoothness").agg(F.count("*").alias("n"))


@query("replaced_values", "SELECT id, CASE surface WHEN 'betão' THEN 'concrete' WHEN ' Asphalt ' THEN 'asphalt' ELSE surface END AS surface FROM net_ways")
def replaced_values(spark, d):
    return view(spark, d, "net_ways").select("id", normalize.replace_values("surface", {"betão": "concrete", " Asphalt ": "asphalt"}).alias("surface"))


@query("feature_links", """SELECT id, 'https://www.openstreetmap.org/way/' || id AS url, 'https://www.openstreetmap.org/way/' || id || '/history' AS history, 'node' AS inverted, 'way' AS mapped_as,
       'https://www.openstreetmap.org/edit?way=' || id || '#map=18/1.5/2.5' AS edit, id AS split_id FROM net_ways""")
def feature_links(spark, d):
    w = view(spark, d, "net_ways")
    return w.select("id", normalize.feature_url("element", "id").alias("url"), normalize.history_url("element", "id").alias("history"), normalize.invert_element("element").alias("inverted"), normalize.geometry_to_element(F.lit("LineString")).alias("mapped_as"), normalize.edit_url("element", "id", 18, F.lit(1.5), F.lit(2.5)).alias("edit"), normalize.split_type_id(F.concat_ws("_", "element", "id"))["id"].alias("split_id"))


@query("edge_kinds", "SELECT CASE WHEN footway = 'crossing' THEN 'crossing' WHEN footway = 'sidewalk' THEN 'sidewalk' WHEN highway = 'steps' THEN 'stairs' ELSE 'footway' END AS edge_kind, count(*) AS n FROM net_ways GROUP BY 1")
def edge_kinds(spark, d):
    return N.edge_kind_counts(ways(spark, d))


_LON, _LAT = "lon{0}::DOUBLE", "lat{0}::DOUBLE"
_HAVERSINE = "2 * 6371008.8 * asin(least(1.0, sqrt(power(sin(radians(lat1::DOUBLE - lat0::DOUBLE) / 2), 2) + cos(radians(lat0::DOUBLE)) * cos(radians(lat1::DOUBLE)) * power(sin(radians(lon1::DOUBLE - lon0::DOUBLE) / 2), 2))))"


@query("haversine_lengths", f"SELECT id, round({_HAVERSINE}, 4) AS length_m, round(lon1::DOUBLE, 6) AS lon, round(lat1::DOUBLE, 6) AS lat FROM net_ways")
def haversine_lengths(spark, d):
    p = geo.representative_point("coords")
    return _lines(spark, d).select("id", F.round("length_m", 4).alias("length_m"), F.round(p["lon"], 6).alias("lon"), F.round(p["lat"], 6).alias("lat"))


@query("length_in_bounds", f"SELECT id, CASE WHEN least(lon0, lon1)::DOUBLE >= -49.28 AND greatest(lon0, lon1)::DOUBLE <= -49.27 THEN round({_HAVERSINE}, 3) ELSE 0 END::DOUBLE AS length_m FROM net_ways WHERE lon0::DOUBLE NOT BETWEEN -49.2806 AND -49.2799 AND lon1::DOUBLE NOT BETWEEN -49.2806 AND -49.2799 AND lon0::DOUBLE NOT BETWEEN -49.2706 AND -49.2694 AND lon1::DOUBLE NOT BETWEEN -49.2706 AND -49.2694")
def length_in_bounds(spark, d):
    """Metres of each way within a strip of longitudes, ways across its edges left out."""
    w = _ends(ways(spark, d))
    far = [~F.col(c).between(a, b) for c in ("lon0", "lon1") for a, b in ((-49.2806, -49.2799), (-49.2706, -49.2694))]
    for test in far:
        w = w.where(test)
    return w.select("id", F.round(geo.line_length_in_bounds(F.array("coords"), -49.28, -90, -49.27, 90), 3).alias("length_m"))


@query("tile_arithmetic", """SELECT id, x, y, x // 2 AS px, y // 2 AS py, 4 * x + 2 AS children_x, 4 * y + 2 AS children_y, x AS parsed_x FROM (
       SELECT id, floor((lon0::DOUBLE + 180) / 360 * 65536)::BIGINT AS x, floor((1 - asinh(tan(radians(lat0::DOUBLE))) / pi()) / 2 * 65536)::BIGINT AS y FROM net_ways) t""")
def tile_arithmetic(spark, d):
    t = _ends(ways(spark, d)).select("id", geo.tile_x("lon0", 16).alias("x"), geo.tile_y("lat0", 16).alias("y"))
    px, py = geo.tile_parent("x", "y")
    total = lambda k: F.aggregate(F.array_distinct(F.transform(geo.tile_children("x", "y"), lambda c: c[k])), F.lit(0).cast("long"), lambda a, v: a + v) + 1
    return t.select("id", "x", "y", px.alias("px"), py.alias("py"), total("x").alias("children_x"), total("y").alias("children_y"), geo.parse_tile(geo.tile_id(F.lit(16), "x", "y"))["x"].alias("parsed_x"))


@query("dem_tile_names", "SELECT od_id, 'Copernicus_DSM_COG_10_S' || abs(floor(lat_a::DOUBLE))::INT || '_00_W' || lpad(abs(floor(lon_a::DOUBLE))::INT::VARCHAR, 3, '0') || '_00_DEM' AS name FROM net_od")
def dem_tile_names(spark, d):
    return view(spark, d, "net_od").select("od_id", X.dem_tile_name(F.col("lat_a").cast("double"), F.col("lon_a").cast("double"), 30).alias("name"))


@query("percent_texts", "SELECT surface, round_even(100.0 * count(*) / (SELECT count(*) FROM net_ways), 2)::DOUBLE::VARCHAR || '%' AS percent FROM net_ways WHERE surface IS NOT NULL GROUP BY surface")
def percent_texts(spark, d):
    w = view(spark, d, "net_ways")
    c = w.groupBy("surface").agg(F.count("*").alias("n")).crossJoin(w.agg(F.count("*").alias("total"))).where("surface is not null")  # one row of totals
    return c.select("surface", normalize.percent_text(F.col("n").cast("double"), F.col("total").cast("double")).alias("percent"))


@query("travel_and_delta", """SELECT l_orderkey AS order_id, l_linenumber AS line, greatest(1, floor(l_quantity::DOUBLE / 4.8 * 60 + 0.5))::INT AS minutes, round(l_quantity::DOUBLE - l_quantity::DOUBLE * (1 - l_discount::DOUBLE), 6) AS delta_km,
       round(100 * (l_quantity::DOUBLE - l_quantity::DOUBLE * (1 - l_discount::DOUBLE)) / (l_quantity::DOUBLE * (1 - l_discount::DOUBLE)), 6) AS delta_percent, l_discount = 0 AS same FROM lineitem""")
def travel_and_delta(spark, d):
    km, off = F.col("l_quantity").cast("double"), F.col("l_discount").cast("double")
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), km.alias("km"), (km * (1 - off)).alias("base_km"))
    out = T.route_delta(rows)
    return out.select("order_id", "line", normalize.travel_time_min("km", 4.8).alias("minutes"), F.round("delta_km", 6).alias("delta_km"), F.round("delta_percent", 6).alias("delta_percent"), "same")


@query("fingerprints", "SELECT id, sha256('+' || id || chr(31) || CASE WHEN surface IS NULL THEN '-' ELSE '+' || surface END) AS print FROM net_ways")
def fingerprints(spark, d):
    return view(spark, d, "net_ways").select("id", normalize.fingerprint(F.col("id"), F.col("surface")).alias("print"))


@query("titles_and_years", "SELECT id, CASE smoothness WHEN 'very_bad' THEN 'Very Bad' WHEN '?' THEN '?' ELSE upper(smoothness[1]) || smoothness[2:] END AS title, rev_year::INT AS year, CASE n_revs WHEN 1 THEN 'new' WHEN 2 THEN 'changed' ELSE n_revs::VARCHAR END AS status FROM net_ways")
def titles_and_years(spark, d):
    w = view(spark, d, "net_ways")
    return w.select("id", normalize.humanize("smoothness").alias("title"), normalize.survey_year(normalize.last_update("rev_day", "rev_month", "rev_year")).alias("year"), normalize.status_name("n_revs", {1: "new", 2: "changed"}).alias("status"))


@query("nearest_crossing", f"SELECT k.kerb AS kerb_id, min(c.id) AS crossing_id FROM ({_KERB_SQL}) k JOIN ({_ENDS_SQL}) c USING (x, y) GROUP BY k.kerb")
def nearest_crossing(spark, d):
    return S.nearest_within(_kerbs(spark, d), _crossings(spark, d), 2.0).select(F.col("l_id").alias("kerb_id"), F.col("r_id").alias("crossing_id"))


@query("connected_kerbs", f"""SELECT 'connected' AS side, count(DISTINCT k.kerb) AS n FROM ({_KERB_SQL}) k JOIN ({_ENDS_SQL}) c USING (x, y) WHERE c.id % 20 = 6
       UNION ALL SELECT 'apart', (SELECT count(*) FROM net_kerbs) - count(DISTINCT k.kerb) FROM ({_KERB_SQL}) k JOIN ({_ENDS_SQL}) c USING (x, y) WHERE c.id % 20 = 6""")
def connected_kerbs(spark, d):
    near, far = S.connected_to(_kerbs(spark, d), _crossings(spark, d).where("id % 20 = 6"), 5.0)
    return near.agg(F.lit("connected").alias("side"), F.count("*").alias("n")).unionByName(far.agg(F.lit("apart").alias("side"), F.count("*").alias("n")))


@query("kerbs_off_some_crossings", f"SELECT kerb AS id FROM ({_KERB_SQL}) k WHERE NOT EXISTS (SELECT 1 FROM ({_ENDS_SQL}) c WHERE c.x = k.x AND c.y = k.y AND c.id % 20 = 6)")
def kerbs_off_some_crossings(spark, d):
    return S.kerbs_without_crossing(_kerbs(spark, d), _crossings(spark, d).where("id % 20 = 6")).select("id")


_TRANSITIONS = f"SELECT c.id, k.kerb AS k, n.kerb, n.tactile_paving FROM ({_ENDS_SQL}) c LEFT JOIN ({_KERB_SQL}) k USING (x, y) LEFT JOIN net_kerbs n ON n.id = k.kerb"


@query("crossing_transitions", f"SELECT id, coalesce(string_agg(kerb, ',' ORDER BY k) FILTER (WHERE kerb IS NOT NULL AND kerb <> '?'), '') AS kerbs, coalesce(string_agg(tactile_paving, ',' ORDER BY k) FILTER (WHERE tactile_paving IS NOT NULL AND tactile_paving <> '?'), '') AS tactile FROM ({_TRANSITIONS}) t GROUP BY id")
def crossing_transitions(spark, d):
    """The kerbs and tactile paving beside each crossing, by kerb id."""
    sidewalks = _ends(ways(spark, d).where("layer = 'sidewalks'")).select("element", "id", "surface", "lon0", "lat0", "lon1", "lat1")
    c = S.crossing_context(_crossings(spark, d), _kerbs(spark, d), sidewalks)
    text = lambda x: F.coalesce(F.array_join(x, ","), F.lit(""))
    return c.select("id", text("associated_kerbs").alias("kerbs"), text("associated_tactile_paving").alias("tactile"))


@query("dem_at_points", "SELECT o.od_id, round(e.elev::DOUBLE, 6) AS elev FROM net_od o LEFT JOIN net_dem e ON e.px = floor((o.lon_a::DOUBLE + 49.30007) / 0.0003)::BIGINT AND e.py = floor((-25.46007 - o.lat_a::DOUBLE) / 0.0003)::BIGINT")
def dem_at_points(spark, d):
    points = view(spark, d, "net_od").select("od_id", F.col("lon_a").cast("double").alias("lon"), F.col("lat_a").cast("double").alias("lat"))
    return S.dem_sample(points, view(spark, d, "net_dem").withColumn("elev", F.col("elev").cast("double")), -49.30007, -25.46007, 0.0003).select("od_id", F.round("elev", 6).alias("elev"))


@query("enriched_changesets", """SELECT t.changeset_id, deletions, c_name AS "user" FROM (SELECT changeset_id, count(*) AS deletions FROM net_changes WHERE deletion GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50) t JOIN customer ON c_custkey = t.changeset_id""")
def enriched_changesets(spark, d):
    meta = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("changeset_id"), F.col("c_name").alias("user"))
    return C.enrich_changesets(C.top_deletions(view(spark, d, "net_changes"), "2100-01-01", days=60_000, n=50), meta)


@query("completeness_footways", "SELECT count(*) AS n, round(sum(lon0::DOUBLE), 4) AS lon FROM net_ways WHERE footway = 'sidewalk' OR (footway IS NULL AND highway = 'footway')")
def completeness_footways(spark, d):
    w = _ends(ways(spark, d))
    return K.completeness_footways(w.where("layer = 'sidewalks'"), w.where("layer = 'other_footways'")).agg(F.count("*").alias("n"), F.round(F.sum("lon0"), 4).alias("lon"))


@query("slope_sources", "SELECT CASE WHEN incline IS NULL THEN 'missing' WHEN incline IN ('up', 'down') THEN 'qualitative' WHEN incline = 'abc' THEN 'invalid' ELSE 'direct_osm_numeric' END AS incline_source, count(*) AS n FROM net_ways GROUP BY 1")
def slope_sources(spark, d):
    return N.slope_source_counts(G.prepare_features(ways(spark, d)))


@query("bounds_of_all", "SELECT round(min(least(lon0, lon1))::DOUBLE, 6) AS xmin, round(min(least(lat0, lat1))::DOUBLE, 6) AS ymin, round(max(greatest(lon0, lon1))::DOUBLE, 6) AS xmax, round(max(greatest(lat0, lat1))::DOUBLE, 6) AS ymax FROM net_ways")
def bounds_of_all(spark, d):
    b = geo.bounds("coords")
    rows = ways(spark, d).select(*[b[c].alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])
    return A.total_bounds(rows).select(*[F.round(c, 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query("attribute_filter", "SELECT id, crossing FROM net_ways WHERE crossing IS NOT NULL AND surface = 'asphalt'")
def attribute_filter(spark, d):
    return E.attribute_filter(view(spark, d, "net_ways"), "crossing IS NOT NULL AND surface = 'asphalt'").select("id", "crossing")


@query("age_lookup", f"SELECT id, {LAYER} AS layer, CASE WHEN id % 3 = 0 THEN n_revs::DOUBLE END AS age FROM net_ways")
def age_lookup(spark, d):
    rows = ways(spark, d).select("id", "layer", "n_revs")
    return E.age_lookup(rows.select("id", "layer"), rows.where("id % 3 = 0").withColumn("age", F.col("n_revs").cast("double")))


@query("routable_parts", "SELECT id, part, 2 AS vertices FROM net_ways, (SELECT 0 AS part UNION ALL SELECT 1 AS part) p WHERE id % 2 = 0 OR part = 0")
def routable_parts(spark, d):
    parts = F.when(F.col("id") % 2 == 0, F.array("coords", "coords")).otherwise(F.array("coords"))
    return E.routable_lines(ways(spark, d).withColumn("parts", parts).drop("coords")).select("id", "part", F.size("coords").alias("vertices"))


_SHAPED = "CASE WHEN id % 7 = 0 THEN 'Point' ELSE 'LineString' END"


@query("geometry_of_layers", f"SELECT layer, id % 7 <> 0 AS proper, count(*) AS n FROM (SELECT {LAYER} AS layer, id FROM net_ways) t WHERE id % 7 <> 0 OR layer <> 'other_footways' GROUP BY 1, 2")
def geometry_of_layers(spark, d):
    good, bad = E.proper_geometry(ways(spark, d).withColumn("geom_type", F.expr(_SHAPED)))
    return good.withColumn("proper", F.lit(True)).unionByName(bad.withColumn("proper", F.lit(False))).groupBy("layer", "proper").agg(F.count("*").alias("n"))


@query("dq_geometry", f"""SELECT category, layer, element, count(*) AS n FROM (
  SELECT 'disjointed_geometries' AS category, {LAYER} AS layer, 'way' AS element FROM net_ways WHERE id % 11 = 0
  UNION ALL SELECT 'improper_geometries', {LAYER}, 'node' FROM net_ways WHERE id % 7 = 0 AND footway IS NOT NULL
  UNION ALL SELECT 'crossings_lacking_kerbs', 'crossings', 'way' FROM (SELECT c.id FROM ({_ENDS_SQL}) c LEFT JOIN ({_KERB_SQL}) k USING (x, y) GROUP BY c.id HAVING count(k.kerb) < 2) q
  UNION ALL SELECT 'kerb_on_top_of_non_crossing', 'kerbs', 'node' FROM ({_KERB_SQL}) k WHERE NOT EXISTS (SELECT 1 FROM ({_ENDS_SQL}) c WHERE c.x = k.x AND c.y = k.y AND c.id % 20 = 6)) t GROUP BY 1, 2, 3""")
def dq_geometry(spark, d):
    w = ways(spark, d)
    _, improper = E.proper_geometry(w.withColumn("geom_type", F.expr(_SHAPED)))
    keys = ["layer", "element", "id"]
    lacking = S.crossings_lacking_kerbs(_crossings(spark, d), _kerbs(spark, d)).withColumn("layer", F.lit("crossings"))
    alone = S.kerbs_without_crossing(_kerbs(spark, d), _crossings(spark, d).where("id % 20 = 6")).withColumn("layer", F.lit("kerbs"))
    out = Q.dq_geometry(w.where("id % 11 = 0").select(*keys), improper.select(*keys), lacking.select(*keys), alone.select(*keys))
    return out.groupBy("category", "layer", "element").agg(F.count("*").alias("n"))


@query("dq_key_rules", f"""SELECT category, layer, key, count(*) AS n FROM (
  SELECT 'improper_keys' AS category, {LAYER} AS layer, 'smoothness' AS key FROM net_ways WHERE footway = 'crossing' AND smoothness <> ''
  UNION ALL SELECT 'uncanny_keys', {LAYER}, 'wheelchair' FROM net_ways WHERE footway IS NULL AND wheelchair <> ''
  UNION ALL SELECT 'keys_without_wiki', {LAYER}, CASE WHEN incline <> '' THEN 'incline' ELSE 'width' END FROM net_ways WHERE footway = 'sidewalk' AND (incline <> '' OR width <> '')) t GROUP BY 1, 2, 3""")
def dq_key_rules(spark, d):
    rows = Q.tag_issues(_tagged(spark, d), undocumented={"sidewalks": ["incline", "width"]}, improper={"crossings": {"smoothness": "c"}}, uncanny={"other_footways": {"wheelchair": "c"}}, replaceable={}, missing={})
    return rows.where("category <> 'invalid_characters'").groupBy("category", "layer", "key").agg(F.count("*").alias("n"))


@query("dq_invalid_characters", f"SELECT {LAYER} AS layer, count(*) AS n FROM net_ways WHERE id % 13 = 0 GROUP BY 1")
def dq_invalid_characters(spark, d):
    tags = F.create_map(F.lit("note"), F.when(F.col("id") % 13 == 0, "surface=asphalt").otherwise("plain"))
    return Q.tag_issues(ways(spark, d).withColumn("tags", tags), improper={}, uncanny={}, replaceable={}, missing={}).where("category = 'invalid_characters'").groupBy("layer").agg(F.count("*").alias("n"))


@query("hazard_view", """SELECT l_orderkey AS order_id, l_linenumber AS line FROM lineitem WHERE l_returnflag = 'N' OR (l_linenumber % 5 >= 2 AND l_quantity >= 20)""")
def hazard_view(spark, d):
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.when(F.col("l_returnflag") == "N", "insufficient_data").otherwise("hazard_detected").alias("status"), (F.col("l_linenumber") % 5).alias("severity"), F.col("l_quantity").cast("int").alias("confidence"))
    return H.hazard_view(rows, min_severity=2, min_confidence=20, include_unknown=True).select("order_id", "line")


@query("columns_without_words", "SELECT id, element, barrier, kerb, tactile_paving FROM net_kerbs")
def columns_without_words(spark, d):
    return T.select_columns(view(spark, d, "net_kerbs"), ["lon", "lat"])


@query("tag_domains", f"""SELECT layer, key, array_to_string(list_sort(list(DISTINCT value)), '|') AS accepted FROM (SELECT {LAYER} AS layer, unnest(['surface', 'crossing', 'width']) AS key, unnest([surface, crossing, width]) AS value FROM net_ways) t
       WHERE value <> '?' AND key <> 'width' GROUP BY 1, 2""")
def tag_domains(spark, d):
    rows = ways(spark, d).select("layer", F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in ("surface", "crossing", "width")])))
    return T.valid_tag_domain(rows).select("layer", "key", F.array_join("accepted", "|").alias("accepted"))


@query("scored_surfaces", f"SELECT id, CASE WHEN {LAYER} = 'sidewalks' AND surface IS NOT NULL THEN length(surface)::DOUBLE ELSE 1.5 END AS score FROM net_ways")
def scored_surfaces(spark, d):
    w = ways(spark, d)
    scores = w.where("layer = 'sidewalks' and surface is not null").select("layer", F.lit("surface").alias("key"), F.col("surface").alias("value"), F.length("surface").cast("double").alias("score")).distinct()
    return T.score_lookup(w.select("id", "layer", "surface"), scores, "surface", 1.5).select("id", "score")


_HISTORY = "SELECT CAST(ts AS DATE)::VARCHAR AS timestamp, 12 AS z, id % 40 AS x, id % 30 AS y, sum(value) AS footway_ratio FROM net_changes WHERE {} GROUP BY 1, 2, 3, 4"


@query("merged_history", f"WITH o AS ({_HISTORY.format('id % 40 < 30')}), n AS ({_HISTORY.format('id % 40 >= 10 AND day(ts) % 2 = 0')}) SELECT timestamp, z, x, y, round(footway_ratio, 4) AS footway_ratio FROM n UNION ALL SELECT timestamp, z, x, y, round(footway_ratio, 4) FROM o WHERE timestamp NOT IN (SELECT timestamp FROM n) AND (z, x, y) IN (SELECT (z, x, y) FROM n)")
def merged_history(spark, d):
    rows = view(spark, d, "net_changes").select(F.to_date("ts").cast("string").alias("timestamp"), F.lit(12).alias("z"), (F.col("id") % 40).alias("x"), (F.col("id") % 30).alias("y"), "value", "id", F.day("ts").alias("m"))
    total = lambda r: r.groupBy("timestamp", "z", "x", "y").agg(F.sum("value").alias("footway_ratio"))
    out = K.merge_history(total(rows.where("id % 40 < 30")), total(rows.where("id % 40 >= 10 and m % 2 = 0")))
    return out.withColumn("footway_ratio", F.round("footway_ratio", 4))


@query("shared_totals", """WITH t AS (SELECT p_partkey % 7 AS x, p_size % 5 AS y, sum(p_retailprice)::DOUBLE AS total FROM part GROUP BY 1, 2), w AS (SELECT p_partkey % 28 AS x, (p_size + p_partkey) % 20 AS y, sum(CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE 0 END)::DOUBLE AS weight FROM part GROUP BY 1, 2)
       SELECT w.x, w.y, round(CASE WHEN sum(weight) OVER p > 0 THEN total * weight / sum(weight) OVER p ELSE total / count(*) OVER p END, 4) AS value FROM w JOIN t ON t.x = w.x // 4 AND t.y = w.y // 4 WINDOW p AS (PARTITION BY w.x // 4, w.y // 4)""")
def shared_totals(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").cast("long").alias("k"), F.col("p_size").cast("long").alias("s"), F.col("p_retailprice").cast("double").alias("v"))
    totals = p.groupBy((F.col("k") % 7).alias("x"), (F.col("s") % 5).alias("y")).agg(F.sum("v").alias("total"))
    weights = p.groupBy((F.col("k") % 28).alias("x"), ((F.col("s") + F.col("k")) % 20).alias("y")).agg(F.sum(F.when(F.col("k") % 3 == 0, F.col("s")).otherwise(0)).cast("double").alias("weight"))
    return S.disaggregate(totals, weights).withColumn("value", F.round("value", 4))


@query("zoom_sums", "SELECT z, (x // (1 << (6 - z)::INT))::BIGINT AS x, (y // (1 << (6 - z)::INT))::BIGINT AS y, round(sum(v), 3) AS length_m FROM (SELECT p_partkey % 64 AS x, (p_size % 64)::BIGINT AS y, p_retailprice::DOUBLE AS v, unnest([3, 4, 5, 6]) AS z FROM part) t GROUP BY 1, 2, 3")
def zoom_sums(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet").select((F.col("p_partkey") % 64).alias("x"), (F.col("p_size") % 64).alias("y"), F.col("p_retailprice").cast("double").alias("length_m"))
    return S.zoom_rollup(p, 6, 3).withColumn("length_m", F.round("length_m", 3))


@query("sampled_places", """SELECT id, i, round(t * len, 5) AS distance_m, round(lon0 + t * (lon1 - lon0), 8) AS lon, round(lat0 + t * (lat1 - lat0), 8) AS lat FROM (
       SELECT *, -grow + (1 + 2 * grow) * i / 6.0::DOUBLE AS t FROM (SELECT *, greatest(0, (100 - len) / 2 / len) AS grow, unnest(range(7)) AS i FROM (
       SELECT id, lon0::DOUBLE AS lon0, lat0::DOUBLE AS lat0, lon1::DOUBLE AS lon1, lat1::DOUBLE AS lat1,
       sqrt(power((lon1::DOUBLE - lon0::DOUBLE) * 111320.0::DOUBLE * cos(radians((lat0::DOUBLE + lat1::DOUBLE) / 2)), 2) + power((lat1::DOUBLE - lat0::DOUBLE) * 110574.0::DOUBLE, 2)) AS len FROM net_ways) a) b) c""")
def sampled_places(spark, d):
    s = R.sample_positions(_ends(ways(spark, d)).select("id", "lon0", "lat0", "lon1", "lat1"), 100.0)
    return s.select("id", "i", F.round("distance_m", 5).alias("distance_m"), F.round("lon", 8).alias("lon"), F.round("lat", 8).alias("lat"))


@query("edge_slopes", "SELECT l_orderkey AS id, round_even(CASE WHEN abs(s) <= 40 THEN s END, 3)::DOUBLE AS slope_percent, CASE WHEN abs(s) <= 40 THEN round_even(80 * valid / 7.0, 0) ELSE 0 END::INT AS slope_confidence FROM (SELECT a.l_orderkey, any_value(n) AS valid, median((b.l_quantity - a.l_quantity)::DOUBLE / (b.l_linenumber - a.l_linenumber) * 100 / 20) AS s FROM lineitem a JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) c ON c.l_orderkey = a.l_orderkey LEFT JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber > a.l_linenumber GROUP BY 1) t")
def edge_slopes(spark, d):
    """Orders as lines: places 20 m apart by line number, elevations by quantity."""
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("id"), (F.col("l_linenumber") * 20).cast("double").alias("distance_m"), F.col("l_quantity").cast("double").alias("elev"))
    return R.edge_slope(rows, 80)


@query("cached_slopes", "SELECT id AS fingerprint, CASE WHEN id % 3 = 0 THEN -1.0 ELSE n_revs END::DOUBLE AS slope FROM net_ways")
def cached_slopes(spark, d):
    edges = view(spark, d, "net_ways").select(F.col("id").alias("fingerprint"), "n_revs")
    cache = edges.where("fingerprint % 3 = 0").select("fingerprint", F.lit(-1.0).alias("slope")).unionByName(edges.limit(0).select("fingerprint", F.lit(0.0).alias("slope")))
    return X.slope_cache(edges, cache, lambda rest: rest.select("fingerprint", F.col("n_revs").cast("double").alias("slope")))


@query("segment_cells", "SELECT id AS segment_id, (floor(greatest(lon0, lon1)::DOUBLE / 0.00037) - floor(least(lon0, lon1)::DOUBLE / 0.00037) + 1)::BIGINT * (floor(greatest(lat0, lat1)::DOUBLE / 0.00037) - floor(least(lat0, lat1)::DOUBLE / 0.00037) + 1)::BIGINT AS cells FROM net_ways")
def segment_cells(spark, d):
    s = _ends(ways(spark, d)).select(F.col("id").alias("segment_id"), "lon0", "lat0", "lon1", "lat1")
    return N.segment_grid(s, 0.00037).groupBy("segment_id").agg(F.count("*").alias("cells"))


_KEY = "(floor({0}::DOUBLE / 1e-5 + 0.5)::BIGINT, floor({1}::DOUBLE / 1e-5 + 0.5)::BIGINT)"
_A, _B = _KEY.format("lon0", "lat0"), _KEY.format("lon1", "lat1")


@query("network_metadata", f"SELECT (SELECT count(*) FROM (SELECT {_A} FROM net_ways UNION SELECT {_B} FROM net_ways) v) AS vertices, (SELECT count(*) FROM (SELECT {_A} AS a, {_B} AS b FROM net_ways UNION SELECT {_B}, {_A} FROM net_ways) e WHERE a <> b) AS edges")
def network_metadata(spark, d):
    from pednet.policies.profiles import DISTANCE

    lines = _lines(spark, d)
    v = N.build_vertices(lines)
    return N.network_metadata(v, N.build_edges(lines, v, (DISTANCE,))).select("vertices", "edges")


@query("routing_ids", f"SELECT id, {LAYER} || ':' || id || ':' || (row_number() OVER (PARTITION BY {LAYER} ORDER BY id) - 1) AS routing_id FROM net_ways")
def routing_ids(spark, d):
    return N.routing_ids(ways(spark, d)).select("id", "routing_id")


@query("best_boundary", "SELECT c_custkey AS id FROM customer ORDER BY (c_nationkey % 3 = 0) DESC, c_acctbal DESC LIMIT 1")
def best_boundary(spark, d):
    rows = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") % 3 == 0, "administrative").otherwise("place").alias("type"), F.col("c_acctbal").alias("importance"))
    return E.rank_boundaries(rows).select("id")


@query("daily_feed", """SELECT date, sum(n)::BIGINT AS total, string_agg(layer || ': ' || n, chr(10) ORDER BY layer) FILTER (WHERE n > 0) AS text FROM (SELECT CAST(ts AS DATE) AS date, layer,
       (count(*) FILTER (WHERE creation) + count(*) FILTER (WHERE tag_change OR geometry_change) + count(*) FILTER (WHERE deletion)) AS n FROM net_changes GROUP BY 1, 2) t GROUP BY 1 HAVING sum(n) > 0""")
def daily_feed(spark, d):
    return L.write_feed(C.daily_activity(view(spark, d, "net_changes")))


@query("needed_updates", "SELECT layer, max(ts) > TIMESTAMP '2024-06-01' OR layer = 'kerbs' AS needed FROM net_changes GROUP BY layer")
def needed_updates(spark, d):
    changes = view(spark, d, "net_changes")
    registry = changes.where("layer <> 'kerbs'").select("layer").distinct().withColumn("since", F.lit("2024-06-01").cast("timestamp"))
    return C.needs_update(changes, registry, ["sidewalks", "crossings", "kerbs", "other_footways"])


@query("deduped_features", "SELECT id, min(event_id) AS event_id FROM (SELECT *, CASE event_id % 4 WHEN 0 THEN 'sidewalks' WHEN 1 THEN 'crossings' WHEN 2 THEN 'kerbs' ELSE 'other_footways' END AS l FROM net_changes) t GROUP BY l, id")
def deduped_features(spark, d):
    rows = view(spark, d, "net_changes").select("layer", "element", "id", "event_id").withColumn("position", F.col("event_id"))
    return E.dedupe_features(rows).select("id", "event_id")


# --- hazards in SQL, from the same policy ----------------------------------------------------------------------

_NORMAL = {c: f"lower(trim({c}))" for c in ("surface", "smoothness", "wheelchair", "highway")}
_INCLINE = "CASE incline WHEN '5%' THEN 5 WHEN '-10%' THEN -10 WHEN '5°' THEN tan(radians(5)) * 100 WHEN '0%' THEN 0 WHEN '12.6%' THEN 12.6 END::DOUBLE"
_ACROSS = "CASE incline_across WHEN '1%' THEN 1 WHEN '2.5%' THEN 2.5 WHEN '6%' THEN 6 END::DOUBLE"


def _hazard_test(rule, sign: int) -> str:
    """A rule's condition in SQL, over a view of prepared fields; null counts as false."""
    c = rule.condition
    field = {"directional_incline_percent": f"({sign} * incline_percent)"}.get(c.field, c.field)
    if c.field not in (*_NORMAL, "directional_incline_percent", "cross_slope_percent"):
        return "false"  # ways of the view have no kerbs or transition states beside them
    test = {
        "equals": lambda: f"{field} = '{c.value}'",
        "in": lambda: f"{field} IN ({', '.join(repr(v) for v in c.value)})",
        "gt": lambda: f"{field} > {c.value}",
        "lt": lambda: f"{field} < {c.value}",
        "abs_gt": lambda: f"abs({field}) > {c.value}",
        "range": lambda: f"{field} > {c.low} AND {field} <= {c.high}",
        "abs_range": lambda: f"abs({field}) > {c.low} AND abs({field}) <= {c.high}",
        "negative_range": lambda: f"{field} < 0 AND abs({field}) > {c.low} AND abs({field}) <= {c.high}",
    }[c.operator]()
    where = f" AND edge_kind IN ({', '.join(repr(k) for k in rule.applies_to)})" if rule.applies_to else ""
    return f"coalesce({test}{where}, false)"


def _hazard_sql(profile: str = "wheelchair") -> str:
    """Severity, status and decisive rules of the worse direction, counted as (kind, value, n)."""
    rules = [r for r in RULES if profile in r.effects]
    fields = ", ".join(f"CASE WHEN {x} NOT IN {_UNKNOWN} THEN {x} END AS {c}" for c, x in _NORMAL.items())
    known = " + ".join(f"({c} IS NOT NULL)::INT" for c in ("surface", "smoothness", "incline_percent", "cross_slope_percent", "wheelchair"))
    base = f"SELECT id, CASE WHEN footway = 'crossing' THEN 'crossing' WHEN footway = 'sidewalk' THEN 'sidewalk' WHEN highway = 'steps' THEN 'stairs' ELSE 'footway' END AS edge_kind, {_INCLINE} AS incline_percent, {_ACROSS} AS cross_slope_percent, {fields} FROM net_ways"
    hits = []
    for side, sign in (("f", 1), ("b", -1)):
        for i, r in enumerate(rules):
            severity, _, *rest = r.effects[profile]
            sure = {"longitudinal_slope": "CASE WHEN incline_percent IS NOT NULL THEN 100 ELSE 0 END", "cross_slope": "CASE WHEN cross_slope_percent IS NOT NULL THEN 100 ELSE 0 END"}.get(r.category, "100")
            hits.append(f"SELECT id, '{side}' AS side, {i} AS i, '{r.id}' AS rule, {severity} AS severity, {TRAVERSABILITY.index(rest[0]) if rest else 0} AS way, least({r.confidence}, {sure}) AS sure FROM p WHERE {_hazard_test(r, sign)}")
    return f"""WITH p0 AS ({base}), p AS (SELECT *, round_even(100 * CASE WHEN edge_kind = 'crossing' THEN ({known}) / 8.0 ELSE ({known}) / 5.0 END, 0)::INT AS cover FROM p0),
h AS ({' UNION ALL '.join(hits)}),
t AS (SELECT id, side, max(severity) AS top FROM h GROUP BY 1, 2),
d AS (SELECT h.id, h.side, max(top) AS top, max(way) AS way, max(sure) AS sure, list(rule ORDER BY i) AS rules FROM h JOIN t ON h.id = t.id AND h.side = t.side AND h.severity = t.top GROUP BY 1, 2),
s AS (SELECT p.id, side0 AS side, coalesce(top, 0) AS top, coalesce(way, 0) AS way, coalesce(sure, cover) AS sure, coalesce(rules, []) AS rules,
  CASE WHEN coalesce(top, 0) > 0 THEN 'hazard_detected' WHEN cover >= 60 THEN 'no_detected_hazard' ELSE 'insufficient_data' END AS status
  FROM p CROSS JOIN (SELECT unnest(['f', 'b']) AS side0) x LEFT JOIN d ON d.id = p.id AND d.side = x.side0),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY top DESC, way = {len(TRAVERSABILITY) - 1} DESC, sure DESC, side DESC) AS r FROM s) q WHERE r = 1)
SELECT kind, value, count(*) AS n FROM (SELECT 'severity' AS kind, top::VARCHAR AS value FROM w UNION ALL SELECT 'status', status FROM w UNION ALL SELECT 'rule', unnest(rules) FROM w) z GROUP BY 1, 2"""


@query("hazard_audit", _hazard_sql())
def hazard_audit(spark, d):
    return H.hazard_audit(H.compact_hazard(H.assess_hazards(G.prepare_features(ways(spark, d)), profiles=("wheelchair",)), "wheelchair"))


_CATEGORY = {c: [r for r in RULES if r.category == c and "blind" in r.effects] for c in CATEGORIES}


@query("hazard_categories", "SELECT " + ", ".join(f"sum(category_{c})::BIGINT AS {c}" for c in CATEGORIES) + " FROM (SELECT " + ", ".join("greatest(0, 0" + "".join(f", CASE WHEN {_hazard_test(r, s)} THEN {r.effects['blind'][0]} ELSE 0 END" for r in rs for s in (1, -1)) + f") AS category_{c}" for c, rs in _CATEGORY.items())
       + f" FROM (SELECT CASE WHEN footway = 'crossing' THEN 'crossing' ELSE 'other' END AS edge_kind, {_INCLINE} AS incline_percent, {_ACROSS} AS cross_slope_percent, " + ", ".join(f"CASE WHEN {x} NOT IN {_UNKNOWN} THEN {x} END AS {c}" for c, x in _NORMAL.items()) + " FROM net_ways) p) t")
def hazard_categories(spark, d):
    rows = H.compact_hazard(H.assess_hazards(G.prepare_features(ways(spark, d)), profiles=("blind",)), "blind")
    return rows.agg(*[F.sum(f"category_{c}").cast("long").alias(c) for c in CATEGORIES])


# --- profiles in SQL, from the same policy ---------------------------------------------------------------------

_NUMERIC = ("width_m", "incline_percent", "cross_slope_percent")
_WIDTH = "CASE width WHEN '1.5' THEN 1.5 WHEN '1,25 m' THEN 1.25 WHEN '4''6\"' THEN 4 * 0.3048::DOUBLE + 6 * 0.0254::DOUBLE WHEN '1.5;0.9' THEN 0.9 WHEN '90 cm' THEN 90 * 0.01::DOUBLE WHEN '6 ft' THEN 6 * 0.3048::DOUBLE END::DOUBLE"
_THERE = (*_NORMAL, "crossing", *_NUMERIC)


def _bands_sql(x: str, bands) -> str:
    cases = " ".join(f"WHEN {x} <= {limit}::DOUBLE THEN {float(g)}::DOUBLE" for limit, g in bands if limit is not None)
    last = [g for limit, g in bands if limit is None]
    return f"CASE {cases} ELSE {float(last[0]) if last else 'NULL'}::DOUBLE END"


def _grade_sql(f, sign: int) -> str:
    """A factor's grade; fields that ways of the view lack are unknown."""
    unknown = f"{float(f.unknown)}::DOUBLE"
    if f.field not in _THERE:
        return unknown
    if f.values is not None:
        return f"coalesce(CASE {f.field} " + " ".join(f"WHEN '{v}' THEN {float(g)}::DOUBLE" for v, g in f.values.items()) + f" END, {unknown})"
    if f.bands is not None:
        graded = _bands_sql(f"abs({f.field})" if f.absolute else f.field, f.bands)
    else:
        graded = f"CASE WHEN {sign} * {f.field} >= 0 THEN {_bands_sql(f'abs({f.field})', f.ascending)} ELSE {_bands_sql(f'abs({f.field})', f.descending)} END"
    return f"CASE WHEN {f.field} IS NULL THEN {unknown} ELSE {graded} END"


def _condition_sql(c) -> str:
    if c.field not in _THERE or c.operator in ("contains", "transition_pair"):
        return "false"
    x = c.field
    test = {
        "equals": lambda: f"{x} = '{c.value}'",
        "in": lambda: f"{x} IN ({', '.join(repr(v) for v in c.value)})",
        "lt": lambda: f"{x} < {c.value}",
        "lte": lambda: f"{x} <= {c.value}",
        "gt": lambda: f"{x} > {c.value}",
        "gte": lambda: f"{x} >= {c.value}",
        "abs_gt": lambda: f"abs({x}) > {c.value}",
        "range": lambda: f"{x} > {c.low} AND {x} <= {c.high}",
        "abs_range": lambda: f"abs({x}) > {c.low} AND abs({x}) <= {c.high}",
    }[c.operator]()
    return f"coalesce({test}{_kinds_sql(c.applies_to)}, false)"


def _kinds_sql(kinds) -> str:
    return f" AND edge_kind IN ({', '.join(repr(k) for k in kinds)})" if kinds else ""


def _profile_sql() -> str:
    """Per profile the grades of the worse direction in bands, and the commonest limits."""
    fields = ", ".join(f"CASE WHEN {x} NOT IN {_UNKNOWN} THEN {x} END AS {c}" for c, x in {**_NORMAL, "crossing": "lower(trim(crossing))"}.items())
    base = f"SELECT id, CASE WHEN footway = 'crossing' THEN 'crossing' WHEN footway = 'sidewalk' THEN 'sidewalk' WHEN highway = 'steps' THEN 'stairs' ELSE 'footway' END AS edge_kind, {_WIDTH} AS width_m, {_INCLINE} AS incline_percent, {_ACROSS} AS cross_slope_percent, {fields} FROM net_ways"
    sides = []
    for p in (p for p in PROFILES if p.mode != "distance"):
        for side, sign in (("f", 1), ("b", -1)):
            names = list(p.factors)
            grades = ", ".join(f"CASE WHEN true{_kinds_sql(f.applies_to)} THEN {_grade_sql(f, sign)} END AS g{i}" for i, f in enumerate(p.factors.values()))
            weight = " + ".join(f"CASE WHEN g{i} IS NOT NULL THEN {float(f.weight)}::DOUBLE ELSE 0 END" for i, f in enumerate(p.factors.values()))
            slow = " + ".join(f"CASE WHEN g{i} > 0 THEN {float(f.weight)}::DOUBLE / g{i} ELSE 0 END" for i, f in enumerate(p.factors.values()))
            value = "value"
            for cap in p.caps:
                value = f"CASE WHEN {_condition_sql(cap)} AND {value} > {cap.most} THEN {float(cap.most)}::DOUBLE ELSE {value} END"
            stop = " OR ".join(["false", *(_condition_sql(b) for b in p.barriers)])
            limit = "CASE " + " ".join(f"WHEN g{i} = low THEN '{n}'" for i, n in enumerate(names)) + " END"
            all_g = ", ".join(f"g{i}" for i in range(len(names)))
            sides.append(f"""SELECT id, '{p.name}' AS profile, '{side}' AS side, CASE WHEN {stop} THEN 0 ELSE greatest(0, least(100, round_even({value}, 0)))::INT END AS grade, CASE WHEN {stop} THEN 'barrier' ELSE {limit} END AS limited
FROM (SELECT *, CASE WHEN low IS NULL THEN 100 WHEN low <= 0 THEN 0 ELSE ({weight}) / ({slow}) END::DOUBLE AS value FROM (SELECT *, least({all_g}) AS low FROM (SELECT *, {grades} FROM p) a) b) c""")
    bands = ", ".join(f"count(*) FILTER (WHERE worst >= {a} AND worst < {b}) AS band_{a}" for a, b in ((0, 1), (1, 20), (20, 40), (40, 60), (60, 80), (80, 101)))
    return f"""WITH p AS ({base}), s AS ({' UNION ALL '.join(sides)}),
w AS (SELECT f.profile, least(f.grade, b.grade) AS worst, CASE WHEN f.grade <= b.grade THEN f.limited ELSE b.limited END AS limited FROM s f JOIN s b ON f.id = b.id AND f.profile = b.profile AND f.side = 'f' AND b.side = 'b'),
l AS (SELECT profile, limited, count(*) AS c, row_number() OVER (PARTITION BY profile ORDER BY count(*) DESC, limited) AS r FROM w WHERE limited IS NOT NULL GROUP BY 1, 2)
SELECT w.profile, count(*) AS n, min(worst)::INT AS least, max(worst)::INT AS greatest, round_even(avg(worst), 2)::DOUBLE AS mean, {bands}, any_value(t.limits) AS limits FROM w JOIN (SELECT profile, string_agg(limited || ':' || c, ',' ORDER BY r) AS limits FROM l WHERE r <= 10 GROUP BY 1) t ON t.profile = w.profile GROUP BY 1"""


@query("profile_grades", _profile_sql())
def profile_grades(spark, d):
    """profile_audit with its limits as text."""
    out = G.profile_audit(G.compact_grades(G.grade_features(G.prepare_features(G.alike(ways(spark, d))))))
    return out.withColumn("limits", F.array_join(F.transform("limits", lambda x: F.concat_ws(":", x["limit"], x["c"])), ","))

"""Registered queries over the adapter views, each with its equivalent in DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pednet.functions import geo, normalize
from pednet.operators import areas as X
from pednet.operators import changes as C
from pednet.operators import completeness as K
from pednet.operators import features as E
from pednet.operators import grading as G
from pednet.operators import network as N
from pednet.operators import overlay as V
from pednet.operators import quality as Q
from pednet.operators import routing as P
from pednet.operators import spatial as S
from pednet.operators import summaries as A
from pednet.operators import terrain as R
from pednet.operators import themes as T
from pednet.plans.network_views import LAYER, view, ways, with_views

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

AS_OF = "2025-01-01"
ZONE = 22


def query(name: str, sql: str | None = None):
    """Register a query; sql may name adapter views."""

    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_views(sql) if "net_" in sql else sql
        return f

    return add


_LABEL = "CASE WHEN {0} IS NULL OR trim({0}) IN ('', '?') THEN '?' ELSE trim({0}) END"


@query(
    "crosstab_surface_smoothness",
    f"SELECT x, y, count(*) AS n FROM (SELECT {_LABEL.format('surface')} AS x, {_LABEL.format('smoothness')} AS y FROM net_ways) t GROUP BY CUBE (x, y)",
)
def crosstab(spark: SparkSession, d: str) -> DataFrame:
    return A.crosstab(view(spark, d, "net_ways"), "surface", "smoothness")


@query("value_counts_surface", "SELECT surface AS value, count(*) AS n, round_even(100.0 * count(*) / sum(count(*)) OVER (), 2) AS share FROM net_ways WHERE surface IS NOT NULL GROUP BY surface")
def value_counts(spark, d):
    return A.value_counts(view(spark, d, "net_ways"), "surface")


@query("bar_highway_revisions", "SELECT highway AS value, count(*) AS n, CAST(sum(n_revs) AS DOUBLE) AS weight FROM net_ways WHERE highway IS NOT NULL AND highway <> 'path' GROUP BY highway")
def bar(spark, d):
    return A.bar_aggregate(view(spark, d, "net_ways"), "highway", weight="n_revs", exclude=("path",)).withColumn("weight", F.col("weight").cast("double"))


@query(
    "width_metres",
    """SELECT id, round(CASE width WHEN '1.5' THEN 1.5 WHEN '1,25 m' THEN 1.25 WHEN '4''6"' THEN (4 + 6 / 12.0) * 0.3048 WHEN '1.5;0.9' THEN 0.9 WHEN '90 cm' THEN 0.9
       WHEN '6 ft' THEN 6 * 0.3048 END::DOUBLE, 6) AS width_m FROM net_ways""",
)
def width_metres(spark, d):
    return view(spark, d, "net_ways").select("id", F.round(normalize.parse_width_m("width"), 6).alias("width_m"))


_WIDTHS = ("1.5", "1,25 m", "4'6\"", "5'6in", "5 ' 6", "5'", "5.5'", "6 ft wide", "6feet", "90 cm approx", "850mm", "-1.5", "1.5;0.9", "?;2 m;6ft", ";", "?", "abc", "3'x", "approx 2,5")


@query(
    "width_spellings",
    """SELECT l_orderkey AS order_id, l_linenumber AS line, round(CASE (l_orderkey + l_linenumber) % 20 WHEN 0 THEN 1.5 WHEN 1 THEN 1.25 WHEN 2 THEN 4 * 0.3048 + 6 * 0.0254 WHEN 3 THEN 5 * 0.3048 + 6 * 0.0254
       WHEN 4 THEN 5 * 0.3048 + 6 * 0.0254 WHEN 5 THEN 5 * 0.3048 WHEN 6 THEN 5.5 * 0.3048 WHEN 7 THEN 6 * 0.3048 WHEN 8 THEN 6 * 0.3048 WHEN 9 THEN 0.9 WHEN 10 THEN 0.85 WHEN 11 THEN -1.5
       WHEN 12 THEN 0.9 WHEN 13 THEN 6 * 0.3048 WHEN 17 THEN 3 WHEN 18 THEN 2.5 END::DOUBLE, 6) AS width_m FROM lineitem""",
)
def width_spellings(spark, d):
    """A spelling of a width for each line, some null."""
    spelled = F.get(F.array(*[F.lit(x) for x in _WIDTHS]), F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(20)).cast("int"))
    rows = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), spelled.alias("width"))
    return rows.select("order_id", "line", F.round(normalize.parse_width_m("width"), 6).alias("width_m"))


@query(
    "incline_percent",
    """SELECT id, round(CASE incline WHEN '5%' THEN 5 WHEN '-10%' THEN -10 WHEN '5°' THEN tan(radians(5)) * 100 WHEN '0%' THEN 0 WHEN '12.6%' THEN 12.6 END::DOUBLE, 6) AS percent,
       CASE WHEN incline IS NULL THEN 'missing' WHEN incline IN ('up', 'down') THEN 'qualitative' WHEN incline = 'abc' THEN 'invalid' ELSE 'numeric' END AS kind FROM net_ways""",
)
def incline(spark, d):
    i = normalize.parse_incline("incline")
    return view(spark, d, "net_ways").select("id", F.round(i["percent"], 6).alias("percent"), i["kind"].alias("kind"))


@query(
    "age_of_features",
    f"""SELECT id, rev_day || '-' || rev_month || '-' || rev_year AS last_update,
        round(date_diff('day', make_date(rev_year::INT, rev_month::INT, rev_day::INT), DATE '{AS_OF}') / 365.25, 6)::DOUBLE AS age, n_revs FROM net_ways""",
)
def age(spark, d):
    w = view(spark, d, "net_ways")
    v = w.select(F.col("id").alias("osmid"), "n_revs", "rev_day", "rev_month", "rev_year")
    return E.attach_versioning(w.select("id"), v, AS_OF).withColumn("age", F.round("age", 6))


@query("split_layers", f"SELECT layer, count(*) AS n FROM (SELECT {LAYER} AS layer FROM net_ways WHERE highway IN ('footway', 'steps', 'path') OR footway IS NOT NULL) t GROUP BY layer")
def split_layers(spark, d):
    return E.split_layers(E.exclude_features(view(spark, d, "net_ways"))).groupBy("layer").agg(F.count("*").alias("n"))


@query("footway_classes", "SELECT CASE highway WHEN 'steps' THEN 'stairways' WHEN 'footway' THEN 'main_footways' WHEN 'path' THEN 'potential_footways' END AS footway_class, count(*) AS n FROM net_ways GROUP BY 1")
def footway_classes(spark, d):
    return E.split_other_footways(ways(spark, d)).groupBy("footway_class").agg(F.count("*").alias("n"))


@query(
    "categorical_surface",
    f"""SELECT sum(n)::BIGINT AS total, coalesce(sum(n) FILTER (WHERE v <> '?'), 0)::BIGINT AS known, coalesce(sum(n) FILTER (WHERE v = '?'), 0)::BIGINT AS unknown,
        arg_max(v, n) FILTER (WHERE v <> '?') AS dominant, round(-sum(CASE WHEN v <> '?' THEN n / k * ln(n / k) END), 4) AS entropy, count(*) FILTER (WHERE v <> '?') AS n_values
        FROM (SELECT v, count(*)::DOUBLE AS n, sum(CASE WHEN v <> '?' THEN count(*) END) OVER ()::DOUBLE AS k FROM (SELECT {_LABEL.format("surface")} AS v FROM net_ways) t GROUP BY v) u""",
)
def categorical(spark, d):
    s = A.categorical_summary(view(spark, d, "net_ways"), "surface")
    return s.select("total", "known", "unknown", "dominant", F.round("entropy", 4).alias("entropy"), F.size("values").cast("long").alias("n_values"))


@query(
    "numeric_revisions",
    """SELECT count(*) FILTER (WHERE v IS NULL) AS unknown, count(*) FILTER (WHERE v < 2) AS invalid, count(*) FILTER (WHERE v >= 2) AS valid,
       count(*) FILTER (WHERE v >= 2 AND v < 5) AS bin_0, count(*) FILTER (WHERE v >= 5 AND v < 10) AS bin_1, count(*) FILTER (WHERE v >= 10) AS bin_2,
       min(v) FILTER (WHERE v >= 2) AS least, max(v) FILTER (WHERE v >= 2) AS greatest, round(avg(v) FILTER (WHERE v >= 2), 6) AS mean, round(quantile_cont(v, 0.5) FILTER (WHERE v >= 2), 6) AS median
       FROM (SELECT n_revs::DOUBLE AS v FROM net_ways) t""",
)
def numeric(spark, d):
    s = A.numeric_summary(view(spark, d, "net_ways"), "n_revs", [2, 5, 10], invalid_below=2)
    return s.select("unknown", "invalid", "valid", *[F.col("bins")[i].alias(f"bin_{i}") for i in range(3)], "least", "greatest", "mean", "median")


@query(
    "box_revisions_by_highway",
    """SELECT highway AS "by", count(*) AS n, min(v) AS least, max(v) AS greatest, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
       FROM (SELECT highway, n_revs::DOUBLE AS v FROM net_ways) t GROUP BY 1""",
)
def box(spark, d):
    return A.box_hist(view(spark, d, "net_ways"), "n_revs", "highway").select("by", "n", "least", "greatest", "q1", "median", "q3")


@query(
    "surface_tail",
    f"""SELECT CASE WHEN v = '?' THEN 'Unknown' WHEN r <= 4 THEN v ELSE 'Other known' END AS name, sum(n)::BIGINT AS n, count(*) AS "values"
        FROM (SELECT v, n, row_number() OVER (PARTITION BY v = '?' ORDER BY n DESC, v) AS r FROM (SELECT {_LABEL.format("surface")} AS v, count(*) AS n FROM net_ways GROUP BY 1) t) u GROUP BY 1""",
)
def tail(spark, d):
    counts = view(spark, d, "net_ways").groupBy(A.label(F.col("surface")).alias("value")).agg(F.count("*").alias("n"))
    return A.collapse_tail(counts, 4).drop("place")


def _tagged(spark, d):
    tags = F.map_filter(F.create_map(*[x for c in ("surface", "smoothness", "width", "incline", "crossing", "wheelchair") for x in (F.lit(c), F.col(c))]), lambda k, v: v.isNotNull())
    return ways(spark, d).withColumn("tags", tags)


_ISSUES = f"""FROM (
  SELECT {LAYER} AS layer, 'replaceable_values' AS category, id FROM net_ways WHERE footway = 'crossing' AND crossing = 'zebra'
  UNION ALL SELECT {LAYER}, 'missing_tags', id FROM net_ways WHERE surface IS NULL
  UNION ALL SELECT {LAYER}, 'older_than_five_years', id FROM net_ways WHERE date_diff('day', make_date(rev_year::INT, rev_month::INT, rev_day::INT), DATE '{AS_OF}') / 365.25 >= 5
  UNION ALL SELECT {LAYER}, 'wrong_mispelled_or_unlisted_values', id FROM net_ways WHERE footway = 'sidewalk' AND surface <> '' AND surface NOT IN ('asphalt', 'concrete', 'sett', 'sand', 'grass', 'paving_stones', 'gravel')
) t"""


def _issues(spark, d):
    rows = _tagged(spark, d)
    accepted = {"sidewalks": {"surface": ["asphalt", "concrete", "sett", "sand", "grass", "paving_stones", "gravel"]}}
    aged = rows.withColumn("age", normalize.age_years("rev_year", "rev_month", "rev_day", AS_OF))
    return Q.dq_issues(Q.tag_issues(rows, accepted), Q.outdated(aged))


@query("dq_totals", f"SELECT coalesce(category, '(all)') AS category, coalesce(layer, '(all)') AS layer, count(*) AS n {_ISSUES} GROUP BY CUBE (category, layer)")
def dq_totals(spark, d):
    return Q.dq_totals(_issues(spark, d))


@query("dq_issue_sets", f"SELECT id, count(DISTINCT category) AS n_categories, count(DISTINCT layer) AS n_layers {_ISSUES} GROUP BY id")
def dq_issue_sets(spark, d):
    points = ways(spark, d).select("id", "element", F.col("coords")[0]["lon"].alias("lon"), F.col("coords")[0]["lat"].alias("lat"))
    return Q.issue_points(_issues(spark, d), points).select("id", F.size("categories").cast("long").alias("n_categories"), F.size("layers").cast("long").alias("n_layers"))


def _ends(df):
    return df.select("*", *[F.col("coords")[i][c].alias(f"e{c}{i}") for i in (0, 1) for c in ("lon", "lat")]).drop("lon0", "lat0", "lon1", "lat1").withColumnsRenamed({f"e{c}{i}": f"{c}{i}" for i in (0, 1) for c in ("lon", "lat")})


def _crossings(spark, d):
    return _ends(ways(spark, d).where("layer = 'crossings'")).select("element", "id", "surface", "lon0", "lat0", "lon1", "lat1")


def _kerbs(spark, d):
    k = view(spark, d, "net_kerbs")
    return k.select("element", "id", "kerb", "tactile_paving", *[F.col(c).cast("double").alias(f"{c}{i}") for i in (0, 1) for c in ("lon", "lat")])


_ENDS_SQL = """SELECT id, round((lon0 + 49.30) / 0.0005)::INT AS x, round((lat0 + 25.47) / 0.0005)::INT AS y FROM net_ways WHERE footway = 'crossing'
  UNION SELECT id, round((lon1 + 49.30) / 0.0005)::INT, round((lat1 + 25.47) / 0.0005)::INT FROM net_ways WHERE footway = 'crossing'"""
_KERB_SQL = "SELECT id AS kerb, round((lon + 49.30) / 0.0005)::INT AS x, round((lat + 25.47) / 0.0005)::INT AS y FROM net_kerbs"


@query("crossings_lacking_kerbs", f"SELECT c.id, count(k.kerb) AS n_kerbs FROM ({_ENDS_SQL}) c LEFT JOIN ({_KERB_SQL}) k USING (x, y) GROUP BY c.id HAVING count(k.kerb) < 2")
def lacking(spark, d):
    return S.crossings_lacking_kerbs(_crossings(spark, d), _kerbs(spark, d)).select("id", "n_kerbs")


@query("kerbs_without_crossing", f"SELECT kerb AS id FROM ({_KERB_SQL}) k WHERE NOT EXISTS (SELECT 1 FROM ({_ENDS_SQL}) c WHERE c.x = k.x AND c.y = k.y)")
def kerbs_without(spark, d):
    return S.kerbs_without_crossing(_kerbs(spark, d), _crossings(spark, d)).select("id")


@query("kerb_crossing_pairs", f"SELECT k.kerb AS kerb_id, c.id AS crossing_id FROM ({_KERB_SQL}) k JOIN ({_ENDS_SQL}) c USING (x, y)")
def pairs(spark, d):
    return S.distance_join(_kerbs(spark, d), _crossings(spark, d), 2.0).select(F.col("l_id").alias("kerb_id"), F.col("r_id").alias("crossing_id"))


@query("crossing_context", f"SELECT c.id, count(k.kerb) AS n_states FROM ({_ENDS_SQL}) c LEFT JOIN ({_KERB_SQL}) k USING (x, y) GROUP BY c.id")
def context(spark, d):
    sidewalks = _ends(ways(spark, d).where("layer = 'sidewalks'")).select("element", "id", "surface", "lon0", "lat0", "lon1", "lat1")
    c = S.crossing_context(_crossings(spark, d), _kerbs(spark, d), sidewalks)
    return c.select("id", F.coalesce(F.size("associated_transition_states"), F.lit(0)).cast("long").alias("n_states")).withColumn("n_states", F.greatest("n_states", F.lit(0)))


_TX = "floor(({0} + 180) / 360 * 32768)::BIGINT"
_TY = "floor((1 - asinh(tan(radians({0}))) / pi()) / 2 * 32768)::BIGINT"


@query(
    "tile_features",
    f"""SELECT x, y, count(*) AS n, count(*) FILTER (WHERE surface IS NOT NULL AND surface NOT IN ('', '?')) AS n_surface FROM (
        SELECT surface, unnest(range({_TX.format("least(a, c)")}, {_TX.format("greatest(a, c)")} + 1)) AS x, y FROM (
        SELECT surface, a, c, unnest(range({_TY.format("greatest(b, e)")}, {_TY.format("least(b, e)")} + 1)) AS y
        FROM (SELECT surface, lon0::DOUBLE AS a, lat0::DOUBLE AS b, lon1::DOUBLE AS c, lat1::DOUBLE AS e FROM net_ways) w) t) u GROUP BY x, y""",
)
def tile_features(spark, d):
    return K.attribute_completeness(_ends(ways(spark, d)), 15, ["surface"])


@query("completeness")
def completeness(spark, d):
    w = _ends(ways(spark, d))
    return K.completeness_snapshot(w.where("highway = 'path'"), w.where("layer <> 'crossings'"), w.where("layer = 'sidewalks'"), ZONE)


@query("daily_activity", """SELECT layer, CAST(ts AS DATE) AS date, count(*) FILTER (WHERE creation) AS additions, count(*) FILTER (WHERE tag_change OR geometry_change) AS modifications, count(*) FILTER (WHERE deletion) AS deletions,
       count(*) FILTER (WHERE creation) + count(*) FILTER (WHERE tag_change OR geometry_change) + count(*) FILTER (WHERE deletion) AS count FROM net_changes GROUP BY 1, 2""")
def daily(spark, d):
    return C.daily_activity(view(spark, d, "net_changes"))


@query("daily_pivot", """SELECT date, coalesce(layer, 'Total') AS layer, sum(n)::BIGINT AS count FROM (SELECT CAST(ts AS DATE) AS date, layer,
       (creation::INT + (tag_change OR geometry_change)::INT + deletion::INT) AS n FROM net_changes) t GROUP BY GROUPING SETS ((date), (date, layer))""")
def daily_pivot(spark, d):
    return C.daily_pivot(C.daily_activity(view(spark, d, "net_changes")))


@query("retained_days", "SELECT layer, date FROM (SELECT layer, date, dense_rank() OVER (PARTITION BY layer ORDER BY date DESC) AS r FROM (SELECT DISTINCT layer, CAST(ts AS DATE) AS date FROM net_changes) t) u WHERE r <= 5")
def retained(spark, d):
    return C.retain(C.daily_activity(view(spark, d, "net_changes")), 5).select("layer", "date")


@query("changeset_activity", """SELECT changeset_id, count(*) FILTER (WHERE creation) AS additions, count(*) FILTER (WHERE tag_change OR geometry_change) AS modifications, count(*) FILTER (WHERE deletion) AS deletions,
       count(*) FILTER (WHERE creation) + count(*) FILTER (WHERE tag_change OR geometry_change) + count(*) FILTER (WHERE deletion) AS total FROM net_changes GROUP BY 1
       HAVING count(*) FILTER (WHERE creation OR tag_change OR geometry_change OR deletion) > 0""")
def changesets(spark, d):
    return C.changeset_activity(view(spark, d, "net_changes"))


@query("top_deletions", "SELECT changeset_id, count(*) AS deletions FROM net_changes WHERE deletion AND ts <= TIMESTAMP '2030-01-01' AND ts >= TIMESTAMP '2030-01-01' - INTERVAL 5000 DAY GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def top_deletions(spark, d):
    return C.top_deletions(view(spark, d, "net_changes"), "2030-01-01", days=5000)


@query("apply_changes_latest", """SELECT id, value FROM (SELECT id, deletion, value, row_number() OVER (PARTITION BY id ORDER BY ts DESC, deletion DESC, event_id DESC) AS r FROM net_changes WHERE creation OR tag_change OR geometry_change OR deletion) t WHERE r = 1 AND NOT deletion
       UNION ALL SELECT id, -1.0::DOUBLE FROM net_ways WHERE id NOT IN (SELECT id FROM net_changes WHERE creation OR tag_change OR geometry_change OR deletion)""")
def apply_latest(spark, d):
    base = view(spark, d, "net_ways").select("element", "id", F.lit(-1.0).alias("value"))
    return C.apply_changes(base, view(spark, d, "net_changes")).select("id", "value")


@query("last_change", "SELECT element, id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY element, id ORDER BY event_id DESC) AS r FROM net_changes) t WHERE r = 1")
def last_change(spark, d):
    rows = view(spark, d, "net_changes").select("element", "id", "event_id", "value").withColumn("position", F.col("event_id"))
    return E.keep_last(rows).select("element", "id", "event_id", "value")


_KEYS = "floor({0}::DOUBLE / 1e-5 + 0.5)::BIGINT"


def _lines(spark, d):
    return ways(spark, d).withColumns({"position": F.col("id"), "length_m": geo.haversine_m(*[F.col("coords")[i][c] for i in (0, 1) for c in ("lon", "lat")])})


@query("graph_vertices", f"SELECT DISTINCT {_KEYS.format('lon0')} AS kx, {_KEYS.format('lat0')} AS ky FROM net_ways UNION SELECT DISTINCT {_KEYS.format('lon1')}, {_KEYS.format('lat1')} FROM net_ways")
def vertices(spark, d):
    return N.build_vertices(_lines(spark, d)).select("kx", "ky")


def _edges(spark, d):
    g = G.compact_grades(G.grade_features(G.prepare_features(_lines(spark, d))))
    return N.build_edges(g, N.build_vertices(g))


@query("graph_degrees", f"""SELECT degree, count(*) AS n FROM (SELECT a, count(DISTINCT b)::INTEGER AS degree FROM (
       SELECT ({_KEYS.format("lon0")}, {_KEYS.format("lat0")}) AS a, ({_KEYS.format("lon1")}, {_KEYS.format("lat1")}) AS b FROM net_ways
       UNION ALL SELECT ({_KEYS.format("lon1")}, {_KEYS.format("lat1")}), ({_KEYS.format("lon0")}, {_KEYS.format("lat0")}) FROM net_ways) t WHERE a <> b GROUP BY a) u GROUP BY degree""")
def degrees(spark, d):
    from pednet.policies.profiles import DISTANCE

    lines = _lines(spark, d)
    return N.to_csr(N.build_edges(lines, N.build_vertices(lines), (DISTANCE,))).groupBy("degree").agg(F.count("*").alias("n"))


_LATTICE = """SELECT DISTINCT a, b FROM (SELECT unnest([p, q]) AS a, unnest([q, p]) AS b FROM (
  SELECT round((lon0 + 49.30) / 0.0005)::BIGINT * 100000 + round((lat0 + 25.47) / 0.0005)::BIGINT AS p, round((lon1 + 49.30) / 0.0005)::BIGINT * 100000 + round((lat1 + 25.47) / 0.0005)::BIGINT AS q FROM net_ways) t) u"""


@query("graph_components", f"""WITH RECURSIVE e AS MATERIALIZED ({_LATTICE}), c(v, label) USING KEY (v) AS (SELECT DISTINCT a, a FROM e UNION
       (SELECT e.b, min(c.label) FROM c JOIN e ON c.v = e.a JOIN recurring.c AS r ON r.v = e.b WHERE c.label < r.label GROUP BY e.b))
       SELECT vertices, count(*) AS n FROM (SELECT label, count(*) AS vertices FROM c GROUP BY label) t GROUP BY vertices""")
def graph_components(spark, d):
    from pednet.policies.profiles import DISTANCE

    lines = _lines(spark, d)
    c = N.connected_components(N.build_edges(lines, N.build_vertices(lines), (DISTANCE,)))
    return c.groupBy("label").agg(F.count("*").alias("vertices")).groupBy("vertices").agg(F.count("*").alias("n"))


def _graph(spark, d):
    """Vertices and edges by distance; pairs between vertices of the lattice."""
    from pednet.operators.shared import checkpointed
    from pednet.policies.profiles import DISTANCE

    lines = _lines(spark, d)
    v = checkpointed(N.build_vertices(lines))
    return v, checkpointed(N.build_edges(lines, v, (DISTANCE,)))


_STEP_M = """2 * 6371008.8 * asin(sqrt(power(sin(radians(y2 - y1) / 2), 2) + cos(radians(y1)) * cos(radians(y2)) * power(sin(radians(x2 - x1) / 2), 2)))"""


@query("routes", f"""WITH RECURSIVE e AS MATERIALIZED (SELECT a, b, {_STEP_M} AS w FROM (SELECT a, b, -49.30 + a // 100000 * 0.0005::DOUBLE AS x1, -25.47 + a % 100000 * 0.0005::DOUBLE AS y1, -49.30 + b // 100000 * 0.0005::DOUBLE AS x2, -25.47 + b % 100000 * 0.0005::DOUBLE AS y2 FROM ({_LATTICE}) x) y),
       q AS MATERIALIZED (SELECT od_id, floor((lon_a::DOUBLE + 49.30) / 0.0005)::BIGINT * 100000 + floor((lat_a::DOUBLE + 25.47) / 0.0005)::BIGINT AS s, floor((lon_b::DOUBLE + 49.30) / 0.0005)::BIGINT * 100000 + floor((lat_b::DOUBLE + 25.47) / 0.0005)::BIGINT AS t FROM net_od),
       z(od_id, v, m, n) USING KEY (od_id, v) AS (SELECT od_id, s, 0.0::DOUBLE, 0 FROM q WHERE s IN (SELECT a FROM e) UNION
       (SELECT z.od_id, e.b, min(z.m + e.w), arg_min(z.n + 1, z.m + e.w) FROM z JOIN e ON e.a = z.v LEFT JOIN recurring.z AS r ON r.od_id = z.od_id AND r.v = e.b WHERE r.v IS NULL OR z.m + e.w < r.m GROUP BY z.od_id, e.b))
       SELECT q.od_id, round(m, 3) AS cost, n::INT AS edges FROM q LEFT JOIN z ON z.od_id = q.od_id AND z.v = q.t WHERE q.s IN (SELECT a FROM e) AND q.t IN (SELECT a FROM e)""")
def routes(spark, d):
    v, e = _graph(spark, d)
    od = view(spark, d, "net_od")
    at = v.select("vertex", "kx", "ky")
    key = lambda a, b: [F.floor((F.floor((F.col(c).cast("double") - o) / 0.0005) * 0.0005 + o) / geo.TOLERANCE + 0.5).cast("long").alias(k) for c, o, k in ((a, -49.30, "kx"), (b, -25.47, "ky"))]
    src = od.select("od_id", *key("lon_a", "lat_a")).join(at, ["kx", "ky"]).select("od_id", F.col("vertex").alias("src"))
    dst = od.select("od_id", *key("lon_b", "lat_b")).join(at, ["kx", "ky"]).select("od_id", F.col("vertex").alias("dst"))
    return P.route_batch(src.join(dst, "od_id"), e, cells=V.nested_cells(v)).select("od_id", F.round("cost", 3).alias("cost"), "edges")


@query("routes_between_places")
def routes_between_places(spark, d):
    v, e = _graph(spark, d)
    od = view(spark, d, "net_od").select("od_id", *[F.col(c).cast("double").alias(c) for c in ("lon_a", "lat_a", "lon_b", "lat_b")])
    return P.route_points(od, e, v, cells=V.nested_cells(v)).select("od_id", F.round("cost", 3).alias("cost"), F.round("distance_m", 3).alias("distance_m"), F.size("path").alias("places"))


@query("profile_audit")
def profile_audit(spark, d):
    return G.profile_audit(G.compact_grades(G.grade_features(G.prepare_features(G.alike(ways(spark, d))))))


@query("edge_weights")
def edge_weights(spark, d):
    e = _edges(spark, d)
    return e.agg(F.count("*").alias("edges"), *[F.count_if(F.col(c) < float("inf")).alias(f"open_{c}") for c in e.columns if c.startswith("w_")])


@query("terrain_slope", """SELECT px, py, round(sqrt(power(coalesce(dx, 0) / (0.0003 * 111320.0 * cos(radians(-25.4 - (py + 0.5) * 0.0003))), 2) + power(coalesce(dy, 0) / (0.0003 * 110574.0), 2)) * 100, 6) AS slope_percent
       FROM (SELECT px, py, (coalesce(lead(elev) OVER r, elev) - coalesce(lag(elev) OVER r, elev)) / nullif(coalesce(lead(px) OVER r, px) - coalesce(lag(px) OVER r, px), 0) AS dx,
       (coalesce(lead(elev) OVER c, elev) - coalesce(lag(elev) OVER c, elev)) / nullif(coalesce(lead(py) OVER c, py) - coalesce(lag(py) OVER c, py), 0) AS dy
       FROM (SELECT px, py, elev::DOUBLE AS elev FROM net_dem) e WINDOW r AS (PARTITION BY py ORDER BY px), c AS (PARTITION BY px ORDER BY py)) t""")
def terrain_slope(spark, d):
    dem = view(spark, d, "net_dem").withColumn("elev", F.col("elev").cast("double"))
    return R.slope_percent(dem, -25.4, 0.0003).select("px", "py", F.round("slope_percent", 6).alias("slope_percent"))


@query("terrain_classes", """WITH e AS (SELECT px, py, elev::DOUBLE AS h FROM net_dem),
       a AS (SELECT e.px, e.py, sum(n.h * exp(-power(n.px - e.px, 2) / 2.0::DOUBLE)) / sum(exp(-power(n.px - e.px, 2) / 2.0::DOUBLE)) AS h FROM e JOIN e n ON n.py = e.py AND n.px BETWEEN e.px - 3 AND e.px + 3 GROUP BY 1, 2),
       b AS (SELECT a.px, a.py, sum(n.h * exp(-power(n.py - a.py, 2) / 2.0::DOUBLE)) / sum(exp(-power(n.py - a.py, 2) / 2.0::DOUBLE)) AS h FROM a JOIN a n ON n.px = a.px AND n.py BETWEEN a.py - 3 AND a.py + 3 GROUP BY 1, 2),
       s AS (SELECT sqrt(power(coalesce(dx, 0) / (0.0003::DOUBLE * 111320 * cos(radians(-25.4 - (py + 0.5) * 0.0003))), 2) + power(coalesce(dy, 0) / (0.0003::DOUBLE * 110574), 2)) * 100 AS slope FROM (
       SELECT px, py, (coalesce(lead(h) OVER r, h) - coalesce(lag(h) OVER r, h)) / nullif(coalesce(lead(px) OVER r, px) - coalesce(lag(px) OVER r, px), 0) AS dx, (coalesce(lead(h) OVER c, h) - coalesce(lag(h) OVER c, h)) / nullif(coalesce(lead(py) OVER c, py) - coalesce(lag(py) OVER c, py), 0) AS dy
       FROM b WINDOW r AS (PARTITION BY py ORDER BY px), c AS (PARTITION BY px ORDER BY py)) t)
       SELECT (slope > 2)::INT + (slope > 5)::INT + (slope > 8.33)::INT + (slope > 12.5)::INT AS terrain, count(*) AS n FROM s GROUP BY 1""")
def terrain_classes(spark, d):
    dem = view(spark, d, "net_dem").withColumn("elev", F.col("elev").cast("double"))
    return R.terrain(dem, 1.0, -25.4, 0.0003).groupBy("terrain").agg(F.count("*").alias("n"))


_SQUARE = geo.square(-25.45, -49.28, 1000)


@query("in_square", f"""SELECT id, {LAYER} AS layer FROM net_ways WHERE least(lon0, lon1)::DOUBLE <= {_SQUARE[2]}::DOUBLE AND greatest(lon0, lon1)::DOUBLE >= {_SQUARE[0]}::DOUBLE
       AND least(lat0, lat1)::DOUBLE <= {_SQUARE[3]}::DOUBLE AND greatest(lat0, lat1)::DOUBLE >= {_SQUARE[1]}::DOUBLE""")
def in_square(spark, d):
    w, s, e, n = geo.square(-25.45, -49.28, 1000)
    b = geo.bounds("coords")
    rows = ways(spark, d).select("*", b["xmin"].alias("xmin"), b["ymin"].alias("ymin"), b["xmax"].alias("xmax"), b["ymax"].alias("ymax"))
    return geo.in_bounds(rows, w, s, e, n).select("id", "layer")


@query("feature_keys", f"""SELECT layer, key, count(*) AS n, count(DISTINCT value) AS n_values FROM (SELECT {LAYER} AS layer, unnest(['surface', 'smoothness', 'width', 'incline', 'crossing', 'wheelchair']) AS key,
       unnest([surface, smoothness, width, incline, crossing, wheelchair]) AS value FROM net_ways) t WHERE value IS NOT NULL GROUP BY 1, 2""")
def feature_keys(spark, d):
    return A.feature_keys(_tagged(spark, d))


@query("keyword_documents", "SELECT doc_id, CAST(contains(lower(text), 'the') AS INTEGER) + CAST(contains(lower(text), 'ción') AS INTEGER) AS n_keywords FROM documents WHERE contains(lower(text), 'the') OR contains(lower(text), 'ción')")
def keyword_documents(spark, d):
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.lit("").alias("title"), F.col("text").alias("description"))
    return E.keyword_match(docs, ["the", "Ción"]).select("doc_id", F.size("matched_keywords").alias("n_keywords"))


_BOX = (-49.29, -25.46, -49.27, -25.45)


@query("theme_smoothness", f"""SELECT count(*) AS total, count(*) FILTER (WHERE v <> '?') AS known, count(*) FILTER (WHERE v = '?') AS unknown, 'count' AS measure, 'ok' AS status
       FROM (SELECT {_LABEL.format("smoothness")} AS v FROM net_ways) t""")
def theme(spark, d):
    return T.theme_summary(ways(spark, d), "smoothness").select("total", "known", "unknown", "measure", "status")


@query("viewport_layers", f"""SELECT count(*) AS total, count(DISTINCT layer) AS n_values FROM (SELECT {LAYER} AS layer, lon0::DOUBLE AS a, lat0::DOUBLE AS b, lon1::DOUBLE AS c, lat1::DOUBLE AS e FROM net_ways) t
       WHERE greatest(a, c) >= {_BOX[0]}::DOUBLE AND least(a, c) <= {_BOX[2]}::DOUBLE AND greatest(b, e) >= {_BOX[1]}::DOUBLE AND least(b, e) <= {_BOX[3]}::DOUBLE""")
def viewport(spark, d):
    rows = _ends(ways(spark, d)).withColumn("position", F.col("id"))
    return T.viewport_theme(rows, "footway_categories", _BOX).select("total", F.size("values").cast("long").alias("n_values"))


@query("masked_pixels", "SELECT px // 4 AS px, py // 4 AS py, round(avg(elev::DOUBLE), 6) AS elev FROM net_dem WHERE px BETWEEN 10 AND 29 AND py BETWEEN 5 AND 14 GROUP BY 1, 2")
def masked(spark, d):
    ring = X.square_ring(-49.3 + 10 * 0.0003, -25.4 - 15 * 0.0003, -49.3 + 30 * 0.0003, -25.4 - 5 * 0.0003)
    dem = view(spark, d, "net_dem").withColumn("elev", F.col("elev").cast("double"))
    return X.downsample(X.mask_to_boundary(dem, ring, -49.3, -25.4, 0.0003), 4).select("px", "py", F.round("elev", 6).alias("elev"))

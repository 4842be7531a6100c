"""Adapter views: the driver's tables seen as a pedestrian network. The SQL runs in Spark and in DuckDB alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WAYS = """
SELECT o_orderkey AS id, 'way' AS element, k10,
  CASE WHEN k10 < 6 THEN 'sidewalk' WHEN k10 < 8 THEN 'crossing' END AS footway,
  CASE WHEN k10 = 8 THEN 'steps' WHEN k10 = 9 THEN 'path' ELSE 'footway' END AS highway,
  CASE o_custkey % 12 WHEN 0 THEN 'asphalt' WHEN 1 THEN 'concrete' WHEN 2 THEN ' Asphalt ' WHEN 3 THEN '?'
    WHEN 4 THEN NULL WHEN 5 THEN 'sett' WHEN 6 THEN 'sand' WHEN 7 THEN 'grass' WHEN 8 THEN 'paving_stones'
    WHEN 9 THEN 'betão' WHEN 10 THEN 'gravel' ELSE 'concrete' END AS surface,
  CASE o_custkey % 9 WHEN 0 THEN 'excellent' WHEN 1 THEN 'good' WHEN 2 THEN 'intermediate' WHEN 3 THEN 'bad'
    WHEN 4 THEN 'very_bad' WHEN 5 THEN 'horrible' WHEN 6 THEN 'impassable' WHEN 7 THEN NULL ELSE '?' END AS smoothness,
  CASE o_orderkey % 8 WHEN 0 THEN '1.5' WHEN 1 THEN '1,25 m' WHEN 2 THEN '4''6"' WHEN 3 THEN '1.5;0.9'
    WHEN 4 THEN '90 cm' WHEN 5 THEN '?' WHEN 6 THEN '6 ft' END AS width,
  CASE o_orderkey % 9 WHEN 0 THEN '5%' WHEN 1 THEN '-10%' WHEN 2 THEN '5°' WHEN 3 THEN 'up' WHEN 4 THEN 'down'
    WHEN 5 THEN '0%' WHEN 6 THEN '12.6%' WHEN 7 THEN 'abc' END AS incline,
  CASE o_orderkey % 5 WHEN 0 THEN '1%' WHEN 1 THEN '2.5%' WHEN 2 THEN '6%' END AS incline_across,
  CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN NULL ELSE 'limited' END AS wheelchair,
  CASE WHEN k10 IN (6,7) THEN CASE o_custkey % 4 WHEN 0 THEN 'zebra' WHEN 1 THEN 'unmarked' WHEN 2 THEN 'traffic_signals' END END AS crossing,
  year(o_orderdate) AS rev_year, month(o_orderdate) AS rev_month, day(o_orderdate) AS rev_day,
  (o_custkey % 20) + 1 AS n_revs,
  -49.30 + gx * 0.0005 AS lon0, -25.47 + gy * 0.0005 AS lat0,
  -49.30 + (gx + CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 0 END) * 0.0005 AS lon1,
  -25.47 + (gy + CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE 1 END) * 0.0005 AS lat1
FROM (SELECT *, o_orderkey % 10 AS k10, o_orderkey % 120 AS gx, CAST(floor(o_orderkey / 120) AS BIGINT) AS gy FROM orders) t
"""
KERBS = """
SELECT 2 * c_custkey + e AS id, 'node' AS element, 'kerb' AS barrier,
  CASE c_nationkey % 6 WHEN 0 THEN 'flush' WHEN 1 THEN 'lowered' WHEN 2 THEN 'raised' WHEN 3 THEN 'rolled' WHEN 4 THEN 'yes' END AS kerb,
  CASE c_nationkey % 4 WHEN 0 THEN 'no' WHEN 1 THEN 'yes' WHEN 2 THEN '?' END AS tactile_paving,
  CASE WHEN e = 0 THEN lon0 ELSE lon1 END AS lon, CASE WHEN e = 0 THEN lat0 ELSE lat1 END AS lat
FROM customer JOIN net_ways ON net_ways.id = 10 * c_custkey + 6
CROSS JOIN (SELECT 0 AS e UNION ALL SELECT 1 AS e) x
WHERE e = 0 OR c_nationkey % 2 = 0
"""
CHANGES = """
SELECT event_id, ts, 'way' AS element, event_id % 3000 AS id,
  CASE event_id % 4 WHEN 0 THEN 'sidewalks' WHEN 1 THEN 'crossings' WHEN 2 THEN 'kerbs' ELSE 'other_footways' END AS layer,
  event_type = 'signup' AS creation, event_type IN ('click', 'purchase') AS tag_change,
  event_type = 'view' AS geometry_change, event_type = 'error' AS deletion,
  user_id AS changeset_id, value
FROM events
"""
DEM = "SELECT p_partkey % 50 AS px, CAST(floor(p_partkey / 50) AS BIGINT) AS py, p_retailprice * 0.1 + p_size * 0.05 AS elev FROM part"
OD = """
SELECT s_suppkey AS od_id, -49.2999 + (s_suppkey % 100) * 0.0005 AS lon_a, -25.4699 + (s_nationkey % 10) * 0.0005 AS lat_a,
  -49.2999 + ((s_suppkey % 100) + 3) * 0.0005 AS lon_b, -25.4699 + ((s_nationkey % 10) + 2) * 0.0005 AS lat_b FROM supplier
"""

#: name: (SQL, driver tables it reads)
VIEWS = {"net_ways": (WAYS, ("orders",)), "net_kerbs": (KERBS, ("customer", "orders")), "net_changes": (CHANGES, ("events",)), "net_dem": (DEM, ("part",)), "net_od": (OD, ("supplier",))}

LAYER = "CASE WHEN footway = 'sidewalk' THEN 'sidewalks' WHEN footway = 'crossing' THEN 'crossings' ELSE 'other_footways' END"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An adapter view as a DataFrame over the driver's Parquet tables."""
    sql, tables = VIEWS[name]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    if name == "net_kerbs":
        frames["net_ways"] = view(spark, sf_dir, "net_ways")
    for t in frames:
        sql = sql.replace(f" {t} ", f" {{{t}}} ") if f" {t} " in sql else sql
        sql = sql.replace(f"FROM {t})", f"FROM {{{t}}})").replace(f"FROM {t}\n", f"FROM {{{t}}}\n")
        if sql.endswith(f"FROM {t}"):
            sql = sql[: -len(t)] + f"{{{t}}}"
    sql = sql.replace("net_ways.id", "w.id").replace("JOIN {net_ways} ON", "JOIN {net_ways} w ON")
    return spark.sql(sql, **{t: f for t, f in frames.items() if f"{{{t}}}" in sql})


def ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ways with layer, edge kind and coordinates."""
    from pyspark.sql import functions as F

    from pednet.functions.normalize import edge_kind

    w = view(spark, sf_dir, "net_ways").withColumn("layer", F.expr(LAYER))
    point = lambda i: F.struct(F.col(f"lon{i}").cast("double").alias("lon"), F.col(f"lat{i}").cast("double").alias("lat"))
    return w.withColumns({"edge_kind": edge_kind("layer", "highway"), "coords": F.array(point(0), point(1)), "geom_type": F.lit("LineString")})


def with_views(sql: str) -> str:
    """DuckDB SQL with the adapter views it names as common table expressions."""
    names = [n for n in VIEWS if n in sql or (n == "net_ways" and "net_kerbs" in sql)]
    more = sql.lstrip().removeprefix("WITH ")
    loops = more.startswith("RECURSIVE ")
    more = more.removeprefix("RECURSIVE ")
    return "WITH " + "RECURSIVE " * loops + ",\n".join(f"{n} AS ({VIEWS[n][0]})" for n in names) + (",\n" if more != sql.lstrip() else "\n") + more

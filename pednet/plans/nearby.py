"""Registered queries of nearest neighbours, ranks of vertices, sketches of tiles, and changes joined with closings as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from pednet.functions import geo
from pednet.operators import ranking, sketches
from pednet.operators.neighbours import knn_join
from pednet.operators.shared import shared_path
from pednet.plans.catalogue import _LATTICE, _STEP_M, _graph, query
from pednet.plans.evidence import EAST, NORTH, shifted_kerbs
from pednet.plans.network_views import view
from pednet.plans.streams import changes_stream
from pednet.streaming import feed

# --- nearest neighbours ---------------------------------------------------------------------------------------

NEIGHBOURS = 5
_KERBS = f"SELECT id, lon::DOUBLE + (id % {EAST[1]}) * {EAST[0]}::DOUBLE AS x1, lat::DOUBLE + (id % {NORTH[1]}) * {NORTH[0]}::DOUBLE AS y1 FROM net_kerbs"
_STARTS = "SELECT id, lon0::DOUBLE AS x2, lat0::DOUBLE AS y2 FROM net_ways WHERE footway = 'sidewalk'"


@query("nearest_sidewalks", f"""SELECT kerb AS kerb_id, rank::INT AS rank, id AS sidewalk_id, round(m, 4) AS distance_m FROM (
       SELECT *, row_number() OVER (PARTITION BY kerb ORDER BY round(m * 1e6)::BIGINT, id) AS rank FROM (SELECT k.id AS kerb, s.id, {_STEP_M} AS m FROM ({_KERBS}) k, ({_STARTS}) s) a) b WHERE rank <= {NEIGHBOURS}""")
def nearest_sidewalks(spark, d):
    """The five nearest starts of sidewalks of each kerb, however far."""
    k = shifted_kerbs(spark, d).select("id", F.col("lon0").alias("lon"), F.col("lat0").alias("lat"))
    s = view(spark, d, "net_ways").where("footway = 'sidewalk'").select("id", F.col("lon0").alias("lon"), F.col("lat0").alias("lat"))
    found = knn_join(k, s, NEIGHBOURS)
    return found.select(F.col("left_id").alias("kerb_id"), "rank", F.col("right_id").alias("sidewalk_id"), F.round("distance_m", 4).alias("distance_m"))


# --- ranks ----------------------------------------------------------------------------------------------------

ROUNDS = 12


@query("vertex_ranks", f"""WITH RECURSIVE e AS MATERIALIZED (SELECT a, b, w / sum(w) OVER (PARTITION BY a) AS share FROM (SELECT a, b, 1 / ({_STEP_M}) AS w FROM (
       SELECT a, b, -49.30 + a // 100000 * 0.0005::DOUBLE AS x1, -25.47 + a % 100000 * 0.0005::DOUBLE AS y1, -49.30 + b // 100000 * 0.0005::DOUBLE AS x2, -25.47 + b % 100000 * 0.0005::DOUBLE AS y2 FROM ({_LATTICE}) x) y) z),
       n AS MATERIALIZED (SELECT count(DISTINCT a)::DOUBLE AS n FROM e),
       r(i, v, rank) AS (SELECT DISTINCT 0, a, 1 / n FROM e, n UNION ALL SELECT i + 1, e.b, any_value(0.15 / n) + 0.85 * sum(rank * share) FROM r JOIN e ON e.a = r.v, n WHERE i < {ROUNDS} GROUP BY i + 1, e.b)
       SELECT v AS place, round(rank * n, 6) AS rank FROM r, n WHERE i = {ROUNDS}""")
def vertex_ranks(spark, d):
    """Ranks of the network's vertices, near neighbours weighing more, after a fixed number of rounds, times the number of vertices."""
    v, e = _graph(spark, d)
    ranks = ranking.rank_vertices(e.select("src", "dst", (1 / F.col("segment_m")).alias("weight")), tolerance=None, rounds=ROUNDS)
    place = F.round((F.col("lon") + 49.30) / 0.0005).cast("long") * 100_000 + F.round((F.col("lat") + 25.47) / 0.0005).cast("long")
    total = ranks.agg(F.count("*").alias("n"))
    return ranks.join(v.select("vertex", place.alias("place")), "vertex").crossJoin(F.broadcast(total)).select("place", F.round(F.col("rank") * F.col("n"), 6).alias("rank"))  # one row


# --- sketches -------------------------------------------------------------------------------------------------

#: Errors that the sketches keep to in all but one of some thousand tiles: relative for distinct keys, of ranks for quantiles.
DISTINCT_ERROR, RANK_ERROR = 0.06, 0.03
FROM_Z, TO_Z = 17, 12


def _places_of_changes(spark, d):
    """Changes where the ways that they change begin."""
    w = view(spark, d, "net_ways").select("id", F.col("lon0").cast("double").alias("lon"), F.col("lat0").cast("double").alias("lat"))
    return view(spark, d, "net_changes").select("id", "value", F.concat_ws("/", "changeset_id", F.to_date("ts")).alias("session")).join(w, "id")


@query("sketched_tiles", f"""SELECT z, x // (1 << (17 - z)::INT) AS x, y // (1 << (17 - z)::INT) AS y, count(*) AS n, count(DISTINCT session) AS sessions, TRUE AS distinct_within, TRUE AS median_within, TRUE AS p90_within FROM (
       SELECT concat_ws('/', changeset_id, CAST(ts AS DATE)) AS session, floor((lon0::DOUBLE + 180) / 360 * 131072)::BIGINT AS x, floor((1 - asinh(tan(radians(lat0::DOUBLE))) / pi()) / 2 * 131072)::BIGINT AS y
       FROM net_changes c JOIN net_ways w ON w.id = c.id) t, (SELECT unnest(range({TO_Z}, {FROM_Z + 1})) AS z) u GROUP BY 1, 2, 3""")
def sketched_tiles(spark, d):
    """Tiles of six zooms by merged sketches: whether the distinct sessions of change and the quantiles of values are within the sketches' stated errors
    of the exact ones, which are counted here beside them."""
    rows = _places_of_changes(spark, d)
    told = sketches.read_sketches(sketches.roll_up(sketches.tile_sketches(rows, FROM_Z, "session", "value"), FROM_Z, TO_Z), {"median": 0.5, "p90": 0.9})
    fine = rows.select("session", "value", geo.tile_x("lon", FROM_Z).alias("x"), geo.tile_y("lat", FROM_Z).alias("y"), F.explode(F.sequence(F.lit(TO_Z), F.lit(FROM_Z))).alias("z"))
    up = lambda c: F.expr(f"shiftright({c}, {FROM_Z} - z)")
    both = fine.withColumns({"x": up("x"), "y": up("y")}).join(told.withColumnRenamed("n", "told_n"), ["z", "x", "y"])
    share = lambda c: F.count_if(c) / F.nullif(F.count("value"), F.lit(0))
    near = lambda c, q: (share(F.col("value") < F.col(c)) <= q + RANK_ERROR) & (share(F.col("value") <= F.col(c)) >= q - RANK_ERROR)
    exact = F.count_distinct("session")
    out = both.groupBy("z", "x", "y").agg(F.max("told_n").alias("n"), exact.alias("sessions"), (F.abs(F.max("distinct") - exact) <= DISTINCT_ERROR * exact).alias("distinct_within"), near("median", 0.5).alias("median_within"), near("p90", 0.9).alias("p90_within"))
    return out.withColumn("z", F.col("z").cast("long"))


# --- two streams ----------------------------------------------------------------------------------------------

#: Sign-ups of a user are the closings of the changeset with that number.
_CLOSINGS = "(SELECT event_id AS closing_id, user_id AS changeset_id, ts AS closed FROM events WHERE event_type = 'signup')"
_MARK = f"(SELECT least((SELECT max(ts) FROM net_changes), (SELECT max(closed) FROM {_CLOSINGS} m)) - INTERVAL 1 DAY)"


@query("closed_changes", f"""SELECT c.event_id, k.closing_id FROM net_changes c LEFT JOIN {_CLOSINGS} k ON k.changeset_id = c.changeset_id AND k.closed BETWEEN c.ts AND c.ts + INTERVAL 6 HOUR
       WHERE k.closing_id IS NOT NULL OR c.ts + INTERVAL 6 HOUR < {_MARK}""")
def closed_changes(spark, d):
    """Changes with the closings of their changeset within six hours after, both as streams; those without any as far as the watermark has passed."""
    changes = changes_stream(spark, d).select("event_id", "ts", "changeset_id")
    events = spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).parquet(f"{d}/event[s].parquet")
    closings = events.where("event_type = 'signup'").select(F.col("event_id").alias("closing_id"), F.col("user_id").alias("changeset_id"), F.col("ts").cast("timestamp").alias("closed"))
    joined, path = feed.closings_of_changes(changes, closings), shared_path(spark, "closings")
    joined.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", shared_path(spark, "offsets")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(joined.schema).parquet(path).select("event_id", "closing_id")

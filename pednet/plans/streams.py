"""Registered queries over the change feed as a stream: what remains of it in tables, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from pednet.operators.shared import shared_path
from pednet.plans.catalogue import ORACLES, query
from pednet.plans.network_views import CHANGES, view
from pednet.streaming import feed


def changes_stream(spark, d):
    """net_changes as a stream of the events table's files (a pattern, as the table may be a single file)."""
    events = spark.readStream.schema(spark.read.parquet(f"{d}/events.parquet").schema).parquet(f"{d}/event[s].parquet")
    rows = spark.sql(CHANGES.replace("FROM events", "FROM {events}"), events=events)
    return rows.withColumns({"id": F.col("id").cast("long"), "ts": F.col("ts").cast("timestamp")})


@query("applied_stream", None)
def applied_stream(spark, d):
    """The ways after the feed: a base table by buckets, to which the stream's batches are applied."""
    base, path = view(spark, d, "net_ways").select("element", F.col("id").cast("long").alias("id"), F.lit(-1.0).alias("value")), shared_path(spark, "base")
    feed.write_base(base, path, 16)
    feed.apply_stream(changes_stream(spark, d), path, shared_path(spark, "offsets")).awaitTermination()
    return feed.newest(spark, path).select("id", "value")


ORACLES["applied_stream"] = ORACLES["apply_changes_latest"]

_FINAL = "(SELECT max(ts) FROM net_changes) - INTERVAL 1 DAY"


@query("final_days", f"""SELECT layer, CAST(ts AS DATE) AS date, count(*) FILTER (WHERE creation) AS additions, count(*) FILTER (WHERE tag_change OR geometry_change) AS modifications, count(*) FILTER (WHERE deletion) AS deletions,
       count(*) FILTER (WHERE creation OR tag_change OR geometry_change OR deletion) AS count FROM net_changes WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= {_FINAL} GROUP BY 1, 2""")
def final_days(spark, d):
    """Counts of each layer and day that the watermark has passed."""
    path = shared_path(spark, "days")
    feed.write_daily(changes_stream(spark, d), path, shared_path(spark, "offsets")).awaitTermination()
    out = spark.read.schema("layer string, additions long, modifications long, deletions long, count long, date date").parquet(path)
    return out.select("layer", "date", "additions", "modifications", "deletions", "count")


@query("final_sessions", f"""SELECT changeset_id, CAST(min(ts) AS VARCHAR) AS "start", CAST(max(ts) + INTERVAL 6 HOUR AS VARCHAR) AS "end", count(*) AS changes, count(*) FILTER (WHERE deletion) AS deletions FROM (
       SELECT *, sum(fresh) OVER (PARTITION BY changeset_id ORDER BY ts, event_id) AS nth FROM (
       SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY changeset_id ORDER BY ts, event_id) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM net_changes) a) b
       GROUP BY changeset_id, nth HAVING max(ts) + INTERVAL 6 HOUR <= {_FINAL}""")
def final_sessions(spark, d):
    """Sessions of each changeset that the watermark has passed; a pause of six hours ends one."""
    path = shared_path(spark, "sessions")
    sessions = feed.changeset_sessions(changes_stream(spark, d), "6 hours")
    sessions.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", shared_path(spark, "offsets")).trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema(sessions.schema).parquet(path)
    text = lambda c: F.regexp_replace(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0+$", "").alias(c)
    stamp = lambda c: F.when(F.date_format(c, "SSSSSS") == "000000", F.date_format(c, "yyyy-MM-dd HH:mm:ss")).otherwise(text(c)).alias(c)
    return out.select("changeset_id", stamp("start"), stamp("end"), "changes", "deletions")

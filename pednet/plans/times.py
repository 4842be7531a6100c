"""Registered queries by time: versions as of other changes and dates, lifespans against windows, and the change feed as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from pednet.operators import temporal as T
from pednet.plans.catalogue import query
from pednet.plans.network_views import view

_CHANGES = "SELECT event_id, ts, layer, id, value FROM net_changes WHERE {0}"
_ASOF = """SELECT l.event_id, r.event_id AS last_id, round(r.value, 6)::DOUBLE AS last_value FROM ({left}) l ASOF LEFT JOIN
       (SELECT * FROM ({right}) t QUALIFY row_number() OVER (PARTITION BY {key}, ts ORDER BY event_id DESC) = 1) r ON l.{key} = r.{key} AND l.ts >= r.ts"""


def _asof(spark, d, key: str, left: str, right: str):
    changes = view(spark, d, "net_changes")
    rows = changes.where(left).select("event_id", "ts", key)
    out = T.asof_join(rows, changes.where(right).select("event_id", "ts", "value", key), [key], tie="event_id")
    return out.select("event_id", F.col("asof.event_id").alias("last_id"), F.round("asof.value", 6).cast("double").alias("last_value"))


@query("edits_before_deletions", _ASOF.format(left=_CHANGES.format("deletion"), right=_CHANGES.format("tag_change"), key="layer"))
def edits_before_deletions(spark, d):
    """The last change of tags of a layer as of each deletion there; the keys are few, so each has very many rows."""
    return _asof(spark, d, "layer", "deletion", "tag_change")


@query("versions_before_changes", _ASOF.format(left=_CHANGES.format("geometry_change"), right=_CHANGES.format("creation or tag_change"), key="id"))
def versions_before_changes(spark, d):
    """The version of each feature as of each change of its geometry."""
    return _asof(spark, d, "id", "geometry_change", "creation or tag_change")


@query("ways_alive_in_windows", """SELECT w.id AS window_id, count(*) AS n, sum(l.id)::BIGINT AS ids FROM
       (SELECT s_suppkey AS id, TIMESTAMP '1992-01-01' + to_days((s_suppkey * 13 % 2400)::INT) AS "start", TIMESTAMP '1992-01-01' + to_days((s_suppkey * 13 % 2400 + s_nationkey)::INT) AS "end" FROM supplier) w JOIN
       (SELECT id, make_date(rev_year::INT, rev_month::INT, rev_day::INT)::TIMESTAMP AS "start", make_date(rev_year::INT, rev_month::INT, rev_day::INT)::TIMESTAMP + to_days((n_revs * 3)::INT) AS "end" FROM net_ways) l
       ON w."start" < l."end" AND l."start" < w."end" AND w."start" < w."end" GROUP BY w.id""")
def ways_alive_in_windows(spark, d):
    """Ways whose version lives, three days a revision, at some time in a window of a supplier's: counted and added up without a row for each pair."""
    day = lambda base, n: F.timestamp_add("DAY", n.cast("int"), base)
    s = spark.read.parquet(f"{d}/supplier.parquet")
    offset = F.col("s_suppkey") * 13 % 2400
    begin = F.lit("1992-01-01").cast("timestamp")
    windows = s.select(F.col("s_suppkey").alias("id"), day(begin, offset).alias("start"), day(begin, offset + F.col("s_nationkey")).alias("end"))
    made = F.make_date(F.col("rev_year").cast("int"), F.col("rev_month").cast("int"), F.col("rev_day").cast("int")).cast("timestamp")
    lives = view(spark, d, "net_ways").select("id", made.alias("start"), day(made, F.col("n_revs") * 3).alias("end"))
    totals = T.overlap_totals(windows, lives.withColumnRenamed("id", "ids"), ["ids"])
    return totals.groupBy(F.col("id").alias("window_id")).agg(F.sum("n").alias("n"), F.sum("ids").cast("long").alias("ids"))

"""The change feed in batch: apply changes, activity per day and changeset, what needs an update."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def apply_changes(base: DataFrame, changes: DataFrame, mode: str = "latest") -> DataFrame:
    """base after changes, by (element, id) (E1). changes: the columns of base, ts, creation, tag_change, geometry_change, deletion.
    A change without any flag doesn't count. latest: the change of the greatest ts decides, of those a deletion, then the greatest
    event_id, if changes has that. reference: keys with any deletion or change go, then the last row that creates or
    changes comes back, so a change followed by a deletion in one batch stays."""
    keys = ["element", "id"]
    rest = [c for c in base.columns if c not in keys]
    any_change = changes.where("deletion or geometry_change or tag_change or creation")
    touched = any_change.select(*keys).distinct()
    live = any_change if mode == "latest" else changes.where("creation or geometry_change or tag_change")
    gone = F.coalesce("deletion", F.lit(False))
    order = F.struct("ts", gone.alias("gone"), *[c for c in ("event_id",) if c in changes.columns])
    last = live.groupBy(*keys).agg(F.max_by(F.struct(*rest, gone.alias("__gone")), order).alias("r")).select(*keys, "r.*")
    if mode == "latest":
        last = last.where("not __gone")
    return base.join(touched, keys, "left_anti").unionByName(last.drop("__gone"))


def needs_update(changes: DataFrame, registry: DataFrame, layers: list[str]) -> DataFrame:
    """layer, needed: whether it changed since the registry's timestamp; true without one."""
    spark = changes.sparkSession
    names = spark.createDataFrame([(x,) for x in layers], "layer string").join(registry.select("layer", "since"), "layer", "left")
    newest = changes.groupBy("layer").agg(F.max("ts").alias("newest"))
    return names.join(newest, "layer", "left").select("layer", F.when(F.col("since").isNull(), True).otherwise(F.coalesce(F.col("newest") > F.col("since"), F.lit(False))).alias("needed"))


def daily_activity(changes: DataFrame) -> DataFrame:
    """Additions, modifications and deletions of each layer and day."""
    n = lambda c: F.count_if(c)
    out = changes.groupBy("layer", F.to_date("ts").alias("date")).agg(n(F.col("creation")).alias("additions"), n(F.col("tag_change") | F.col("geometry_change")).alias("modifications"), n(F.col("deletion")).alias("deletions"))
    return out.withColumn("count", F.col("additions") + F.col("modifications") + F.col("deletions"))


def daily_pivot(daily: DataFrame) -> DataFrame:
    """The counts of each date for each layer and in total, by grouping sets."""
    return daily.cube("date", "layer").agg(F.sum("count").alias("count")).where("date is not null").select("date", F.coalesce("layer", F.lit("Total")).alias("layer"), "count")


def retain(daily: DataFrame, days: int = 120) -> DataFrame:
    """The last dates of each layer."""
    return daily.withColumn("__r", F.dense_rank().over(Window.partitionBy("layer").orderBy(F.desc("date")))).where(F.col("__r") <= days).drop("__r")


def changeset_activity(changes: DataFrame) -> DataFrame:
    """Additions, modifications, deletions and their total of each changeset, those with none left out."""
    out = changes.groupBy("changeset_id").agg(F.count_if("creation").alias("additions"), F.count_if(F.col("tag_change") | F.col("geometry_change")).alias("modifications"), F.count_if("deletion").alias("deletions"))
    return out.withColumn("total", F.col("additions") + F.col("modifications") + F.col("deletions")).where("total > 0")


def top_deletions(changes: DataFrame, as_of: str, days: int = 120, n: int = 5) -> DataFrame:
    """The changesets with most deletions in the days before as_of."""
    recent = changes.where(F.col("deletion") & (F.col("ts") >= F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")) & (F.col("ts") <= F.lit(as_of).cast("timestamp")))
    return recent.groupBy("changeset_id").agg(F.count("*").alias("deletions")).orderBy(F.desc("deletions"), "changeset_id").limit(n)


def enrich_changesets(top: DataFrame, changesets: DataFrame) -> DataFrame:
    """Changesets with their metadata (J14), by changeset_id; those without go."""
    return top.join(changesets, "changeset_id")

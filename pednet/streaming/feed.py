"""The change feed as Structured Streaming: daily counts with late data, and changes applied batch by batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pednet.operators.changes import apply_changes

SCHEMA = "event_id long, ts timestamp, element string, id long, layer string, creation boolean, tag_change boolean, geometry_change boolean, deletion boolean, changeset_id long, value double"


def read_feed(spark: SparkSession, path: str, schema: str = SCHEMA, files: int = 100) -> DataFrame:
    """A stream of Parquet files of changes."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def daily_activity_stream(changes: DataFrame, late: str = "1 day") -> DataFrame:
    """Counts per layer and day over a stream (E4): a day is final once the watermark has passed it."""
    days = changes.withWatermark("ts", late).groupBy("layer", F.window("ts", "1 day").alias("w"))
    out = days.agg(F.count_if("creation").alias("additions"), F.count_if(F.col("tag_change") | F.col("geometry_change")).alias("modifications"), F.count_if("deletion").alias("deletions"))
    return out.select("layer", F.to_date("w.start").alias("date"), "additions", "modifications", "deletions", (F.col("additions") + F.col("modifications") + F.col("deletions")).alias("count"))


def changeset_sessions(changes: DataFrame, gap: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Activity of each changeset while it keeps changing (E5)."""
    s = changes.withWatermark("ts", late).groupBy("changeset_id", F.session_window("ts", gap).alias("w"))
    return s.agg(F.count("*").alias("changes"), F.count_if("deletion").alias("deletions")).select("changeset_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "changes", "deletions")


def closings_of_changes(changes: DataFrame, closings: DataFrame, within: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Changes with the closings of their changeset that follow within that time, as two streams: both may come late by `late`, and a change without
    any comes out with nulls once the watermark has passed its time. Each side's state holds the rows of that time and lateness only, by
    changeset. closings: changeset_id, closed and other columns that changes don't have. A change without a changeset has none; rows without a time
    take no part."""
    left = changes.where("ts is not null").withWatermark("ts", late)
    right = closings.where("closed is not null").withColumnRenamed("changeset_id", "__changeset").withWatermark("closed", late)
    soon = F.expr(f"changeset_id = __changeset and closed >= ts and closed <= ts + interval {within}")
    return left.join(right, soon, "left_outer").drop("__changeset")


# --- a base table by buckets ---------------------------------------------------------------------------------
#
# Rows lie in folders by the hash of their key (element, id). A batch reads and overwrites the buckets that it touches and no others. Each bucket has one
# row without a key that tells the last batch it has taken, so an older batch that is run again changes nothing, and a bucket that has lost all its
# rows is overwritten too. What a batch writes is put aside first, under its number: if a run dies while it replaces buckets, the next takes it from there.

KEYS = ("element", "id")
BUCKETS = 256


def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("element", F.col("id").cast("long")), F.lit(buckets)).cast("int")


def write_base(base: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """A new base table of rows with element and id; their number of buckets stays."""
    rows = base.withColumns({"batch": F.lit(-1).cast("long"), "buckets": F.lit(buckets), "bucket": bucket(buckets)})
    marks = _marks(base.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")), rows, -1, buckets)
    rows.unionByName(marks).repartition("bucket").write.partitionBy("bucket").parquet(path)


def _marks(numbers: DataFrame, like: DataFrame, n: int, buckets: int) -> DataFrame:
    """A row without a key for each bucket."""
    known = {"bucket": F.col("bucket"), "batch": F.lit(n).cast("long"), "buckets": F.lit(buckets)}
    return numbers.select(*[known.get(c, F.lit(None).cast(t)).alias(c) for c, t in like.dtypes])


def newest(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a base table."""
    return spark.read.parquet(path).where("element is not null or id is not null").drop("batch", "bucket", "buckets")


def apply_batch(changes: DataFrame, path: str, n: int, mode: str = "latest") -> list[int]:
    """Apply batch n to a base table (E1), and the buckets that were written."""
    spark = changes.sparkSession
    aside = f"{path.rstrip('/')}-aside/{n % 2}"
    base = spark.read.parquet(path)
    buckets = base.agg(F.max("buckets")).first()[0]
    taken = base.where("element is null and id is null").where(F.col("batch") >= n).select("bucket")
    marked = changes.where("deletion or geometry_change or tag_change or creation")
    late = [r["bucket"] for r in marked.select(bucket(buckets).alias("bucket")).distinct().join(taken, "bucket", "left_anti").collect()]  # a number a bucket at most
    if not late:
        return []
    if not _put_aside(spark, aside, n):
        rows = base.where(F.col("bucket").isin(late) & F.col("element").isNotNull())
        mine = changes.withColumns({"bucket": bucket(buckets), "buckets": F.lit(buckets), "batch": F.lit(n).cast("long")}).where(F.col("bucket").isin(late))
        after = apply_changes(rows, mine, mode).withColumn("batch", F.lit(n).cast("long"))
        after = after.unionByName(_marks(spark.createDataFrame([(b,) for b in late], "bucket int"), after, n, buckets))
        after.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(aside)
        spark.createDataFrame([(n,)], "n long").coalesce(1).write.mode("overwrite").parquet(f"{aside}-whole")
    done = spark.read.schema(base.schema).parquet(aside)
    done.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    return sorted(late)


def _put_aside(spark: SparkSession, aside: str, n: int) -> bool:
    """Whether batch n lies there whole."""
    try:
        return not spark.read.schema("n long").parquet(f"{aside}-whole").where(F.col("n") == n).isEmpty()
    except AnalysisException:  # nothing has been put there
        return False


def apply_stream(changes: DataFrame, path: str, checkpoint: str, mode: str = "latest") -> StreamingQuery:
    """Apply each batch of a stream of changes to a base table."""
    return changes.writeStream.foreachBatch(lambda batch, n: apply_batch(batch, path, n, mode) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def advance_watermark(state: DataFrame, newest_available: str, now: str) -> DataFrame:
    """layer, start, end, action of the next fetch of each layer (E2). state: layer, since (the end of the last fetch that succeeded). The
    end is the lesser of now and what the provider has; a layer that is up to date needs nothing (current), and one whose provider is
    behind its own state waits (stale)."""
    at = F.least(F.lit(newest_available).cast("timestamp"), F.lit(now).cast("timestamp"))
    action = F.when(F.col("since").isNull(), "full").when(F.col("since") > at, "stale").when(F.col("since") == at, "current").otherwise("fetch")
    return state.select("layer", F.col("since").alias("start"), at.alias("end"), action.alias("action"))


def record_success(state: DataFrame, fetched: DataFrame) -> DataFrame:
    """state after the fetches (layer, end, ok): the end of those that succeeded is the new since; others keep theirs."""
    done = fetched.where("ok").groupBy("layer").agg(F.max("end").alias("__end"))
    return state.join(done, "layer", "left").select("layer", F.greatest("since", "__end").alias("since"))


def write_daily(changes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Final days as Parquet by date."""
    return daily_activity_stream(changes).writeStream.outputMode("append").format("parquet").partitionBy("date").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

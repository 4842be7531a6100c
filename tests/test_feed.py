"""The streaming feed against its batch twin; sources."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pednet.operators import changes as C
from pednet.plans.network_views import view
from pednet.sources import layers
from pednet.streaming import feed
from tests.conftest import SMALL


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def feed_tables(spark):
    changes = view(spark, SMALL, "net_changes").select("event_id", "ts", "element", F.col("id").cast("long").alias("id"), "layer", "creation", "tag_change", "geometry_change", "deletion", F.col("changeset_id").cast("long").alias("changeset_id"), "value")
    return view(spark, SMALL, "net_ways").select("element", F.col("id").cast("long").alias("id"), F.lit(-1.0).alias("value")), changes


def test_apply_stream(spark, tmp_path):
    """Three files, a batch each, in the order of time: the stream's base is that of one batch of all."""
    base, changes = feed_tables(spark)
    for i, (a, b) in enumerate(((0, 400), (400, 700), (700, 10**9))):
        changes.orderBy("ts").limit(100_000).withColumn("n", F.row_number().over(Window.orderBy("ts", "event_id"))).where(F.col("n").between(a + 1, b)).drop("n").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    feed.write_base(base, f"{tmp_path}/base", 16)
    feed.apply_stream(feed.read_feed(spark, f"{tmp_path}/in/*", files=1), f"{tmp_path}/base", f"{tmp_path}/check").awaitTermination(300)
    assert spark.read.parquet(f"{tmp_path}/base").agg(F.max("batch")).first()[0] == 2
    assert same(feed.newest(spark, f"{tmp_path}/base"), C.apply_changes(base, changes))


@pytest.mark.parametrize("mode", ["latest", "reference"])
def test_touched_buckets(spark, tmp_path, mode):
    """Only buckets with changes are written; a batch that is run again, or an older one, changes nothing; a run that died goes on."""
    base, changes = feed_tables(spark)
    path = tmp_path / "base"
    feed.write_base(base, str(path), 32)
    some = changes.where("id in (5, 6, 7)")
    before = files(path)
    touched = feed.apply_batch(some, str(path), 0, mode)
    after = files(path)
    assert touched and {f for f in before if f not in after} == {f for f in before if int(f.split("/")[0][7:]) in touched}
    want = C.apply_changes(base, some, mode)
    assert same(feed.newest(spark, str(path)), want)
    assert feed.apply_batch(some, str(path), 0, mode) == [] and files(path) == after
    gone = base.where("id < 300").select("*", F.lit(9).alias("event_id"), F.lit("2031-01-01").cast("timestamp").alias("ts"), *[F.lit(x).alias(c) for c, x in (("creation", False), ("tag_change", False), ("geometry_change", False), ("deletion", True))])
    assert feed.apply_batch(gone, str(path), 1, mode)
    want = C.apply_changes(want, gone, mode)
    assert same(feed.newest(spark, str(path)), want)
    assert feed.apply_batch(some, str(path), 0, mode) == [] or set(feed.apply_batch(some, str(path), 0, mode)) <= set(range(32))
    assert same(feed.newest(spark, str(path)), want)


def test_died_while_replacing(spark, tmp_path):
    """A bucket's folder is lost after the batch was put aside: running the batch again brings it back."""
    import shutil

    base, changes = feed_tables(spark)
    path = tmp_path / "base"
    feed.write_base(base, str(path), 4)
    copy = tmp_path / "copy"
    shutil.copytree(path, copy)
    feed.apply_batch(changes, str(path), 0)
    want = feed.newest(spark, str(path)).collect()
    shutil.rmtree(path / "bucket=1")
    shutil.copytree(copy / "bucket=0", path / "old")  # bucket 0 is still the old one, bucket 1 has been deleted
    shutil.rmtree(path / "bucket=0")
    (path / "old").rename(path / "bucket=0")
    feed.apply_batch(changes, str(path), 0)
    assert sorted(feed.newest(spark, str(path)).collect()) == sorted(want)


def test_no_changes(spark, tmp_path):
    base, changes = feed_tables(spark)
    feed.write_base(base.limit(0), f"{tmp_path}/base", 4)
    assert feed.apply_batch(changes.limit(0), f"{tmp_path}/base", 0) == [] and feed.newest(spark, f"{tmp_path}/base").isEmpty()
    feed.apply_batch(changes, f"{tmp_path}/base", 1)
    assert same(feed.newest(spark, f"{tmp_path}/base"), C.apply_changes(base.limit(0), changes))


def test_changed_then_deleted(spark):
    base = spark.createDataFrame([("way", 1, 0.0), ("way", 2, 0.0)], "element string, id long, value double")
    rows = [("way", 1, 1.0, 1, False, True, False, False), ("way", 1, 2.0, 2, False, False, False, True)]
    changes = spark.createDataFrame(rows, "element string, id long, value double, ts int, creation boolean, tag_change boolean, geometry_change boolean, deletion boolean")
    assert {r["id"] for r in C.apply_changes(base, changes).collect()} == {2}
    assert {r["id"]: r["value"] for r in C.apply_changes(base, changes, "reference").collect()} == {1: 1.0, 2: 0.0}


def test_needs_update(spark):
    changes = spark.createDataFrame([("kerbs", "2026-01-02"), ("sidewalks", "2026-01-01")], "layer string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    registry = spark.createDataFrame([("kerbs", "2026-01-01"), ("sidewalks", "2026-01-01")], "layer string, since string").withColumn("since", F.col("since").cast("timestamp"))
    got = {r["layer"]: r["needed"] for r in C.needs_update(changes, registry, ["kerbs", "sidewalks", "crossings"]).collect()}
    assert got == {"kerbs": True, "sidewalks": False, "crossings": True}


def test_osmchange(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<osmChange><modify><way id="5" changeset="9"><tag k="footway" v="sidewalk"/></way></modify><delete><node id="6" changeset="9"/></delete></osmChange>')
    rows = {(r["action"], r["element"], r["id"]): r["tags"] for r in layers.read_osmchange(spark, str(tmp_path / "a.xml")).collect()}
    assert rows == {("modify", "way", 5): {"footway": "sidewalk"}, ("delete", "node", 6): {}}


def test_inventory(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a")
    i = layers.resource_inventory(spark, str(tmp_path))
    r = i.first()
    assert r["format"] == "CSV" and r["sha256"] == "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"
    assert layers.catalogue_diff(i, i).isEmpty()
    assert layers.catalogue_diff(i, i.limit(0)).first()["status"] == "missing_record"

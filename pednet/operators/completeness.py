"""Completeness per tile and over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pednet.functions.geo import tile_id
from pednet.operators.spatial import features_x_tiles, tile_lengths, zoom_rollup


def attribute_completeness(lines: DataFrame, zoom: int, tags: list[str]) -> DataFrame:
    """Features of each tile and how many have each tag (A16); a feature counts in every tile it meets."""
    there = lambda t: F.count_if(F.col(t).isNotNull() & ~F.col(t).isin("", "?")).alias(f"n_{t}")
    return features_x_tiles(lines, zoom).groupBy("x", "y").agg(F.count("*").alias("n"), *[there(t) for t in tags])


def completeness_ratios(df: DataFrame) -> DataFrame:
    """footway and sidewalk length over road length (A17): four places, null without roads."""
    r = lambda c: F.bround(F.col(c) / F.nullif(F.col("road_length"), F.lit(0.0)), 4)
    return df.withColumns({"footway_ratio": r("footway_length"), "sidewalk_ratio": r("sidewalk_length"), **{c: F.bround(c, 1) for c in ("road_length", "footway_length", "sidewalk_length")}})


def completeness_snapshot(roads: DataFrame, footways: DataFrame, sidewalks: DataFrame, zone: int, from_z: int = 17, to_z: int = 12) -> DataFrame:
    """Lengths and ratios of every tile and zoom (T1): one aggregation over all three kinds at the finest zoom, then a roll-up."""
    ends = ("lon0", "lat0", "lon1", "lat1")
    rows = None
    for name, df in (("road", roads), ("footway", footways), ("sidewalk", sidewalks)):
        part = zoom_rollup(tile_lengths(df.select(*ends), from_z, zone), from_z, to_z).withColumn("kind", F.lit(name))
        rows = part if rows is None else rows.unionByName(part)
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("length_m"))), F.lit(0.0)).alias(f"{k}_length") for k in ("road", "footway", "sidewalk")]
    return completeness_ratios(rows.groupBy("z", "x", "y").agg(*sums)).withColumn("tile", tile_id("z", "x", "y"))


def completeness_footways(sidewalks: DataFrame, main_footways: DataFrame, columns=("lon0", "lat0", "lon1", "lat1")) -> DataFrame:
    """What counts as a footway (U3): sidewalks and the main footways that are mapped as such, repeats kept."""
    return sidewalks.select(*columns).unionByName(main_footways.where("highway = 'footway'").select(*columns))


def snapshot_dates(today: str, months: int = 3) -> list[str]:
    """The month starts before a day, then the day itself."""
    from datetime import date, timedelta

    d = date.fromisoformat(today)
    starts = {(d - timedelta(days=30 * i)).replace(day=1) for i in range(1, months + 1)}
    earlier = (min(starts) - timedelta(days=1)).replace(day=1)
    return [x.isoformat() for x in sorted({*starts, earlier, d})]


def merge_history(old: DataFrame, new: DataFrame) -> DataFrame:
    """New entries, and old ones of the timestamps not computed anew, of tiles that still exist."""
    kept = old.join(new.select("timestamp").distinct(), "timestamp", "left_anti").join(new.select("z", "x", "y").distinct(), ["z", "x", "y"], "left_semi")
    return new.unionByName(kept, allowMissingColumns=True)


def tile_history(df: DataFrame) -> DataFrame:
    """One row a tile with its entries in time order."""
    return df.groupBy("z", "x", "y").agg(F.array_sort(F.collect_list(F.struct("timestamp", "footway_ratio", "sidewalk_ratio"))).alias("entries"))


def tile_feature_table(df: DataFrame, timestamps: list[str], value: str = "footway_ratio") -> DataFrame:
    """One row a tile, one column a timestamp (T5)."""
    return df.groupBy("z", "x", "y").pivot("timestamp", timestamps).agg(F.first(value))

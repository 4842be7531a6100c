"""The k nearest of one side for each row of another, however far they are and however unevenly they lie.

Places lie in nested square cells of degrees: level 0 is the world, each level halves the side. Counts of all cells are one table. A place of the left
side starts with the cells around its finest cell that holds k rows; the distances to the cells' far sides, with their counts, bound the distance of
the kth row, and cells that begin beyond that bound go. Cells of many rows are replaced by their children until none is left, so each place keeps a few
small cells whether it lies in a crowd, beside one or far from all, and only their rows are measured. Rows of one place count once: of more than k there,
the k smallest ids are enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pednet.functions.geo import EARTH_M, haversine_m
from pednet.operators.shared import checkpointed, emptied

#: Level of the smallest cells, about 15 cm wide.
FINEST = 28
#: Places in wider cells than of this level, or nearer to a pole than POLAR degrees, start at the whole world.
COARSE, POLAR = 6, 80.0
#: Cells of more than this times k rows are split.
CROWD = 8
#: Distances are compared in whole micrometres, so that rounding breaks no ties.
UNIT = 1e6
PLACE = ["lon", "lat"]
CELL = ["level", "cx", "cy"]


def _placed(df: DataFrame) -> DataFrame:
    """Rows with coordinates on earth, and their finest cell fx, fy."""
    rows = df.withColumns({c: F.col(c).cast("double") + F.lit(0.0) for c in PLACE}).where("lon between -180 and 180 and lat between -90 and 90")
    at = lambda c, least: F.floor((F.col(c) + least) / 360 * (1 << FINEST)).cast("long")
    return rows.withColumns({"fx": at("lon", 180) % (1 << FINEST), "fy": at("lat", 90)})


def _cell(level: str = "level") -> dict[str, Column]:
    return {c: F.expr(f"shiftright({f}, {FINEST} - {level})") for c, f in (("cx", "fx"), ("cy", "fy"))}


def _hav(degrees: Column) -> Column:
    return F.pow(F.sin(F.radians(degrees) / 2), 2)


def _metres(hav: Column) -> Column:
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), hav)))


def _bounds() -> dict[str, Column]:
    """lo, hi: no row of the cell is nearer or farther than that."""
    side = F.lit(360.0) / F.pow(F.lit(2.0), "level")
    lon, lat = F.col("lon"), F.col("lat")
    w, s = F.col("cx") * side - 180, F.col("cy") * side - 90
    e, n = w + side, F.least(F.lit(90.0), s + side)
    a, b = F.abs(lon - w), F.abs(lon - e)
    inside = (lon >= w) & (lon <= e)
    near_lon = F.when(inside, 0.0).otherwise(F.least(a, 360 - a, b, 360 - b))
    far_lon = F.when(F.least(a, b) > 180, 360 - F.least(a, b)).otherwise(F.least(F.lit(180.0), F.greatest(a, b)))
    near_lat, far_lat = F.greatest(F.lit(0.0), s - lat, lat - n), F.greatest(F.abs(s - lat), F.abs(n - lat))
    cos = lambda c: F.greatest(F.lit(0.0), F.cos(F.radians(c)))
    widest = F.when((s < 0) & (n > 0), 1.0).otherwise(F.greatest(cos(s), cos(n)))
    lo = _metres(_hav(near_lat) + cos(lat) * F.least(cos(s), cos(n)) * _hav(near_lon))
    hi = _metres(_hav(far_lat) + cos(lat) * widest * _hav(far_lon))
    return {"lo": lo * (1 - 1e-9) - 1e-5, "hi": hi * (1 + 1e-9) + 1e-5}


def _pruned(cells: DataFrame, k: int) -> DataFrame:
    """Of each place's cells those that can hold one of its k nearest rows."""
    every = Window.partitionBy(*PLACE)
    rows = cells.withColumns(_bounds())
    rows = rows.withColumn("before", F.sum("n").over(every.orderBy("hi", *CELL)))
    rows = rows.withColumn("reach", F.min(F.when(F.col("before") >= k, F.col("hi"))).over(every))
    return rows.where("reach is null or lo <= reach").select(*PLACE, *CELL, "n")


def _first_cells(places: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The cells that each place starts with."""
    levels = F.explode(F.sequence(F.lit(COARSE), F.lit(FINEST))).alias("level")
    own = places.select("fx", "fy").distinct().select("*", levels).withColumns(_cell()).join(counts.where(F.col("n") >= k), CELL)
    rows = places.join(own.groupBy("fx", "fy").agg(F.max("level").alias("level")), ["fx", "fy"], "left")
    rows = rows.withColumn("level", F.when(F.abs("lat") > POLAR, 0).otherwise(F.coalesce("level", F.lit(0)))).withColumns(_cell())
    rows = rows.withColumns(_bounds())
    side, turn = F.lit(360.0) / F.pow(F.lit(2.0), "level"), F.col("hi") / EARTH_M
    up, along = F.degrees(turn), F.degrees(F.asin(F.least(F.lit(1.0), F.sin(turn) / F.cos(F.radians("lat")))))
    span = lambda c, least, reach: F.explode(F.sequence(*[F.floor((F.col(c) + least + sign * reach) / side).cast("long") for sign in (-1, 1)]))
    near = rows.where("level > 0").select(*PLACE, "level", up.alias("up"), side.alias("side"), span("lon", 180, along).alias("cx"))
    near = near.select(*PLACE, "level", F.expr("pmod(cx, shiftleft(1L, level))").alias("cx"), F.explode(F.expr("sequence(cast(floor((lat + 90 - up) / side) as bigint), cast(floor((lat + 90 + up) / side) as bigint))")).alias("cy"))
    world = rows.where("level = 0").select(*PLACE, "level", F.lit(0).cast("long").alias("cx"), F.lit(0).cast("long").alias("cy"))
    return near.unionByName(world).join(counts, CELL)


def knn_join(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """left_id, rank (from 1), right_id, distance_m of the k rows of right that are nearest to each row of left on the sphere; all of them if right has
    fewer. Both sides: id, lon, lat. Ties go to smaller ids, null ids last. Rows without coordinates on earth take no part; rows that repeat do so in
    the result; without rows on a side there are none."""
    if k < 1:
        raise ValueError("k is 1 or more")
    sites = Window.partitionBy(*PLACE).orderBy(F.asc_nulls_last("id"))
    rows = _placed(right.select("id", *PLACE)).withColumn("nth", F.row_number().over(sites)).where(F.col("nth") <= k).drop("nth")
    rows = checkpointed(rows)
    places = checkpointed(_placed(left.select(*PLACE)).distinct())
    every = F.explode(F.sequence(F.lit(0), F.lit(FINEST))).alias("level")
    smallest = rows.groupBy("fx", "fy").agg(F.count("*").alias("n"))
    counts = checkpointed(smallest.select("fx", "fy", "n", every).withColumns(_cell()).groupBy(*CELL).agg(F.sum("n").alias("n")))
    cells = checkpointed(_pruned(_first_cells(places, counts, k), k))
    crowded = (F.col("n") > CROWD * k) & (F.col("level") < FINEST)
    while not cells.where(crowded).isEmpty():  # FINEST times at most
        parent = {"level": F.col("level") - 1, "cx": F.shiftright("cx", 1), "cy": F.shiftright("cy", 1)}
        below = counts.select(*[parent[c].alias(c) for c in CELL], F.struct(*CELL, "n").alias("child"))
        split = cells.where(crowded).drop("n").join(below, CELL).select(*PLACE, "child.*")
        after = checkpointed(_pruned(cells.where(~crowded).unionByName(split), k))
        emptied(cells)
        cells = after
    levels = [r["level"] for r in cells.select("level").distinct().collect()]  # FINEST + 1 at most
    if not levels:
        levels = [0]
    by_cell = rows.select(F.col("id").alias("right_id"), F.col("lon").alias("rlon"), F.col("lat").alias("rlat"), "fx", "fy", F.explode(F.array(*[F.lit(x) for x in levels])).alias("level")).withColumns(_cell()).drop("fx", "fy")
    pairs = cells.select(*PLACE, *CELL).join(by_cell, CELL).withColumn("distance_m", haversine_m("lon", "lat", "rlon", "rlat"))
    order = Window.partitionBy(*PLACE).orderBy(F.round(F.col("distance_m") * UNIT).cast("long"), F.asc_nulls_last("right_id"), "rlon", "rlat")
    found = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(*PLACE, "rank", "right_id", "distance_m")
    return _placed(left.select(F.col("id").alias("left_id"), *PLACE)).select("left_id", *PLACE).join(found, PLACE).select("left_id", "rank", "right_id", "distance_m")

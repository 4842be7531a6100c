"""Areas as tables: many polygons of several parts with holes against points, tiles, rasters and other polygons.

An area is any number of rings (rows of area_id, ring, coords); a place is inside if it lies in an odd number of them, so holes and parts need no marks.
Edges are cut by the rows of a tile grid and dealt to the tiles that they pass; each area has a zoom by its extent and number of edges. A row's centre line is
crossed in the tiles with edges only, so a running count along the row tells for every tile between them whether it is inside, without any edge test
there, and for a tile with edges whether its centre is. A point in such a tile is compared with the centre: each edge of the tile that the way
between them crosses (along the centre line, then along the meridian) changes sides. All joins are by tile; plans don't depend on the vertices.

Edge cases: rings may be closed or not; vertices that are null or not finite are left out; a point on an edge belongs to one side of it; tiles that an
edge only touches meet the area; areas without three vertices hold nothing; null areas, points and empty tables give no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pednet.functions.geo import clip, tile_bounds, tile_x, tile_y
from pednet.operators.shared import checkpointed

#: Tiles across an area, as a power of two: at least, and at most for those of many edges.
ACROSS = (5, 9)
#: Edges for each tile across from which there are more.
EDGES = 64
#: Degrees by which an edge reaches into its neighbouring tiles.
SLACK = 1e-11
CELL = ["z", "row", "col"]


@dataclass(frozen=True)
class Cover:
    """pieces: area_id, z, row, col, centre (whether the tile's centre is inside), edge, x1, y1, x2, y2; inner: area_id, z, row, col of tiles inside; zooms."""

    pieces: DataFrame
    inner: DataFrame
    zooms: list[int]


def area_edges(areas: DataFrame) -> DataFrame:
    """area_id, ring, edge, x1, y1, x2, y2 of the rings' edges, the closing one too."""
    fine = F.filter("coords", lambda p: p["lon"].isNotNull() & p["lat"].isNotNull() & (F.abs(p["lon"]) <= 1e6) & (F.abs(p["lat"]) <= 90))
    rings = areas.where("area_id is not null").select("area_id", "ring", fine.alias("c")).where(F.size("c") > 2)
    turned = F.concat(F.slice("c", F.lit(2), F.size("c")), F.slice("c", F.lit(1), F.lit(1)))
    rows = rings.select("area_id", "ring", F.posexplode(F.zip_with("c", turned, lambda a, b: F.struct(a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")))).alias("edge", "e"))
    return rows.select("area_id", "ring", "edge", *[F.col(f"e.{c}").cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]).where("x1 <> x2 or y1 <> y2")


def ring_areas(areas: DataFrame) -> DataFrame:
    """area_id, ring, signed: the planar area of each ring in square degrees, positive where it runs counter-clockwise."""
    return area_edges(areas).groupBy("area_id", "ring").agg((F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("signed"))


def _x_at(y: Column) -> Column:
    return F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))


def on_tiles(edges: DataFrame) -> DataFrame:
    """edges with z, dealt to the tiles that they pass: row, col."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = edges.withColumn("row", F.explode(F.sequence(tile_y(high + SLACK, F.col("z")), tile_y(low - SLACK, F.col("z")))))
    band = _band("row")
    y0, y1 = F.greatest(low, F.least(high, band["s"])), F.least(high, F.greatest(low, band["n"]))
    at = [F.when(F.col("y1") == F.col("y2"), x).otherwise(_x_at(y)) for x, y in ((F.col("x1"), y0), (F.col("x2"), y1))]
    cols = F.sequence(tile_x(F.least(*at) - SLACK, F.col("z")), tile_x(F.greatest(*at) + SLACK, F.col("z")))
    return rows.withColumn("col", F.explode(cols))


def _band(row: str) -> Column:
    """struct(s, n, middle) of a row of tiles."""
    n = F.pow(F.lit(2.0), F.col("z"))
    lat = lambda v: F.degrees(F.atan(F.sinh(F.pi() * (1 - 2 * v / n))))
    return F.struct(lat(F.col(row) + 1).alias("s"), lat(F.col(row).cast("double")).alias("n"), lat(F.col(row) + 0.5).alias("middle"))


def _middle(col: str) -> Column:
    return (F.col(col) + 0.5) / F.pow(F.lit(2.0), F.col("z")) * 360 - 180


def cover(areas: DataFrame, zoom: int | None = None) -> Cover:
    """The tiles of areas: at one zoom, or each at a zoom of its own."""
    edges = area_edges(areas)
    if zoom is None:
        extent = edges.groupBy("area_id").agg(F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2")), F.lit(1e-6)).alias("d"), F.count("*").alias("n"))
        across = F.least(F.lit(ACROSS[1]), F.greatest(F.lit(ACROSS[0]), F.floor(F.log2(F.col("n") / EDGES))))
        z = F.least(F.lit(26), F.greatest(F.lit(0), F.floor(F.log2(F.lit(360.0) / F.col("d"))) + across)).cast("int")
        edges = edges.join(extent.select("area_id", z.alias("z")), "area_id")
    else:
        edges = edges.withColumn("z", F.lit(zoom))
    middle = _band("row")["middle"]
    rows = on_tiles(edges).withColumn("middle", middle)
    x = _x_at(F.col("middle"))
    crosses = (F.col("y1") <= F.col("middle")) != (F.col("y2") <= F.col("middle"))
    rows = rows.withColumn("x", F.when(crosses, x)).withColumn("x", F.when(tile_x(F.col("x"), F.col("z")) == F.col("col"), F.col("x"))).drop("middle")
    rows = checkpointed(rows)
    tiles = rows.groupBy("area_id", *CELL).agg(F.count("x").alias("n"), F.count_if(F.col("x") < _middle("col")).alias("left"))
    along = Window.partitionBy("area_id", "z", "row").orderBy("col")
    before = F.sum("n").over(along) - F.col("n")
    tiles = checkpointed(tiles.select("*", ((before + F.col("left")) % 2 == 1).alias("centre"), ((before + F.col("n")) % 2 == 1).alias("beyond"), F.lead("col").over(along).alias("next")))
    inner = tiles.where("beyond and next > col + 1").select("area_id", "z", "row", F.explode(F.sequence(F.col("col") + 1, F.col("next") - 1)).alias("col"))
    pieces = rows.drop("x").join(tiles.select("area_id", *CELL, "centre"), ["area_id", *CELL])
    zooms = [r["z"] for r in tiles.select("z").distinct().collect()]  # 27 at most
    return Cover(pieces, inner, sorted(zooms))


def points_in_areas(points: DataFrame, areas: Cover, keys: list[str], own: tuple[str, str] | None = None) -> DataFrame:
    """keys and area_id of the points (keys, which tell them apart, lon, lat) inside areas; with own, columns of either side, only of areas where these agree."""
    if not areas.zooms:
        return points.select(*keys).limit(0).crossJoin(areas.inner.select("area_id").limit(0))  # no rows on either side
    ok = points.where((F.abs("lon") <= 1e6) & (F.abs("lat") <= 90)).select(*keys, F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"))
    ok = ok.withColumn("z", F.explode(F.array(*[F.lit(z) for z in areas.zooms]))).withColumns({"row": tile_y("lat", F.col("z")), "col": tile_x("lon", F.col("z"))})
    inner, pieces, by = areas.inner, areas.pieces.select(*CELL, "area_id", "centre", "x1", "y1", "x2", "y2"), CELL
    if own:
        ok, inner, pieces, by = ok.withColumn("__own", F.col(own[0])), inner.withColumn("__own", F.col(own[1])), pieces.withColumn("__own", F.col(own[1])), [*CELL, "__own"]
    sure = ok.join(inner, by).select(*keys, "area_id")
    near = ok.join(pieces, by)
    cx, cy = _middle("col"), _band("row")["middle"]
    x = _x_at(cy)
    y = F.col("y1") + (F.col("lon") - F.col("x1")) * (F.col("y2") - F.col("y1")) / F.nullif(F.col("x2") - F.col("x1"), F.lit(0.0))
    along = ((F.col("y1") <= cy) != (F.col("y2") <= cy)) & ((x < F.col("lon")) != (x < cx))
    up = ((F.col("x1") <= F.col("lon")) != (F.col("x2") <= F.col("lon"))) & ((y < F.col("lat")) != (y < cy))
    turns = F.coalesce(along.cast("int"), F.lit(0)) + F.coalesce(up.cast("int"), F.lit(0))
    maybe = near.groupBy(*keys, "area_id", "centre").agg(F.sum(turns).alias("n")).where((F.col("n") % 2 == 1) != F.col("centre")).select(*keys, "area_id")
    return sure.unionByName(maybe)


def tiles_x_areas(areas: DataFrame, zoom: int) -> DataFrame:
    """area_id, x, y of the tiles that meet each area."""
    c = cover(areas, zoom)
    tiles = c.pieces.select("area_id", "row", "col").distinct().unionByName(c.inner.select("area_id", "row", "col"))
    return tiles.select("area_id", F.col("col").alias("x"), F.col("row").alias("y"))


def mask_to_areas(dem: DataFrame, areas: DataFrame, lon0: float, lat0: float, pixel: float) -> DataFrame:
    """Pixels (px, py) with the areas that their centres lie in."""
    centres = dem.withColumns({"lon": lon0 + (F.col("px") + 0.5) * pixel, "lat": lat0 - (F.col("py") + 0.5) * pixel})
    return dem.join(points_in_areas(centres, cover(areas), ["px", "py"]), ["px", "py"])


def crossings(one: DataFrame, other: DataFrame) -> DataFrame:
    """Where edges of one meet edges of the other, up to SLACK beside their ends: all columns of one's edges, other_id, and t, the share of one's edge up to
    there. Both: on_tiles(). Edges along one another meet where their neighbours do."""
    b = other.select(*CELL, F.col("area_id").alias("other_id"), *[F.col(c).alias(f"o{c}") for c in ("x1", "y1", "x2", "y2")])
    dx, dy, ex, ey = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.col("ox2") - F.col("ox1"), F.col("oy2") - F.col("oy1")
    wx, wy, d = F.col("ox1") - F.col("x1"), F.col("oy1") - F.col("y1"), dx * ey - dy * ex
    t, u = (wx * ey - wy * ex) / F.nullif(d, F.lit(0.0)), (wx * dy - wy * dx) / F.nullif(d, F.lit(0.0))
    met = one.join(b, CELL).withColumns({"t": t, "u": u, "st": SLACK / F.hypot(dx, dy), "su": SLACK / F.hypot(ex, ey)}).where("t between -st and 1 + st and u between -su and 1 + su")
    return met.select("area_id", "ring", "edge", "x1", "y1", "x2", "y2", "other_id", "t").distinct()


def _extents(areas: DataFrame) -> DataFrame:
    return area_edges(areas).groupBy("area_id").agg(F.max(F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))).alias("longest"), F.count("*").alias("n"))


def _common_zoom(one: DataFrame, other: DataFrame) -> int:
    """A zoom at which tiles are about as large as the longer edges of the areas."""
    d = _extents(one).unionByName(_extents(other)).agg(F.percentile("longest", 0.5).alias("d")).first()["d"]
    return 0 if not d else max(0, min(22, math.floor(math.log2(360 / d))))


def meeting_areas(one: DataFrame, other: DataFrame) -> DataFrame:
    """area_id and other_id of the areas that share a place: edges that meet, or a ring of one inside the other."""
    zoom = _common_zoom(one, other)
    tiles = lambda df: on_tiles(area_edges(df).withColumn("z", F.lit(zoom)))
    edges = crossings(tiles(one), tiles(other)).select("area_id", "other_id")
    first = lambda df: area_edges(df).where("edge = 0").select(F.col("area_id").alias("of"), "ring", F.col("x1").alias("lon"), F.col("y1").alias("lat"))
    a_in_b = points_in_areas(first(one), cover(other), ["of", "ring"]).select(F.col("of").alias("area_id"), F.col("area_id").alias("other_id"))
    b_in_a = points_in_areas(first(other), cover(one), ["of", "ring"]).select("area_id", F.col("of").alias("other_id"))
    return edges.unionByName(a_in_b).unionByName(b_in_a).distinct()


def _oriented(areas: DataFrame) -> DataFrame:
    """Edges with the inside on their left: outer rings run counter-clockwise, holes clockwise."""
    rings = areas.select(F.struct("area_id", "ring").alias("area_id"), F.lit(0).alias("ring"), "coords")
    own = area_edges(areas).where("edge = 0").select("area_id", "ring", F.col("x1").alias("lon"), F.col("y1").alias("lat"))
    probes = own.select(F.struct("area_id", "ring").alias("of"), "lon", "lat")
    held = points_in_areas(probes, cover(rings), ["of"], ("of.area_id", "area_id.area_id")).where("of.ring <> area_id.ring").groupBy("of").agg(F.count("*").alias("depth"))
    depth = ring_areas(areas).join(held.select(F.col("of.area_id").alias("area_id"), F.col("of.ring").alias("ring"), "depth"), ["area_id", "ring"], "left")
    turn = depth.select("area_id", "ring", ((F.col("signed") > 0) != (F.coalesce("depth", F.lit(0)) % 2 == 0)).alias("turn"))
    e = area_edges(areas).join(turn, ["area_id", "ring"])
    swap = {c: F.when(F.col("turn"), F.col(d)).otherwise(F.col(c)) for c, d in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))}
    return e.select("area_id", "ring", "edge", *[x.alias(c) for c, x in swap.items()])


def _steps(edges: DataFrame, zooms: list[int]) -> DataFrame:
    """Areas as sums of steps in tiles. edges: oriented, with the zoom own of their area, which is cut at this and all coarser of the zooms.

    A step (z, row, col, a, b, ga, gb, sign) holds all of a tile above the line from (a, ga) to (b, gb); ga and gb count from the tile's south side. A way from a
    tile's south-west corner along its south side, then north, meets edges: the corner's own state, what crosses the south side and the edges in the tile
    are the steps, and their signs at a place add up to 1 if it is inside, else to 0. A vertex on the south side lies below it."""
    e = edges.withColumn("z", F.explode(F.filter(F.array(*[F.lit(z) for z in zooms]), lambda z: z <= F.col("own"))))
    rows = on_tiles(e)
    band, n = _band("row"), F.pow(F.lit(2.0), F.col("z"))
    rows = rows.withColumns({"s": band["s"], "n": band["n"], "w": F.col("col") / n * 360 - 180, "e": (F.col("col") + 1) / n * 360 - 180})
    x = _x_at(F.col("s"))
    crosses = ((F.col("y1") <= F.col("s")) != (F.col("y2") <= F.col("s"))) & (tile_x(x, F.col("z")) == F.col("col"))
    rows = rows.withColumns({"turn": F.when(crosses, F.when(F.col("y2") > F.col("y1"), -1).otherwise(1)), "x": F.when(crosses, x)})
    rows = checkpointed(rows.withColumn("c", clip("x1", "y1", "x2", "y2", "w", "s", "e", "n")))
    keys = ["area_id", "own", *CELL]
    along = Window.partitionBy("area_id", "z", "row").orderBy("col")
    tiles = rows.groupBy(*keys).agg(F.coalesce(F.sum("turn"), F.lit(0)).alias("t"))
    tiles = checkpointed(tiles.withColumn("after", F.sum("t").over(along)).withColumn("next", F.lead("col").over(along)))
    whole = tiles.select(*keys, (F.col("after") - F.col("t")).alias("sign")).unionByName(tiles.where("next > col + 1").select("area_id", "own", "z", "row", F.explode(F.sequence(F.col("col") + 1, F.col("next") - 1)).alias("col"), F.col("after").alias("sign")))
    band, zero = _band("row"), F.lit(0.0)
    whole = whole.where("sign <> 0").select(*keys, (F.col("col") / n * 360 - 180).alias("a"), ((F.col("col") + 1) / n * 360 - 180).alias("b"), zero.alias("ga"), zero.alias("gb"), "sign")
    south = rows.where("turn is not null").select(*keys, F.greatest("x", "w").alias("a"), F.col("e").alias("b"), zero.alias("ga"), zero.alias("gb"), F.col("turn").alias("sign"))
    east = F.col("c.lon2") > F.col("c.lon1")
    first = lambda v, u: F.when(east, F.col(f"c.{v}")).otherwise(F.col(f"c.{u}"))
    rise = rows.where("c.lon1 <> c.lon2 and (c.lat1 > s or c.lat2 > s)").select(*keys, first("lon1", "lon2").alias("a"), first("lon2", "lon1").alias("b"), (first("lat1", "lat2") - F.col("s")).alias("ga"), (first("lat2", "lat1") - F.col("s")).alias("gb"), F.when(east, 1).otherwise(-1).alias("sign"))
    return whole.unionByName(south).unionByName(rise).where("a < b")


def overlaps(one: DataFrame, other: DataFrame) -> DataFrame:
    """area_id, other_id, overlap: the area in square degrees that two areas share. An area's rings may touch, but not cross. Areas that share no more than
    lines have no row, or one of rounding size.

    Each area is cut into tiles of about half its extent, and for areas that are larger at their zoom too; two areas meet in the tiles of the coarser of both zooms. There each is
    a sum of steps (_steps), and what two steps share is a closed form, so a pair costs its steps in tiles that both meet, whatever else is there."""
    sides = []
    for df in (one, other):
        e = _oriented(df)
        d = e.groupBy("area_id").agg(F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2")), F.lit(1e-6)).alias("d"), F.count("*").alias("n"))
        across = F.least(F.lit(ACROSS[1]), F.greatest(F.lit(1), F.floor(F.log2(F.col("n") / EDGES))))
        z = F.least(F.lit(26), F.greatest(F.lit(0), F.floor(F.log2(F.lit(360.0) / F.col("d"))) + across)).cast("int")
        sides.append(checkpointed(e.join(d.select("area_id", z.alias("own")), "area_id")))
    zooms = sorted({r["own"] for s in sides for r in s.select("own").distinct().collect()})  # 27 at most
    if not zooms:
        return sides[0].select("area_id").limit(0).crossJoin(sides[1].select(F.col("area_id").alias("other_id")).limit(0)).withColumn("overlap", F.lit(0.0))  # no rows on either side
    a, b = (checkpointed(_steps(s, zooms)) for s in sides)
    b = b.select(*CELL, *[F.col(c).alias(f"o{c}") for c in ("area_id", "own", "a", "b", "ga", "gb", "sign")])
    at = lambda x, o="": F.col(f"{o}ga") + (F.col(x) - F.col(f"{o}a")) * (F.col(f"{o}gb") - F.col(f"{o}ga")) / (F.col(f"{o}b") - F.col(f"{o}a"))
    met = a.join(b, CELL).where("z = own or z = oown").withColumns({"lo": F.greatest("a", "oa"), "hi": F.least("b", "ob")}).where("lo < hi")
    band = _band("row")
    met = met.withColumns({"g0": at("lo"), "g1": at("hi"), "h0": at("lo", "o"), "h1": at("hi", "o")})
    p, q = F.col("g0") - F.col("h0"), F.col("g1") - F.col("h1")
    apart = F.when(p * q >= 0, (F.abs(p) + F.abs(q)) / 2).otherwise((p * p + q * q) / (2 * (F.abs(p) + F.abs(q))))  # the mean of their distance
    height = band["n"] - band["s"] - (F.col("g0") + F.col("g1") + F.col("h0") + F.col("h1")) / 4 - apart / 2
    return met.groupBy("area_id", F.col("oarea_id").alias("other_id")).agg(F.sum(F.col("sign") * F.col("osign") * (F.col("hi") - F.col("lo")) * height).alias("overlap")).where("overlap > 0")


def by_shape(areas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """areas of the same rings as one: their rings (area_id of one of them, ring, coords), and the members (area_id, shape_id)."""
    rings = areas.where("area_id is not null").groupBy("area_id").agg(F.array_sort(F.collect_list("coords")).alias("rings"))
    rings = checkpointed(rings.withColumn("k", F.sha2(F.to_json("rings"), 256)))
    alike = checkpointed(rings.groupBy("k").agg(F.min("area_id").alias("shape_id")))
    shapes = rings.join(alike.select(F.col("shape_id").alias("area_id")), "area_id")
    return shapes.select("area_id", F.posexplode("rings").alias("ring", "coords")), rings.join(alike, "k").select("area_id", "shape_id")


def local_projects_by_area(projects: DataFrame, shapes: DataFrame, boundary: DataFrame, ratio: float = 2.0) -> DataFrame:
    """projects (project_id and others) that are local to the boundary (F11): their shape meets it and is at most ratio times as large. shapes: area_id
    (a project_id), ring, coords; boundary: the same, all of one area. Projects without a shape stay."""
    whole = lambda df: _oriented(df).groupBy("area_id").agg((F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("size"))
    most = whole(boundary).agg((F.sum("size") * ratio).alias("most")).first()["most"] or 0.0  # one number
    small = whole(shapes).withColumn("small", F.col("size") <= most)
    near = meeting_areas(shapes, boundary).select("area_id").distinct().withColumn("near", F.lit(True))
    fits = small.join(near, "area_id", "left").select(F.col("area_id").alias("project_id"), (F.col("small") & F.coalesce("near", F.lit(False))).alias("fits"))
    return projects.join(fits, "project_id", "left").where(F.coalesce("fits", F.lit(True))).drop("fits")

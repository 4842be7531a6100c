"""Routes of many origin-destination pairs at once: between vertices and between places, and profiles compared.

Over nested cells (overlay.nested_cells) an overlay of several levels answers a batch. For a graph without places, or flat cells, labels spread from cell
to cell: a cell holds at most about CELL_VERTICES vertices. A round searches each cell that has open labels, for BUCKET pairs together, with a priority queue
that never leaves the cell; edges out of it open labels in other cells. So rounds go with the cells a route crosses, not with its edges, and
a task holds a cell's edges and the labels of BUCKET pairs there. Rounds end when no label is open. Paths are traced back in the same way.
"""

from __future__ import annotations

from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pednet.functions.geo import haversine_m
from pednet.operators import overlay
from pednet.operators.shared import checkpointed, importable
from pednet.operators.spatial import snap

CELL_VERTICES = 4096
BUCKET = 64
#: Tiles of this many zooms are tried for cells, from coarse to fine.
ZOOMS = range(0, 25, 2)
#: prev of a label where a route begins.
START = -1
INF = float("inf")

LABELS = "od_id long, node long, cell long, bucket long, cost double, prev long, prev_cell long, open boolean"


def graph_cells(vertices: DataFrame, most: int = CELL_VERTICES) -> DataFrame:
    """vertex and cell: the largest tile around it that holds at most so many vertices (the smallest tile, where none does)."""
    tile = lambda z: F.xxhash64(F.lit(z), F.floor((F.col("lon") + 180) / 360 * (1 << z)), F.floor((F.col("lat") + 90) / 180 * (1 << z)))
    rows = vertices.select("vertex", F.posexplode(F.array(*[tile(z) for z in ZOOMS])).alias("i", "cell"))
    counts = rows.groupBy("cell").agg(F.count("*").alias("n"))
    fits = rows.join(counts, "cell").where((F.col("n") <= most) | (F.col("i") == len(ZOOMS) - 1))
    return fits.groupBy("vertex").agg(F.min_by("cell", "i").alias("cell"))


def _costs(edges: DataFrame, profile: str, cells: DataFrame | None) -> DataFrame:
    """Passable edges with the cells of both ends; without cells, vertices are dealt to cells by hash."""
    e = edges.where((F.col(f"w_{profile}") < INF) & F.col(f"w_{profile}").isNotNull()).select("src", "dst", F.col(f"w_{profile}").cast("double").alias("w"))
    if cells is None:
        n = max(1, -(-e.select("src").distinct().count() // CELL_VERTICES))
        return e.select("*", F.pmod(F.xxhash64("src"), F.lit(n)).alias("cell"), F.pmod(F.xxhash64("dst"), F.lit(n)).alias("dst_cell"))
    return e.join(cells.select(F.col("vertex").alias("src"), "cell"), "src").join(cells.select(F.col("vertex").alias("dst"), F.col("cell").alias("dst_cell")), "dst")


def _adjacency(t: pa.Table) -> dict[int, list[tuple[int, float, int]]]:
    out: dict[int, list] = {}
    for u, v, w, c in zip(*(t.column(x).to_pylist() for x in ("src", "dst", "w", "dst_cell")), strict=True):
        out.setdefault(u, []).append((v, w, c))
    return out


def _search(key, labels: pa.Table, edges: pa.Table) -> pa.Table:
    """All labels of a cell for a bucket of pairs, settled, and the open ones that edges out of the cell make."""
    cell, bucket = (x.as_py() for x in key)
    near, out, by = _adjacency(edges), [], {}
    for r in zip(*(labels.column(x).to_pylist() for x in ("od_id", "node", "cost", "prev", "prev_cell", "open", "bound")), strict=True):
        by.setdefault(r[0], []).append(r)
    for od, rows in by.items():
        best = {node: (cost, prev, prev_cell) for _, node, cost, prev, prev_cell, _, _ in rows}
        bound = rows[0][6]
        queue, outside = [(cost, node) for _, node, cost, _, _, is_open, _ in rows if is_open], {}
        queue.sort()
        while queue:
            cost, node = heappop(queue)
            if cost > best[node][0] or cost >= bound:
                continue
            for to, w, at in near.get(node, ()):
                have = best if at == cell else outside
                if cost + w < have.get(to, (INF,))[0]:
                    have[to] = (cost + w, node, cell) if at == cell else (cost + w, node, cell, at)
                    if at == cell:
                        heappush(queue, (cost + w, to))
        out += [(od, n, cell, bucket, c, p, q, False) for n, (c, p, q) in best.items()]
        out += [(od, n, at, bucket, c, p, q, True) for n, (c, p, q, at) in outside.items() if c < bound]
    return _table(out, LABELS)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}
    fields = [x.split() for x in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table([pa.array(list(c), kinds[k]) for c, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


def _labels(sources: DataFrame, targets: DataFrame, costs: DataFrame) -> DataFrame:
    """Least costs from the sources (od_id, node, cost) as far as the targets (od_id, node, extra) need them."""
    spark = importable(sources.sparkSession)
    of = costs.select(F.col("src").alias("node"), "cell").unionByName(costs.select(F.col("dst").alias("node"), F.col("dst_cell").alias("cell"))).distinct()
    n = max(1, -(-sources.select("od_id").distinct().count() // BUCKET))
    goals = checkpointed(targets.select("od_id", "node", "extra"))
    first = sources.where(F.col("cost") < INF).join(of, "node")
    now = first.select("od_id", "node", "cell", F.pmod(F.xxhash64("od_id"), F.lit(n)).alias("bucket"), "cost", F.lit(START).cast("long").alias("prev"), F.lit(START).cast("long").alias("prev_cell"), F.lit(True).alias("open"))
    key = ["od_id", "node", "cell", "bucket"]
    least = lambda df: df.groupBy(*key).agg(F.min(F.struct("cost", "open", "prev", "prev_cell")).alias("b")).select(*key, "b.cost", "b.prev", "b.prev_cell", "b.open")  # noqa: E731  of equal costs, the settled
    now = checkpointed(least(now))
    while not now.where("open").isEmpty():
        bound = now.join(goals, ["od_id", "node"]).groupBy("od_id").agg(F.min(F.col("cost") + F.col("extra")).alias("bound"))
        todo = now.where("open").select("cell", "bucket").distinct()
        work = now.join(todo, ["cell", "bucket"]).join(bound, "od_id", "left").fillna(INF, ["bound"])
        streets = costs.join(todo, "cell").select(F.col("cell").alias("s_cell"), F.col("bucket").alias("s_bucket"), "src", "dst", "w", "dst_cell")
        found = work.groupBy("cell", "bucket").cogroup(streets.groupBy("s_cell", "s_bucket")).applyInArrow(_search, LABELS)
        rest = now.join(todo, ["cell", "bucket"], "left_anti")
        now = checkpointed(least(rest.unionByName(found.select(*rest.columns))))
    return now.drop("open")


def _ends(labels: DataFrame, targets: DataFrame) -> DataFrame:
    """Each pair's best goal: od_id, cost, node, cell, bucket."""
    at = labels.join(targets, ["od_id", "node"]).where(F.col("extra") < INF)
    return at.groupBy("od_id").agg(F.min(F.struct((F.col("cost") + F.col("extra")).alias("cost"), "node", "cell", "bucket")).alias("b")).select("od_id", "b.*")


WALK = "od_id long, bucket long, step int, nodes array<long>, head long, head_cell long"


def _walk(key, heads: pa.Table, labels: pa.Table) -> pa.Table:
    """The part of each path within a cell, from its head back to where the path came into the cell."""
    cell, bucket = (x.as_py() for x in key)
    prev: dict[int, dict] = {}
    for od, node, p, c in zip(*(labels.column(x).to_pylist() for x in ("od_id", "node", "prev", "prev_cell")), strict=True):
        prev.setdefault(od, {})[node] = (p, c)
    out = []
    for od, step, node in zip(*(heads.column(x).to_pylist() for x in ("od_id", "step", "head")), strict=True):
        nodes, at = [], cell
        while at == cell:
            nodes.append(node)
            node, at = prev[od][node]
        out.append((od, bucket, step + 1, nodes[::-1], node, at))
    return _table(out, WALK)


def _paths(labels: DataFrame, ends: DataFrame) -> DataFrame:
    """od_id and nodes: the vertices of each pair's best route, in order."""
    heads = checkpointed(ends.select("od_id", "bucket", F.lit(0).alias("step"), F.col("node").alias("head"), F.col("cell").alias("head_cell")))
    parts = None
    while not heads.isEmpty():
        rows = heads.withColumnRenamed("head_cell", "cell")
        mine = labels.join(rows.select("od_id", "cell").distinct(), ["od_id", "cell"])
        mine = mine.select(F.col("cell").alias("s_cell"), F.col("bucket").alias("s_bucket"), F.col("od_id").alias("od_id"), "node", "prev", "prev_cell")
        walked = checkpointed(rows.groupBy("cell", "bucket").cogroup(mine.groupBy("s_cell", "s_bucket")).applyInArrow(_walk, WALK))
        parts = walked if parts is None else parts.unionByName(walked)
        heads = walked.where(F.col("head_cell") != START).drop("nodes")
    if parts is None:
        return ends.select("od_id", F.array("node").alias("nodes"))
    return parts.groupBy("od_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("step")).alias("k"), "nodes"))), lambda x: x["nodes"])).alias("nodes"))


def route_batch(pairs: DataFrame, edges: DataFrame, profile: str = "distance", cells: DataFrame | None = None) -> DataFrame:
    """Least cost from vertex src to vertex dst for many pairs at once (P6): od_id, cost (null if unreachable), edges and nodes of the path.
    cells: overlay.nested_cells(vertices), or graph_cells(vertices) for labels that spread over flat cells; without, a graph of more than CELL_VERTICES
    vertices is dealt by hash, which takes many rounds."""
    if cells is not None and "cells" in cells.columns:
        return overlay.overlay_routes(pairs, overlay.build_overlay(edges, cells, profile))
    costs = checkpointed(_costs(edges, profile, cells))
    targets = pairs.select("od_id", F.col("dst").alias("node"), F.lit(0.0).alias("extra"))
    labels = _labels(pairs.select("od_id", F.col("src").alias("node"), F.lit(0.0).alias("cost")), targets, costs)
    ends = checkpointed(_ends(labels, targets))
    done = ends.join(_paths(labels, ends), "od_id").select("od_id", "cost", (F.size("nodes") - 1).alias("edges"), "nodes")
    none = pairs.where("src = dst").select("od_id", F.lit(0.0).alias("cost"), F.lit(0).alias("edges"), F.array("src").alias("nodes"))
    done = done.unionByName(none.join(done.select("od_id"), "od_id", "left_anti"))  # a vertex without edges
    return pairs.select("od_id").join(done, "od_id", "left")


def _part(w: Column, share: Column) -> Column:
    """The cost of a part of an edge: nothing for nothing, even where the edge can't be passed."""
    return F.when(share <= 1e-12, 0.0).when(w < INF, w * share).otherwise(INF)


def snapped(points: DataFrame, edges: DataFrame, vertices: DataFrame, profile: str) -> DataFrame:
    """od_id, segment, t, lon, lat, a, b and the weights of both directions there. points: od_id, lon, lat."""
    ends = vertices.select("vertex", "lon", "lat")
    both = edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"), (F.col("src") < F.col("dst")).alias("fwd"), F.col(f"w_{profile}").cast("double").alias("w"))
    w = lambda c: F.coalesce(F.min(F.when(c, F.col("w"))), F.lit(INF))
    segments = both.groupBy("a", "b").agg(w(F.col("fwd")).alias("ab"), w(~F.col("fwd")).alias("ba")).withColumn("segment_id", F.xxhash64("a", "b"))
    segments = segments.join(ends.toDF("a", "lon0", "lat0"), "a").join(ends.toDF("b", "lon1", "lat1"), "b")
    return snap(points, segments).join(segments.select("segment_id", "a", "b", "ab", "ba"), "segment_id")


def route_points(pairs: DataFrame, edges: DataFrame, vertices: DataFrame, profile: str = "distance", cells: DataFrame | None = None) -> DataFrame:
    """Routes between places (P6): both ends are snapped to their nearest segments, and parts of these are passed at their share of the cost.
    pairs: od_id, lon_a, lat_a, lon_b, lat_b. Out: od_id, cost and distance_m (null if unreachable), path (array of lon and lat). Pairs of the same
    places are routed once."""
    places = ["lon_a", "lat_a", "lon_b", "lat_b"]
    alike = checkpointed(pairs.groupBy(*places).agg(F.min("od_id").alias("first")))
    every, pairs = pairs, alike.select(F.col("first").alias("od_id"), *places)
    at = {x: checkpointed(snapped(pairs.select("od_id", F.col(f"lon_{x}").alias("lon"), F.col(f"lat_{x}").alias("lat")), edges, vertices, profile)) for x in "ab"}
    one, two = at["a"], at["b"]
    two_rows = lambda df, x, y, name: df.select("od_id", F.inline(F.array(F.struct(F.col("a").alias("node"), x.alias(name)), F.struct(F.col("b").alias("node"), y.alias(name)))))
    sources = two_rows(one, _part(F.col("ba"), F.col("t")), _part(F.col("ab"), 1 - F.col("t")), "cost")
    targets = two_rows(two, _part(F.col("ab"), F.col("t")), _part(F.col("ba"), 1 - F.col("t")), "extra")
    if cells is not None and "cells" in cells.columns:
        graph = overlay.build_overlay(edges, cells, profile)
        ends = overlay.search(sources, targets, graph)
        nodes = overlay.paths(ends, graph)
    else:
        labels = _labels(sources, targets, checkpointed(_costs(edges, profile, cells)))
        ends = checkpointed(_ends(labels, targets))
        nodes = _paths(labels, ends)
    steps = nodes.select("od_id", F.posexplode("nodes").alias("i", "vertex")).join(vertices.select("vertex", "lon", "lat"), "vertex")
    steps = steps.groupBy("od_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "lon", "lat"))), lambda x: F.struct(x["lon"], x["lat"])).alias("steps"))
    place = lambda x: F.struct(F.col(f"{x}.lon").cast("double").alias("lon"), F.col(f"{x}.lat").cast("double").alias("lat"))
    whole = one.select("od_id", "segment_id", "t", "ab", "ba", "lon", "lat").alias("s").join(two.select("od_id", "segment_id", "t", "lon", "lat").alias("e"), "od_id")
    along = F.col("e.t") - F.col("s.t")
    straight = F.when(F.col("s.segment_id") == F.col("e.segment_id"), F.when(along >= 0, _part(F.col("ab"), along)).otherwise(_part(F.col("ba"), -along)))
    whole = whole.select("od_id", straight.alias("straight"), place("s").alias("first"), place("e").alias("last"))
    whole = whole.join(ends.select("od_id", "cost"), "od_id", "left").join(steps, "od_id", "left")
    direct = (F.coalesce("straight", F.lit(INF)) < INF) & (F.col("straight") <= F.coalesce("cost", F.lit(INF)))
    path = F.when(direct, F.array("first", "last")).when(F.col("cost").isNotNull(), _without_repeats(F.concat(F.array("first"), "steps", F.array("last"))))
    whole = whole.select("od_id", F.when(direct, F.col("straight")).otherwise(F.col("cost")).alias("cost"), path.alias("path"))
    whole = whole.select(F.col("od_id").alias("first"), "cost", path_m("path").alias("distance_m"), "path")
    return overlay.members(every, alike, places).join(whole, "first", "left").select("od_id", "cost", "distance_m", "path")


def _without_repeats(path: Column) -> Column:
    """A path without places equal to the one before; two places at least."""
    kept = F.filter(F.zip_with(path, F.concat(F.array(F.lit(None).cast("struct<lon:double,lat:double>")), path), lambda p, q: F.when(p.isNotNull() & (q.isNull() | (p != q)), p)), lambda p: p.isNotNull())
    return F.when(F.size(kept) > 1, kept).otherwise(F.array_repeat(F.element_at(kept, 1), 2))


def path_m(path: Column | str) -> Column:
    """The length of a path in metres."""
    p = F.col(path) if isinstance(path, str) else path
    n = F.size(p) - 1
    steps = F.zip_with(F.slice(p, F.lit(1), n), F.slice(p, F.lit(2), n), lambda a, b: haversine_m(a["lon"], a["lat"], b["lon"], b["lat"]))
    return F.when(p.isNotNull(), F.aggregate(steps, F.lit(0.0), lambda a, x: a + x))


def route_compare(pairs: DataFrame, edges: DataFrame, vertices: DataFrame, profile: str, baseline: str = "distance", cells: DataFrame | None = None) -> DataFrame:
    """A profile's routes beside the baseline's (P7): cost, distance_m, path, the same of the baseline, by how much percent the profile's
    route is longer, and status: route, barrier (the baseline alone gets there) or disconnected."""
    one, two = route_points(pairs, edges, vertices, profile, cells), route_points(pairs, edges, vertices, baseline, cells)
    both = one.join(two.toDF("od_id", "baseline_cost", "baseline_m", "baseline_path"), "od_id")
    why = F.when(F.col("cost").isNotNull(), "route").when(F.col("baseline_cost").isNotNull(), "barrier").otherwise("disconnected")
    longer = F.round(100 * (F.col("distance_m") - F.col("baseline_m")) / F.nullif(F.col("baseline_m"), F.lit(0.0)), 2)
    return both.withColumns({"longer_percent": longer, "status": why})

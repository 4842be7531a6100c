"""Routes over a multi-level overlay of the graph (P6 at scale).

Vertices lie in nested cells: those of level 1 hold at most CELL vertices, those of each further level FAN times as many, and that of the last level holds
all. The graph of a level has, inside each of its cells, the edges that cross cells of the level below, and for every such lower cell the
least costs from its entries to its exits (a clique). The nesting doesn't depend on costs: a profile is customised by one job a level, in which a task holds
one cell.

A batch of pairs climbs from both ends: at each level, a task searches one cell for BUCKET pairs, from the exits that the level below reached, to
the exits of this one (backwards from the destination), and where both ends share the cell, also meets in it. So each cell is
read at most twice for a pair's side, and rounds go with levels. The best meeting is unpacked from its level down: least-cost edges of cliques
become paths inside their cells.

Edge cases: impassable edges (null or infinite) don't take part; of parallel edges the cheapest counts; a vertex without edges reaches itself;
equal costs are met at the lowest level; ends that aren't vertices are unreachable; an empty graph or batch gives no error.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pednet.operators.shared import checkpointed, importable

CELL = 1024
FAN = 32
BUCKET = 64
#: A cell is the largest tile around a vertex, of these many zooms, that holds no more vertices than its level allows.
ZOOMS = 27
#: Zooms of which tiles are counted at once.
BAND = 4
INF = float("inf")

CLIQUE = "level int, cell long, src long, dst long, w double, inner long"
LABEL = "od_id long, forward boolean, level int, cell long, node long, cost double, via array<long>"
FOUND = "od_id long, level int, cost double, via array<long>, back array<long>"
STEP = "od_id long, place array<int>, level int, cell long, src long, dst long"


def nested_cells(vertices: DataFrame, cell: int = CELL, fan: int = FAN) -> DataFrame:
    """vertex and cells, the ids of its cells from level 1 to that of the whole graph. vertices: vertex, lon, lat."""
    n = vertices.count()
    limits = [cell]
    while limits[-1] < n:
        limits.append(limits[-1] * fan)
    if len(limits) == 1:
        return vertices.select("vertex", F.array(F.lit(0).cast("long")).alias("cells"))
    across, up = (F.col("lon") + 180) / 360, (F.col("lat") + 90) / 180
    place = lambda z: [F.floor(c * F.pow(F.lit(2.0), z)) for c in (across, up)]
    tile = lambda z: F.xxhash64(z, *place(z))
    rows, full, deepest = vertices, None, -1
    while deepest + 1 < ZOOMS:  # only vertices in tiles that are still too full go on to finer zooms, so few zooms count tiles of single vertices
        zooms = range(deepest + 1, min(deepest + 1 + BAND, ZOOMS))
        if full is not None:
            rows = vertices.withColumn("tile", tile(F.lit(deepest))).join(full.select("tile"), "tile", "left_semi")
        many = rows.select("lon", "lat", F.explode(F.array(*[F.lit(z) for z in zooms])).alias("z")).groupBy("z", tile(F.col("z")).alias("tile")).agg(F.count("*").alias("n")).where(F.col("n") > limits[0])
        many = checkpointed(many)
        full, deepest = many if full is None else full.unionByName(many), zooms[-1]
        if many.where(F.col("z") == deepest).isEmpty():
            break
    leaves = vertices.select(*[c.alias(k) for c, k in zip(place(F.lit(deepest)), "xy", strict=True)]).distinct().withColumn("leaf", F.xxhash64(F.lit(deepest), "x", "y"))
    above = leaves.select("leaf", "x", "y", F.explode(F.sequence(F.lit(0), F.lit(deepest))).alias("z"))
    above = above.select("leaf", F.expr(f"xxhash64(z, shiftright(x, {deepest} - z), shiftright(y, {deepest} - z))").alias("tile"))
    deep = [F.max(F.when(F.col("n") > most, F.col("z"))).alias(f"z{i}") for i, most in enumerate(limits[:-1])]
    deep = above.join(full, "tile").groupBy("leaf").agg(*deep)
    zoom = lambda i: F.least(F.coalesce(F.col(f"z{i}") + 1, F.lit(0)), F.lit(ZOOMS - 1))
    ids = [F.xxhash64(F.lit(i), tile(zoom(i))) for i in range(len(limits) - 1)]
    return vertices.select("vertex", "lon", "lat", tile(F.lit(deepest)).alias("leaf")).join(deep, "leaf", "left").select("vertex", F.array(*ids, F.lit(0).cast("long")).alias("cells"))


@dataclass(frozen=True)
class Overlay:
    """levels; vertex, cells; the graphs of all levels: level, cell, src, dst, w, inner (the lower cell of a clique's edge), entry, exit. A row
    without dst tells that src is a gate of its cell."""

    levels: int
    cells: DataFrame
    graph: DataFrame


def _rows(t: pa.Table, *columns: str):
    return zip(*(t.column(c).to_pylist() for c in columns), strict=True)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    fields = [x.split() for x in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table([pa.array(list(c), kinds[k]) for c, (_, k) in zip(cols, fields, strict=True)], names=[n for n, _ in fields])


class _Cell:
    """A cell's graph with its gates."""

    def __init__(self, t: pa.Table):
        self.out: dict[int, list] = {}
        self.back: dict[int, list] = {}
        self.inner: dict[tuple[int, int], tuple[float, int | None]] = {}
        self.entries, self.exits = [], []
        for u, v, w, inner, entry, is_exit in _rows(t, "src", "dst", "w", "inner", "entry", "exit"):
            if v is None:
                self.entries += [u] if entry else []
                self.exits += [u] if is_exit else []
                continue
            have = self.inner.get((u, v), (INF, None))[0]
            if w < have:
                self.inner[u, v] = (w, inner)
        for (u, v), (w, _) in self.inner.items():
            self.out.setdefault(u, []).append((v, w))
            self.back.setdefault(v, []).append((u, w))

    def search(self, start: list[tuple[float, int]], forward: bool = True, goal: int | None = None) -> tuple[dict, dict]:
        """Least costs from start (costs and vertices), and the vertex before each; until goal, if given."""
        near = self.out if forward else self.back
        best, before, done = {}, {}, set()
        queue = []
        for cost, node in start:
            if cost < best.get(node, INF):
                best[node] = cost
                before[node] = None
                heappush(queue, (cost, node))
        while queue:
            cost, node = heappop(queue)
            if node in done:
                continue
            if node == goal:
                break
            done.add(node)
            for to, w in near.get(node, ()):
                if cost + w < best.get(to, INF):
                    best[to] = cost + w
                    before[to] = node
                    heappush(queue, (cost + w, to))
        return best, before


def _clique(key: tuple[pa.Scalar, ...], graph: pa.Table) -> pa.Table:
    """Least costs from each entry of a cell to its exits."""
    level, cell, parent = (x.as_py() for x in key)
    g, out = _Cell(graph), []
    exits = set(g.exits)
    for u in sorted(g.entries):
        best, _ = g.search([(0.0, u)])
        out += [(level + 1, parent, u, v, w, cell) for v, w in best.items() if v in exits and v != u]
    return _table(out, CLIQUE)


def build_overlay(edges: DataFrame, cells: DataFrame, profile: str = "distance") -> Overlay:
    """The overlay of a profile's costs (w_<profile> of edges src, dst) over nested_cells()."""
    importable(edges.sparkSession)
    cells = checkpointed(cells)
    top = cells.select(F.max(F.size("cells")).alias("n")).first()["n"] or 1
    w = F.col(f"w_{profile}").cast("double")
    costs = edges.where(w.isNotNull() & ~F.isnan(w) & (w < INF)).groupBy("src", "dst").agg(F.min(w).alias("w"))
    both = costs.join(cells.select(F.col("vertex").alias("src"), F.col("cells").alias("sc")), "src").join(cells.select(F.col("vertex").alias("dst"), F.col("cells").alias("dc")), "dst")
    both = checkpointed(both.withColumn("level", F.array_position(F.zip_with("sc", "dc", lambda a, b: a == b), True).cast("int")))
    raw = both.select("level", F.get("sc", F.col("level") - 1).alias("cell"), "src", "dst", "w", F.lit(None).cast("long").alias("inner"))
    cross = both.where("level > 1").select("src", "dst", "sc", "dc", F.explode(F.sequence(F.lit(1), F.col("level") - 1)).alias("l"))
    gate = lambda side, c, entry: cross.select(F.col("l").alias("level"), F.get(c, F.col("l") - 1).alias("cell"), F.get(c, F.col("l")).alias("parent"), F.col(side).alias("src"), F.lit(entry).alias("entry"), F.lit(not entry).alias("exit"))
    gates = gate("src", "sc", False).unionByName(gate("dst", "dc", True))
    gates = checkpointed(gates.groupBy("level", "cell", "parent", "src").agg(F.max("entry").alias("entry"), F.max("exit").alias("exit")))
    parts = [raw]
    flags = {"entry": F.lit(False), "exit": F.lit(False)}
    marks = gates.select("level", "cell", "src", F.lit(None).cast("long").alias("dst"), F.lit(None).cast("double").alias("w"), F.lit(None).cast("long").alias("inner"), "entry", "exit")
    for level in range(1, top):
        here = parts[0].where(F.col("level") == level)
        if level > 1:
            here = here.unionByName(parts[-1])
        here = here.withColumns(flags).unionByName(marks.where(F.col("level") == level))
        parents = gates.where(F.col("level") == level).select("cell", "parent").distinct()
        parts.append(checkpointed(here.join(parents, "cell").groupBy("level", "cell", "parent").applyInArrow(_clique, CLIQUE)))
    graph = parts[0]
    for p in parts[1:]:
        graph = graph.unionByName(p)
    graph = checkpointed(graph.withColumns(flags).unionByName(marks).repartition("level", "cell"))
    return Overlay(top, cells, graph)


def _climb(key: tuple[pa.Scalar, ...], labels: pa.Table, graph: pa.Table) -> pa.Table:
    """Labels of a cell's gates, and meetings (their two lists in one, parted by null), of BUCKET pairs at most."""
    cell, _, level = (x.as_py() for x in key)
    g, out, by = _Cell(graph), [], {}
    for od, forward, node, cost, via in _rows(labels, "od_id", "forward", "node", "cost", "via"):
        by.setdefault(od, ({}, {}))[0 if forward else 1].setdefault(node, []).append((cost, via))
    for od, sides in by.items():
        start = [{node: min(x) for node, x in side.items()} for side in sides]
        reached = []
        for side, gates, forward in ((start[0], g.exits, True), (start[1], g.entries, False)):
            best, before = g.search([(c, n) for n, (c, _) in side.items()], forward) if side else ({}, {})
            root: dict = {}

            def origin(n, root=root, before=before):
                chain = []
                while n not in root and before[n] is not None:
                    chain.append(n)
                    n = before[n]
                r = root.get(n, n)
                for x in (*chain, n):
                    root[x] = r
                return r

            out += [(od, forward, level + 1, cell, n, best[n], [*side[origin(n)][1], n]) for n in gates if n in best]
            reached.append((best, origin))
        best, origin = reached[0]
        meet = min(((best[n] + c, n) for n, (c, _) in start[1].items() if n in best), default=None)
        if meet:
            cost, n = meet
            out.append((od, None, level, cell, None, cost, [*start[0][origin(n)][1], None, *start[1][n][1]]))
    return _table(out, LABEL)


def _bucketed(rows: DataFrame) -> DataFrame:
    """rows (od_id, cell and others) with bucket: about BUCKET pairs of a cell, however many other cells the batch is spread over."""
    size = rows.groupBy("cell").agg(F.ceil(F.count_distinct("od_id") / BUCKET).alias("buckets"))
    return rows.join(size, "cell").withColumn("bucket", F.pmod(F.xxhash64("od_id"), F.col("buckets"))).drop("buckets")


def search(sources: DataFrame, targets: DataFrame, overlay: Overlay) -> DataFrame:
    """od_id, level, cost, via, back: each pair's best meeting. sources: od_id, node, cost; targets: od_id, node, extra, what it costs from there on. via: the
    vertices by which the source's cells are left, from the source on; back: the same of the target."""
    importable(sources.sparkSession)
    side = lambda df, cost, forward: df.where(F.col(cost) < INF).select("od_id", F.lit(forward).alias("forward"), F.lit(1).alias("level"), "node", F.col(cost).cast("double").alias("cost"), F.array("node").alias("via"))
    labels = side(sources, "cost", True).unionByName(side(targets, "extra", False))
    cells = overlay.cells.withColumnRenamed("vertex", "node")
    labels = checkpointed(labels.join(cells, "node").withColumn("cell", F.get("cells", F.lit(0))).drop("cells"))
    found = None
    for level in range(1, overlay.levels + 1):
        rows = checkpointed(_bucketed(labels))
        todo = rows.select("cell", "bucket").distinct()
        graph = overlay.graph.where(F.col("level") == level).join(todo, "cell").select(F.col("cell").alias("g_cell"), F.col("bucket").alias("g_bucket"), F.col("level").alias("g_level"), "src", "dst", "w", "inner", "entry", "exit")
        climbed = checkpointed(rows.groupBy("cell", "bucket", "level").cogroup(graph.groupBy("g_cell", "g_bucket", "g_level")).applyInArrow(_climb, LABEL))
        cut = F.array_position("via", F.lit(-1).cast("long"))
        met = climbed.where("forward is null").withColumn("via", F.transform("via", lambda x: F.coalesce(x, F.lit(-1).cast("long"))))
        met = met.select("od_id", "level", "cost", F.slice("via", F.lit(1), cut - 1).alias("via"), F.slice("via", cut + 1, F.size("via")).alias("back"))
        found = met if found is None else found.unionByName(met)
        up = climbed.where("forward is not null").drop("cell").join(cells, "node")
        labels = checkpointed(up.withColumn("cell", F.get("cells", F.lit(level))).drop("cells"))
    return checkpointed(found.groupBy("od_id").agg(F.min(F.struct("cost", "level", "via", "back")).alias("b")).select("od_id", "b.*"))


def _unpack(key: tuple[pa.Scalar, ...], steps: pa.Table, graph: pa.Table) -> pa.Table:
    """Each step as the edges of its least-cost path inside a cell; those of cliques are steps of the level below, edges have level 0."""
    cell, _, level = (x.as_py() for x in key)
    g, out, known = _Cell(graph), [], {}
    for od, place, u, v in _rows(steps, "od_id", "place", "src", "dst"):
        if (u, v) not in known:
            _, before = g.search([(0.0, u)], goal=v)
            path = [v]
            while path[-1] != u:
                path.append(before[path[-1]])
            known[u, v] = path[::-1]
        path = known[u, v]
        for i, (a, b) in enumerate(zip(path[:-1], path[1:], strict=True)):
            inner = g.inner[a, b][1]
            out.append((od, [*place, i], 0 if inner is None else level - 1, cell if inner is None else inner, a, b))
    return _table(out, STEP)


def paths(found: DataFrame, overlay: Overlay) -> DataFrame:
    """od_id and nodes: the vertices of each meeting's path, in order."""
    far = F.size("via") + F.size("back")
    stops = F.concat("via", F.reverse("back"))
    legs = F.transform(F.sequence(F.lit(0), far - 2), lambda i: F.struct(F.array(i).alias("place"), F.least(i + 1, far - 1 - i, F.col("level")).cast("int").alias("level"), F.get(stops, i).alias("src"), F.get(stops, i + 1).alias("dst")))
    legs = found.select("od_id", F.explode(legs).alias("s")).select("od_id", "s.*").where("src <> dst")
    cells = overlay.cells.withColumnRenamed("vertex", "src")
    steps = checkpointed(legs.join(cells, "src").withColumn("cell", F.get("cells", F.col("level") - 1)).select("od_id", "place", "level", "cell", "src", "dst"))
    done = None
    for level in range(overlay.levels, 0, -1):
        rows = _bucketed(steps.where(F.col("level") == level))
        todo = rows.select("cell", "bucket").distinct()
        graph = overlay.graph.where(F.col("level") == level).join(todo, "cell").select(F.col("cell").alias("g_cell"), F.col("bucket").alias("g_bucket"), F.col("level").alias("g_level"), "src", "dst", "w", "inner", "entry", "exit")
        got = checkpointed(rows.groupBy("cell", "bucket", "level").cogroup(graph.groupBy("g_cell", "g_bucket", "g_level")).applyInArrow(_unpack, STEP))
        done = got.where("level = 0") if done is None else done.unionByName(got.where("level = 0"))
        steps = steps.where(F.col("level") < level).unionByName(got.where("level > 0"))
    edges = done.groupBy("od_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "dst"))), lambda x: x["dst"]).alias("rest"))
    start = found.select("od_id", F.get("via", F.lit(0)).alias("start"))
    return start.join(edges, "od_id", "left").select("od_id", F.concat(F.array("start"), F.coalesce("rest", F.array().cast("array<long>"))).alias("nodes"))


def overlay_routes(pairs: DataFrame, overlay: Overlay) -> DataFrame:
    """Least cost from vertex src to vertex dst of many pairs (od_id, src, dst): od_id, cost (null if unreachable), edges and nodes of the path. Pairs of the
    same ends are searched once."""
    alike = checkpointed(pairs.groupBy("src", "dst").agg(F.min("od_id").alias("first")))
    ends = alike.select(F.col("first").alias("od_id"), "src", "dst")
    found = search(ends.select("od_id", F.col("src").alias("node"), F.lit(0.0).alias("cost")), ends.select("od_id", F.col("dst").alias("node"), F.lit(0.0).alias("extra")), overlay)
    done = found.join(paths(found, overlay), "od_id").select("od_id", "cost", (F.size("nodes") - 1).alias("edges"), "nodes")
    none = ends.where("src = dst").select("od_id", F.lit(0.0).alias("cost"), F.lit(0).alias("edges"), F.array("src").alias("nodes"))
    done = done.unionByName(none.join(done.select("od_id"), "od_id", "left_anti"))
    return members(pairs, alike, ["src", "dst"]).join(done.withColumnRenamed("od_id", "first"), "first", "left").drop("first")


def members(pairs: DataFrame, alike: DataFrame, ends: list[str]) -> DataFrame:
    """od_id of all pairs, and first, the pair of the same ends (null ones too) that stands for them in alike."""
    p, a = pairs.alias("p"), alike.alias("a")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"a.{c}")) for c in ends]
    return p.join(a, same).select("p.od_id", "a.first")

"""The routable network as tables: vertices, directed edges, segments, components, and routes of many pairs at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from pednet.functions.geo import TOLERANCE, haversine_m, vertex_key
from pednet.operators.grading import directional_weight
from pednet.operators.shared import checkpointed
from pednet.policies.profiles import PROFILES


def build_vertices(lines: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Vertices by lattice key: the last coordinate wins, ids by first appearance are left to the key (P1). lines: position, coords."""
    kx, ky = vertex_key("c.lon", "c.lat", tolerance)
    rows = lines.select("position", F.posexplode("coords").alias("i", "c")).select(kx.alias("kx"), ky.alias("ky"), "c", F.struct("position", "i").alias("at"))
    return rows.where("kx is not null and ky is not null").groupBy("kx", "ky").agg(F.max_by("c", "at").alias("c"), F.min("at").alias("first")).select(F.xxhash64("kx", "ky").alias("vertex"), F.col("c.lon").alias("lon"), F.col("c.lat").alias("lat"), "first", "kx", "ky")


def build_edges(lines: DataFrame, vertices: DataFrame, policies=PROFILES, tolerance: float = TOLERANCE) -> DataFrame:
    """Directed edges with a weight for each profile (P2, P3): self-loops go, and of edges between the same vertices the last stays.
    lines: position, coords, edge_kind, length_m and grade columns of the profiles that are not distance only."""
    kx, ky = vertex_key("a.lon", "a.lat", tolerance)
    jx, jy = vertex_key("b.lon", "b.lat", tolerance)
    n = F.greatest(F.size("coords") - 1, F.lit(0))
    steps = F.zip_with(F.slice("coords", F.lit(1), n), F.slice("coords", F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    rows = lines.select("*", F.posexplode(steps).alias("step", "s")).select("*", F.col("s.a").alias("a"), F.col("s.b").alias("b"))
    rows = rows.select("*", F.xxhash64(kx, ky).alias("u"), F.xxhash64(jx, jy).alias("v")).where("u <> v").drop("coords", "s", "a", "b")
    ends = vertices.select("vertex", "lon", "lat")
    rows = rows.join(ends.toDF("u", "lon_u", "lat_u"), "u").join(ends.toDF("v", "lon_v", "lat_v"), "v")
    rows = rows.withColumn("segment_m", haversine_m("lon_u", "lat_u", "lon_v", "lat_v"))
    one = []
    for side, src, dst, turn in (("fwd", "u", "v", 0), ("bwd", "v", "u", 1)):
        one.append(rows.select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.struct("position", "step", F.lit(turn)).alias("at"), "segment_m", *[directional_weight(p, side, F.col("segment_m")).cast("float").alias(f"w_{p.name}") for p in policies]))
    both = one[0].unionByName(one[1])
    values = [c for c in both.columns if c not in ("src", "dst", "at")]
    return both.groupBy("src", "dst").agg(F.max_by(F.struct(*values), "at").alias("e")).select("src", "dst", "e.*")


def undirected(edges: DataFrame) -> DataFrame:
    """Segments (a, b) of the graph, each once."""
    return edges.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).distinct()


def to_csr(edges: DataFrame) -> DataFrame:
    """Sorted adjacency of each source."""
    return edges.groupBy("src").agg(F.array_sort(F.collect_list("dst")).alias("targets")).withColumn("degree", F.size("targets"))


def segment_grid(segments: DataFrame, cell: float) -> DataFrame:
    """segment_id and every cell of its box (P5). segments: segment_id, lon0, lat0, lon1, lat1."""
    f = lambda c: F.floor(c / cell).cast("long")
    rows = segments.select("segment_id", F.explode(F.sequence(f(F.least("lon0", "lon1")), f(F.greatest("lon0", "lon1")))).alias("cx"), "lat0", "lat1")
    return rows.select("segment_id", "cx", F.explode(F.sequence(f(F.least("lat0", "lat1")), f(F.greatest("lat0", "lat1")))).alias("cy"))


def _digested(rows: DataFrame) -> tuple[DataFrame, dict]:
    """rows (u, v, each once) as a table, and a digest of them that is taken while they are written."""
    seen = Observation()
    out = checkpointed(rows.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.bit_xor(F.xxhash64("v", "u")).alias("y")))
    return out, seen.get


def connected_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """vertex and label, the least vertex it is connected with (P8). Each round hangs larger neighbours, then smaller ones, on the least
    neighbour (alternating stars, Kiveris et al. 2014), so long paths take logarithmically many rounds."""
    now, had = _digested(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct())
    for _ in range(rounds):
        sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sides.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(root.select("u", F.col("m").alias("v"))).distinct()
        after, has = _digested(small)
        if has == had:
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("vertex"), F.col("v").alias("label")).distinct())
        now, had = after, has
    raise RuntimeError("connected_components: not converged")


def network_metadata(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """One row of counts and bounds."""
    v = vertices.agg(F.count("*").alias("vertices"), F.min("lon").alias("xmin"), F.min("lat").alias("ymin"), F.max("lon").alias("xmax"), F.max("lat").alias("ymax"))
    return v.crossJoin(edges.agg(F.count("*").alias("edges"), F.sum("segment_m").alias("directed_m")))  # one row each


def edge_kind_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("edge_kind").agg(F.count("*").alias("n"))


def slope_source_counts(prepared: DataFrame) -> DataFrame:
    """Features by where their slope comes from."""
    return prepared.groupBy("incline_source").agg(F.count("*").alias("n"))


def routing_ids(df: DataFrame) -> DataFrame:
    """layer:id:place, the place among the features of a layer by id."""
    w = Window.partitionBy("layer").orderBy("id")
    return df.withColumn("routing_id", F.concat_ws(":", "layer", "id", F.row_number().over(w) - 1))

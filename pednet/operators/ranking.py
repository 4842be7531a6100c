"""Ranks of vertices: where a walker is who follows edges by weight and now and then goes to any vertex."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pednet.operators.shared import checkpointed, emptied

#: Edges of a source in one block; a source of more has several, so no task holds all edges of one vertex.
BLOCK = 65_536


def rank_vertices(edges: DataFrame, vertices: DataFrame | None = None, damping: float = 0.85, tolerance: float | None = 1e-9, rounds: int = 200, block: int = BLOCK) -> DataFrame:
    """vertex and rank, which sum to 1 (weighted PageRank). edges: src, dst and, if there, weight; vertices: vertex, for those without edges. Edges
    that repeat add up; edges without an end or a positive finite weight don't count. A vertex without edges away from it passes its rank on to
    all alike. Rounds go on until ranks move by no more than tolerance in sum, and raise if they don't get there; without a tolerance there
    are that many. The edges stay dealt by source over all rounds; a round shuffles ranks and sums of flows."""
    weight = F.col("weight").cast("double") if "weight" in edges.columns else F.lit(1.0)
    known = edges.select("src", "dst", weight.alias("weight")).where("src is not null and dst is not null and weight > 0 and weight < double('Infinity')")
    links = checkpointed(known.groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    blocks = F.ceil(F.count("*") / F.lit(block)).cast("int")
    out = checkpointed(links.groupBy("src").agg(F.sum("weight").alias("total"), blocks.alias("blocks")))
    part = F.pmod(F.xxhash64("dst"), F.col("blocks")).cast("int").alias("part")
    shares = links.join(out, "src").select("src", part, "dst", (F.col("weight") / F.col("total")).alias("share"))
    shares = shares.repartition("src", "part").persist(StorageLevel.DISK_ONLY)
    ends = links.select(F.col("src").alias("vertex")).unionByName(links.select(F.col("dst").alias("vertex")))
    if vertices is not None:
        ends = ends.unionByName(vertices.select("vertex").where("vertex is not null"))
    ends = checkpointed(ends.distinct())
    n = ends.count()
    state = ends.join(out.select(F.col("src").alias("vertex"), "blocks"), "vertex", "left")
    state = checkpointed(state.select("vertex", F.coalesce("blocks", F.lit(0)).alias("blocks"), F.lit(1.0 / max(n, 1)).alias("rank"), F.lit(0.0).alias("old")))
    moved = None
    for _ in range(rounds if n else 0):
        stuck = state.where("blocks = 0").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).first()[0]
        base = (1 - damping + damping * stuck) / n
        away = state.where("blocks > 0").select(F.col("vertex").alias("src"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), "rank")
        flows = shares.join(away, ["src", "part"]).select(F.col("dst").alias("vertex"), (F.col("rank") * F.col("share")).alias("flow"), F.lit(None).cast("int").alias("blocks"), F.lit(None).cast("double").alias("old"))
        own = state.select("vertex", F.lit(0.0).alias("flow"), "blocks", F.col("rank").alias("old"))
        now = flows.unionByName(own).groupBy("vertex").agg(F.max("blocks").alias("blocks"), (F.lit(base) + damping * F.sum("flow")).alias("rank"), F.max("old").alias("old"))
        now = checkpointed(now)
        emptied(state)
        state = now
        if tolerance is not None:
            moved = state.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
            if moved <= tolerance:
                break
    shares.unpersist()
    if moved is not None and moved > tolerance:
        raise RuntimeError(f"rank_vertices: ranks still move by {moved} after {rounds} rounds")
    return state.select("vertex", "rank")

"""k nearest neighbours, ranks, sketches and joined streams against plain versions."""

import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pednet.functions.geo import EARTH_M
from pednet.operators import ranking, sketches
from pednet.operators.neighbours import knn_join
from pednet.streaming import feed

POINT = "id long, lon double, lat double"


def metres(a, b):
    (x1, y1), (x2, y2) = a, b
    h = math.sin(math.radians(y2 - y1) / 2) ** 2 + math.cos(math.radians(y1)) * math.cos(math.radians(y2)) * math.sin(math.radians(x2 - x1) / 2) ** 2
    return 2 * EARTH_M * math.asin(min(1.0, math.sqrt(h)))


def nearest(left, right, k):
    """Distances by left row; ids may differ where rounding decides."""
    out = Counter()
    for i, *p in left:
        if None in p or math.isnan(p[0]):
            continue
        found = sorted((round(metres(p, q) * 1e6), j) for j, *q in right if None not in q)[:k]
        out.update((i, r + 1, j, d // 100) for r, (d, j) in enumerate(found))
    return out


def got(df):
    return Counter((r["left_id"], r["rank"], r["right_id"], round(r["distance_m"] * 1e6) // 100) for r in df.collect())


@pytest.mark.parametrize("k", [1, 5])
def test_knn(spark, k):
    """A crowd beside countryside, a place of many rows, both sides of the date line, poles, rows without coordinates."""
    r = random.Random(k)
    crowd = [(i, -49.3 + r.random() * 0.002, -25.4 + r.random() * 0.002) for i in range(700)]
    wide = [(1000 + i, r.uniform(-180, 180), r.uniform(-90, 90)) for i in range(250)]
    same = [(2000 + i, -49.2, -25.4) for i in range(40)]
    line = [(3000 + i, r.choice([-180, 180]) * (1 - r.random() * 1e-4), 10 + r.random() * 0.01) for i in range(30)]
    poles = [(4000 + i, r.uniform(-180, 180), r.choice([-1, 1]) * (90 - r.random() * 0.01)) for i in range(30)]
    right = crowd + wide + same + line + poles + [(5000, None, 0.0), (5001, 0.0, None)]
    left = [(i, -49.3 + r.gauss(0, 0.01), -25.4 + r.gauss(0, 0.01)) for i in range(40)] + [(100, -49.2, -25.4), (100, -49.2, -25.4), (101, 180.0, 10.0), (102, -180.0, 10.005), (103, 5.0, 90.0), (104, 0.0, -89.999), (105, None, 1.0), (106, float("nan"), 1.0)]
    left += [(200 + i, r.uniform(-180, 180), r.uniform(-90, 90)) for i in range(40)]
    df = knn_join(spark.createDataFrame(left, POINT).repartition(3), spark.createDataFrame(right, POINT).repartition(4), k)
    assert df.columns == ["left_id", "rank", "right_id", "distance_m"]
    assert got(df) == nearest(left, right, k)


def test_knn_small_sides(spark):
    a, b = spark.createDataFrame([(1, 0.0, 0.0), (2, 120.0, 40.0)], POINT), spark.createDataFrame([(7, 1.0, 1.0), (8, -100.0, -80.0), (None, 1.0, 1.0)], POINT)
    assert [(r["left_id"], r["rank"], r["right_id"]) for r in knn_join(a, b, 5).orderBy("left_id", "rank").collect()] == [(1, 1, 7), (1, 2, None), (1, 3, 8), (2, 1, 7), (2, 2, None), (2, 3, 8)]
    assert knn_join(a.limit(0), b, 2).count() == 0 and knn_join(a, b.limit(0), 2).count() == 0
    with pytest.raises(ValueError):
        knn_join(a, b, 0)


def ranks(edges, more, rounds, damping=0.85):
    away = defaultdict(Counter)
    for a, b, w in edges:
        if a is not None and b is not None and w and w > 0:
            away[a][b] += w
    every = sorted(set(away) | {b for x in away.values() for b in x} | set(more))
    now = dict.fromkeys(every, 1 / len(every))
    for _ in range(rounds):
        stuck = sum(now[v] for v in every if v not in away)
        after = dict.fromkeys(every, (1 - damping + damping * stuck) / len(every))
        for a, x in away.items():
            for b, w in x.items():
                after[b] += damping * now[a] * w / sum(x.values())
        now = after
    return now


def test_ranks(spark):
    """Ends without edges, a vertex alone, repeated edges, weights that don't count, and a source of many blocks."""
    r = random.Random(4)
    edges = [(r.randrange(20), r.randrange(30), r.choice([1.0, 2.0, 0.5])) for _ in range(80)] + [(3, i, 1.0) for i in range(25)] * 2 + [(None, 1, 1.0), (1, None, 1.0), (1, 2, 0.0), (1, 2, -1.0), (1, 2, None)]
    df, more = spark.createDataFrame(edges, "src long, dst long, weight double").repartition(3), spark.createDataFrame([(99,), (1,), (None,)], "vertex long")
    for rounds in (1, 7):
        found = {x["vertex"]: x["rank"] for x in ranking.rank_vertices(df, more, tolerance=None, rounds=rounds, block=3).collect()}
        want = ranks(edges, [99, 1], rounds)
        assert set(found) == set(want) and all(abs(found[v] - want[v]) < 1e-12 for v in want)
    found = {x["vertex"]: x["rank"] for x in ranking.rank_vertices(df, more, tolerance=1e-4).collect()}
    want = ranks(edges, [99, 1], 200)
    assert abs(sum(found.values()) - 1) < 1e-9 and all(abs(found[v] - want[v]) < 1e-3 for v in want)
    with pytest.raises(RuntimeError):
        ranking.rank_vertices(df, tolerance=1e-15, rounds=2)
    assert ranking.rank_vertices(df.limit(0)).count() == 0


def test_sketches(spark):
    """Merged from parts: equal to sketches of all rows at once within their error; nulls; tiles without values; empty tables."""
    rows = spark.range(60_000).select((F.lit(-49.3) + F.col("id") % 7 * 0.01).alias("lon"), F.lit(-25.4).alias("lat"), (F.col("id") % 20_011).alias("k"), F.when(F.col("id") % 7 < 6, (F.col("id") * 7919 % 60_000).cast("double")).alias("v"))
    one, two = (sketches.tile_sketches(rows.where(f"k % 2 = {i}"), 17, "k", "v") for i in (0, 1))
    fine = sketches.merge_sketches(one.unionByName(two), "x", "y")
    told = {(r["z"], r["x"], r["y"]): r for r in sketches.read_sketches(sketches.roll_up(fine, 17, 9), {"half": 0.5}).collect()}
    assert {z for z, _, _ in told} == set(range(9, 18)) and all(sum(r["n"] for (q, _, _), r in told.items() if q == z) == 60_000 for z in range(9, 18))
    top = [r for (z, _, _), r in told.items() if z == 9]
    assert len(top) == 1 and abs(top[0]["distinct"] / 20_011 - 1) < 0.05 and abs(top[0]["half"] / 30_000 - 1) < 0.05
    assert sum(r["half"] is None for (z, _, _), r in told.items() if z == 17) == 1
    odd = spark.createDataFrame([(None, 1.0, 1, 1.0), (1.0, 1.0, None, None)], "lon double, lat double, k long, v double")
    assert [(r["n"], r["distinct"], r["half"]) for r in sketches.read_sketches(sketches.tile_sketches(odd, 17, "k", "v"), {"half": 0.5}).collect()] == [(1, 0, None)]
    assert sketches.roll_up(sketches.tile_sketches(odd.limit(0), 17, "k", "v"), 17, 12).count() == 0


def test_closings(spark, tmp_path):
    """Both streams in several batches, closings a batch after their changes: equal to the batch join, but for unclosed changes behind the watermark."""
    begin = datetime(2024, 1, 1)
    r = random.Random(8)
    changes = sorted(((i, begin + timedelta(hours=r.random() * 240), r.randrange(9)) for i in range(300)), key=lambda x: x[1]) + [(900, begin, None), (901, None, 1)]
    closings = sorted(((1000 + i, begin + timedelta(hours=r.random() * 240), r.randrange(12)) for i in range(60)), key=lambda x: x[1]) + [(2000, begin + timedelta(hours=1), None)]
    a, b = "event_id long, ts timestamp, changeset_id long", "closing_id long, closed timestamp, changeset_id long"
    for name, rows, schema, shift in (("c", changes, a, 0), ("k", closings, b, 12)):
        for i in range(5):
            part = [x for x in rows if x[1] is None and i == 1 or x[1] is not None and timedelta(hours=48 * i + (shift if i else -1)) <= x[1] - begin < timedelta(hours=48 * (i + 1) + shift + (9 if i == 4 else 0))]
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}/{i}")
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}/*")
    joined = feed.closings_of_changes(read("c", a), read("k", b), "6 hours", "1 day")
    joined.writeStream.outputMode("append").format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/at").trigger(availableNow=True).start().awaitTermination(300)
    found = Counter((x["event_id"], x["closing_id"]) for x in spark.read.schema(joined.schema).parquet(f"{tmp_path}/out").collect())
    pairs = [(i, j) for i, t, c in changes[:-1] for j, u, k in closings if c is not None and c == k and t <= u <= t + timedelta(hours=6)]
    mark = min(max(x[1] for x in changes[:-1]), max(x[1] for x in closings)) - timedelta(days=1)
    alone = [(i, None) for i, t, c in changes[:-1] if i not in dict(pairs) and t + timedelta(hours=6) < mark]
    assert pairs and alone and found == Counter(pairs + alone)

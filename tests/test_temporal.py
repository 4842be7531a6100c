"""Joins by time against plain loops: ties, nulls, hot keys, empty sides; plans without range pairs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pednet.operators import temporal as T

BEGIN = datetime(2024, 1, 1)


@pytest.mark.parametrize("bucket_s", [3600, 86_400, 10**9])
def test_asof(spark, bucket_s):
    r = random.Random(bucket_s)
    when = lambda: BEGIN + timedelta(minutes=r.randrange(0, 60 * 24 * 10))
    left = [(i, r.choice("aaaaab"), when(), r.random()) for i in range(400)] + [(900, "a", None, 0.0), (901, None, BEGIN, 0.0), (902, "z", BEGIN, 0.0), (903, "a", BEGIN - timedelta(days=9), 0.0), (904, "b", BEGIN + timedelta(days=99), 0.0)]
    right = [(i, r.choice("aaaaab"), when()) for i in range(300)] + [(i + 5000, "a", BEGIN + timedelta(hours=1)) for i in range(3)] + [(9000, "a", None), (9001, None, BEGIN)]
    a = spark.createDataFrame(left + left[:2], "id long, key string, ts timestamp, value double").repartition(3)
    b = spark.createDataFrame(right, "other long, key string, ts timestamp").repartition(2)
    got = sorted((x["id"], x["asof"]["other"] if x["asof"] else -1) for x in T.asof_join(a, b, ["key"], tie="other", bucket_s=bucket_s).collect())
    best = lambda k, t: max(((s, o) for o, q, s in right if q == k and q is not None and s is not None and t is not None and s <= t), default=(None, -1))[1]
    assert got == sorted((i, best(k, t)) for i, k, t, _ in left + left[:2])
    out = T.asof_join(a, b, ["key"], tie="other")
    assert out.columns == ["id", "key", "ts", "value", "asof"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert T.asof_join(a.limit(0), b, ["key"]).count() == 0
    assert {x["asof"] for x in T.asof_join(a, b.limit(0), ["key"]).collect()} == {None}


@pytest.mark.parametrize("unit_s", [60, 3600, 86_400 * 30])
def test_intervals(spark, unit_s):
    r = random.Random(unit_s)

    def some(n, name):
        out = []
        for i in range(n):
            s = BEGIN + timedelta(minutes=r.randrange(0, 60 * 24 * 30))
            out.append((i, s, s + timedelta(minutes=r.choice([0, 1, 5, 60, 600, 6000, 40_000])), r.choice("xy")))
        return out + [(n, BEGIN, None, "x"), (n + 1, None, BEGIN, "x"), (n + 2, BEGIN + timedelta(1), BEGIN, "x"), (n + 3, BEGIN, BEGIN + timedelta(365), "x")]

    left, right = some(120, "l"), some(90, "r")
    schema = "id long, start timestamp, end timestamp, k string"
    a, b = spark.createDataFrame(left, schema).repartition(3), spark.createDataFrame(right, schema)
    meet = lambda x, y: None not in (x[1], x[2], y[1], y[2]) and x[1] < x[2] and y[1] < y[2] and x[1] < y[2] and y[1] < x[2]
    found = T.interval_join(a, b, unit_s=unit_s)
    got = sorted((x["l"]["id"], x["r"]["id"]) for x in found.collect())
    assert got == sorted((x[0], y[0]) for x in left for y in right if meet(x, y)) and len(got) > 500
    got = sorted((x["l"]["id"], x["r"]["id"]) for x in T.interval_join(a, b, unit_s=unit_s, on=["k"]).collect())
    assert got == sorted((x[0], y[0]) for x in left for y in right if meet(x, y) and x[3] == y[3])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert T.interval_join(a.limit(0), b).count() == 0 and T.interval_join(a.limit(0), b.limit(0)).count() == 0


def test_dyadic_nodes(spark):
    """Whole ones are apart and make up the interval; those above hold a part of it and more; few of each."""
    rows = [(a, b) for a in range(0, 20) for b in range(a + 1, 33)]
    df = spark.createDataFrame(rows, "a long, b long").withColumn("n", T._nodes(F.col("a"), F.col("b"), 6))
    for x in df.collect():
        span = lambda n: range(n["index"] << n["level"], (n["index"] + 1) << n["level"])
        whole = [i for n in x["n"] if n["whole"] for i in span(n)]
        assert sorted(whole) == list(range(x["a"], x["b"]))
        above = {(n["level"], n["index"]) for n in x["n"] if not n["whole"]}
        want = {(k, u >> k) for u in (x["a"], x["b"] - 1) for k in range(7) if not set(range((u >> k) << k, ((u >> k) + 1) << k)) <= set(range(x["a"], x["b"]))}
        assert above == want and len(x["n"]) <= 4 * 7


def test_intervals_at_the_top(spark):
    """Short intervals all over a long time stand above one another at the coarse levels; no rows are made of that."""
    day = lambda c: F.timestamp_add("DAY", F.col(c).cast("int"), F.lit(BEGIN))
    side = lambda n, step: spark.range(n).select("id", (F.col("id") * step % 2000).alias("at")).select("id", day("at").alias("start"), F.timestamp_add("HOUR", F.lit(1), day("at")).alias("end"))
    found = T.interval_join(side(3000, 7), side(2500, 11))
    assert found.count() == sum(1 for i in range(3000) for j in range(2500) if i * 7 % 2000 == j * 11 % 2000)
    joins = []

    def walk(node):
        while node.getClass().getSimpleName() in ("AdaptiveSparkPlanExec", "ResultQueryStageExec") or node.getClass().getSimpleName().endswith("QueryStageExec"):
            node = node.executedPlan() if hasattr(node, "executedPlan") and node.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else node.plan()
        if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
            joins.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    found.write.format("noop").mode("overwrite").save()
    plan = found._jdf.queryExecution().executedPlan()
    found._jdf.rdd().count()
    walk(plan)
    assert joins and sum(joins) < 20 * found.count()


@pytest.mark.parametrize("bucket_s", [3600, 86_400, 10**9])
def test_totals_of_overlaps(spark, bucket_s):
    r = random.Random(bucket_s)
    when = lambda: BEGIN + timedelta(minutes=30 * r.randrange(0, 48 * 20))
    some = lambda n: [(i, s, s + timedelta(minutes=r.choice([0, 30, 60, 600, 6000])), r.randrange(-5, 10**12)) for i, s in ((i, when()) for i in range(n))]
    odd = [(900, BEGIN, None, 1), (901, None, BEGIN, 1), (902, BEGIN + timedelta(1), BEGIN, 1), (903, BEGIN, BEGIN + timedelta(365), 2**63 - 1), (904, BEGIN, BEGIN + timedelta(365), 2**63 - 1)]
    left, right = some(200) + odd, some(150) + odd
    schema = "id long, start timestamp, end timestamp, v long"
    a, b = spark.createDataFrame(left + left[:2], schema).repartition(3), spark.createDataFrame(right, schema)
    fine = lambda x: None not in x[1:3] and x[1] < x[2]
    want = []
    for x in left + left[:2]:
        met = [y[3] for y in right if fine(x) and fine(y) and x[1] < y[2] and y[1] < x[2]]
        want += [(x[0], len(met), sum(met))] * bool(met)
    out = T.overlap_totals(a.drop("v"), b.select("start", "end", "v"), ["v"], bucket_s=bucket_s)
    assert out.columns == ["id", "start", "end", "n", "v"] and sorted((x["id"], x["n"], int(x["v"])) for x in out.collect()) == sorted(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert T.overlap_totals(a.limit(0), b, ["v"]).count() == 0 and T.overlap_totals(a, b.limit(0), ["v"]).count() == 0

"""FTRL-proximal: one step by hand, features by hand, held-out accuracy through the query, planted texts and edge cases."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa

from pednet.llm import toxicity
from pednet.llm.queries import queries
from tests.conftest import SMALL

MIDDLE = "/root/testdata/sf0.1"
BAD = ("vile", "rotten", "filthy")


def test_features():
    texts = ["One two,three-ONE", "", None, "a b", "é x\x00y"]
    at, doc = toxicity.buckets(pa.array(texts))
    for i, t in enumerate(texts):
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").lower())
        n = len(w) + max(0, len(w) - 1) + max(0, len(w) - 2)
        assert (doc == i).sum() == n
    one, _ = toxicity.buckets(pa.array(["ONE"]))
    assert at[0] == at[3] == one[0]


def test_stored_features():
    for x in ([], [0], [0, 1, 65_534], [65_535], [65_536, 131_070, 500_000, 500_001], range(0, 524_288, 7)):
        assert toxicity.numbers(toxicity.steps(np.array(x, np.int64))).tolist() == list(x)


def test_updates():
    """The same as the published update, a coordinate at a time."""
    r = random.Random(4)
    state, z, n = toxicity.State.new(), {}, {}
    b = toxicity.BUCKETS
    a, beta, l1 = toxicity.ALPHA, toxicity.BETA, 0.4

    def weight(i, least):
        x = z.get(i, 0.0)
        return 0.0 if abs(x) <= least else -(x - np.sign(x) * least) / ((beta + n.get(i, 0.0) ** 0.5) / a)

    for _ in range(200):
        x, y = sorted(r.sample(range(12), 4)), r.random() < 0.3
        ws = {i: weight(i, l1) for i in x} | {b: weight(b, 0.0)}
        g = 1 / (1 + np.exp(-sum(ws.values()))) - y
        for i, w in ws.items():
            z[i] = z.get(i, 0.0) + g - ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / a * w
            n[i] = n.get(i, 0.0) + g * g
        state.learn(np.array(x), float(y), l1)
    for i in [*range(12), b]:
        assert np.isclose(state.z[i], z.get(i, 0.0)) and np.isclose(state.n[i], n.get(i, 0.0))


def texts(n, seed=1):
    r = random.Random(seed)
    common = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        w = [r.choice(common) for _ in range(r.randrange(5, 80))] + [f"u{r.randrange(10**6)}" for _ in range(5)]
        y = i % 5 == 0
        if y:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(BAD))
        out.append((i, " ".join(w), int(y)))
    return out


def test_shards(spark, monkeypatch):
    """Several shards learn the words that matter and little else, and reruns agree; the case of a text doesn't matter."""
    monkeypatch.setattr(toxicity, "SHARD", 300)
    rows = texts(1000)
    docs = spark.createDataFrame([(i, t, 1.0) for i, t, _ in rows], "doc_id long, text string, score double").repartition(5)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    again = toxicity.train(docs.repartition(2), labels)
    assert (model.at == again.at).all() and (model.weight == again.weight).all() and model.bias == again.bias
    words, _ = toxicity.buckets(pa.array(list(BAD)))
    assert set(words) <= set(model.at) and len(model.at) < 300
    fresh = texts(300, seed=9)
    got = toxicity.score(spark.createDataFrame([(i, t.upper(), 1.0) for i, t, _ in fresh], docs.schema), model)
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    right = {i: y for i, _, y in fresh}
    assert np.mean([r["predicted"] == right[r["doc_id"]] for r in got.collect()]) > 0.97


def test_query(spark):
    df = queries()["op12_toxicity"](spark, MIDDLE)
    assert df.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    got = df.toPandas()
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").toPandas()
    assert len(got) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count() and got.score.between(0, 1).all()
    assert ((got.score >= 0.7) == (got.predicted == 1)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    m = got[got.held_out].merge(labels, on="doc_id")
    rank, y = m.score.rank(), m.toxic == 1
    auc = (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    assert auc > 0.96
    assert (m.predicted[~y] == 1).mean() < 0.01 and (m.predicted[y] == 1).mean() > 0.6


def test_edges(spark):
    schema = "doc_id long, text string, predicted string"
    rows = [(1, "vile thing", ""), (1, "vile thing", ""), (2, None, ""), (3, "", ""), (None, "nice day", ""), (4, "nice day " * 50_000, "x")]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (None, 1), (4, None), (3, 0), (99, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and {r["doc_id"] for r in got} == {1, 2, 3, 4, None}
    blank = {r["score"] for r in got if not r["text"]}
    assert len(blank) == 1 and all(0 <= r["score"] <= 1 for r in got)
    none = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0 and toxicity.train(docs.limit(0), labels).bias is None

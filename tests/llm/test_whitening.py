"""Whitening against plain numpy: counts of inertia, spectra with clusters and gaps, the query and its edge cases."""

import numpy as np
import pytest

from pednet.llm import whitening
from pednet.llm.queries import queries
from tests.conftest import SMALL

SPECTRA = {
    "spread": np.arange(40.0) + 1,
    "clusters": np.r_[np.full(5, 7.0), np.full(3, 2.0), np.zeros(32)],
    "near": np.r_[1, 1 + 1e-13, 1 + 1e-9, np.linspace(0, 0.5, 37)],
    "steep": 10.0 ** -np.arange(40),
    "one": np.r_[1e6, np.ones(39)],
    "none": np.zeros(40),
}


@pytest.mark.parametrize("n", [1, 2, 3, 10, 40])
def test_inertia(n):
    rng = np.random.default_rng(n)
    for _ in range(10):
        a = rng.standard_normal((n, n))
        a += a.T
        e = np.linalg.eigvalsh(a)
        assert whitening.inertia(a) == ((e > 0).sum(), (e < 0).sum())
    assert whitening.inertia(np.array([[0.0, 1], [1, 0]])) == (1, 1)
    assert whitening.inertia(np.zeros((n, n))) == (0, 0)


@pytest.mark.parametrize("name", SPECTRA)
def test_leading(name):
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((40, 40)))
    v = (q * SPECTRA[name]) @ q.T
    v = (v + v.T) / 2
    e, x = whitening.leading(v)
    want = np.sort(np.linalg.eigvalsh(v))[::-1]
    assert len(e) == min(16, (want > 4 * 40 * whitening.EPS * np.abs(v).sum(1).max()).sum())
    if not len(e):
        return
    assert (np.diff(e) <= 0).all()
    assert np.abs(e - want[: len(e)]).max() <= 1e-14 * want[0]
    assert np.abs(x.T @ x - np.eye(len(e))).max() < 1e-13
    assert np.abs(v @ x - x * e).max() <= 1e-14 * want[0]


def plain(vectors):
    """n, deviations, whitened values (up to sign), shares."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    s, n = u.sum(0), len(u)
    d = u - s / n
    e, vec = np.linalg.eigh(d.T @ d / n)
    e, vec = e[::-1][:16], vec[:, ::-1][:, :16]
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ vec / np.sqrt(e), e / np.trace(d.T @ d / n)


def test_query(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").orderBy("vec_id").collect()
    df = queries()["op13_whitening"](spark, SMALL)
    assert df.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    got = df.orderBy("vec_id", "component").toPandas()
    n, deviation, whitened, share = plain([r["embedding"] for r in table])
    assert len(got) == 16 * len(table) and (got.n == n).all() and got.identity_error.nunique() == 1 and got.identity_error.max() < 1e-9
    assert (got.deviation.to_numpy().reshape(-1, 16) == deviation[:, None]).all()
    w = got.whitened.to_numpy().reshape(-1, 16)
    sign = np.sign((w * whitened).sum(0))  # one sign a component, the same for all rows
    assert np.abs(w * sign - whitened).max() < 1e-8
    assert np.abs(got.explained.to_numpy().reshape(-1, 16) / share - 1).max() < 1e-9
    again = queries()["op13_whitening"](spark, SMALL).orderBy("vec_id", "component").toPandas()
    assert got.equals(again)


def test_edges(spark):
    schema = "vec_id long, embedding array<double>, n int, component string"
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [3.0, -1.0]), (None, [0.5, 0.25]), (4, None), (5, [1.0, None]), (6, [float("nan"), 0.0]), (7, [float("inf"), 0.0]), (8, [1.0]), (9, [])]
    df = whitening.whiten(spark.createDataFrame([(i, v, 3, "x") for i, v in rows], schema).repartition(3))
    got = df.toPandas()
    kept = [[1.0, 2.0], [1.0, 2.0], [3.0, -1.0], [0.5, 0.25], [1.0, 0.0], [0.0, 0.0]]
    n, deviation, _, _ = plain(kept)
    assert n == 5 and set(got.n) == {5} and len(got) == 2 * len(kept)
    assert got.vec_id.isna().sum() == 2 and sorted(got.deviation) == sorted(np.repeat(deviation, 2).tolist())
    assert got.identity_error.max() < 1e-9
    flat = spark.createDataFrame([(1, [2.0, 3.0], 0, ""), (2, [2.0, 3.0], 0, "")], schema)
    for none in (flat, flat.limit(0), spark.createDataFrame([(1, [], 0, ""), (2, None, 0, "")], schema)):
        assert whitening.whiten(none).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i], 0, "") for i in range(10)], schema)
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}  # a rank of one
    big = spark.createDataFrame([(0, [0.0, 1e9], 0, ""), (1, [0.1, -3e9], 0, ""), (2, [7.0, 4.0], 0, "")], schema)
    with pytest.raises(Exception, match="Overflow|overflow|too large|too big|out of bounds"):
        whitening.whiten(big.select("vec_id", "embedding").withColumn("embedding", whitening.F.transform("embedding", lambda x: x * 10))).collect()

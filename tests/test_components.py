"""Components of the network's vertices."""

from pyspark.sql import DataFrame

from pednet.operators import network as N


def test_components_of_paths(spark, monkeypatch):
    """A path, a ring, a star and a self-loop; rounds end by digests, without comparing whole tables."""
    monkeypatch.setattr(DataFrame, "exceptAll", None)
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100 + (i + 1) % 9) for i in range(9)] + [(200, 201 + i) for i in range(12)] + [(300, 300)]
    got = {r["vertex"]: r["label"] for r in N.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(9)} | {200 + i: 200 for i in range(13)}
    assert N.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0

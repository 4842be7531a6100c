"""Routes over the overlay against Dijkstra: random street lattices in nested cells, one-way streets, islands, ties, and many pairs."""

import random

import pytest

from pednet.operators import overlay as O
from tests.test_routes import dijkstra


def lattice(n, seed):
    """A lattice with one-way streets, dear and missing edges, a long bridge, and an island."""
    r = random.Random(seed)
    vertices = [(i * n + j, i * 0.01, j * 0.01) for i in range(n) for j in range(n)] + [(9000, 5.0, 5.0), (9001, 5.0001, 5.0)]
    edges = [(9000, 9001, 1.0)]
    for i in range(n):
        for j in range(n):
            for k, m in ((i + 1, j), (i, j + 1)):
                if k < n and m < n and r.random() < 0.9:
                    a, b, w = i * n + j, k * n + m, float(r.randrange(1, 9))
                    edges.append((a, b, w))
                    if r.random() < 0.8:
                        edges.append((b, a, w + r.randrange(3)))
    edges += [(0, n * n - 1, 25.0), (3, 4, float("inf")), (3, 4, 2.0), (3, 4, 7.0)]
    return vertices, edges


@pytest.mark.parametrize("cell, fan, bucket", [(10_000, 32, 64), (12, 3, 4), (5, 2, 1000)])
def test_against_dijkstra(spark, monkeypatch, cell, fan, bucket):
    monkeypatch.setattr(O, "BUCKET", bucket)
    vertices, edges = lattice(9, cell)
    v = spark.createDataFrame(vertices, "vertex long, lon double, lat double")
    e = spark.createDataFrame(edges, "src long, dst long, w_distance double")
    r = random.Random(1)
    pairs = [(i, r.randrange(81), r.randrange(81)) for i in range(60)] + [(100, 0, 9001), (101, 9000, 9001), (102, 9001, 9000), (103, 7, 7), (104, 777, 777), (105, 777, 1), (106, 0, 80)]
    od = spark.createDataFrame(pairs, "od_id long, src long, dst long")
    cells = O.nested_cells(v, cell, fan)
    sizes = {r["cells"][0]: 0 for r in cells.collect()}
    for x in cells.collect():
        sizes[x["cells"][0]] += 1
    assert max(sizes.values()) <= cell
    overlay = O.build_overlay(e, cells)
    assert (overlay.levels > 2) == (cell < 20)
    got = {x["od_id"]: x for x in O.overlay_routes(od, overlay).collect()}
    open_edges = [x for x in edges if x[2] < float("inf")]
    least = {}
    for a, b, w in open_edges:
        least[a, b] = min(w, least.get((a, b), w))
    assert len(got) == len(pairs)
    for i, a, b in pairs:
        want = 0.0 if a == b else dijkstra(open_edges, a, b)
        assert got[i]["cost"] == want, (i, a, b)
        if want is not None:
            nodes = got[i]["nodes"]
            assert (nodes[0], nodes[-1], got[i]["edges"]) == (a, b, len(nodes) - 1)
            assert sum(least[s] for s in zip(nodes[:-1], nodes[1:], strict=True)) == want
    assert O.overlay_routes(od.limit(0), overlay).count() == 0


def test_empty_graph(spark):
    v = spark.createDataFrame([(1, 0.0, 0.0)], "vertex long, lon double, lat double")
    e = spark.createDataFrame([], "src long, dst long, w_distance double")
    od = spark.createDataFrame([(1, 1, 1), (2, 1, 2)], "od_id long, src long, dst long")
    for cells in (O.nested_cells(v), O.nested_cells(v.limit(0))):
        got = {r["od_id"]: r["cost"] for r in O.overlay_routes(od, O.build_overlay(e, cells)).collect()}
        assert got == {1: 0.0, 2: None}


def test_shared_partial_ends(spark):
    """Several sources and targets of a pair, each with a cost of its own."""
    e = spark.createDataFrame([(i, i + 1, 1.0) for i in range(20)], "src long, dst long, w_distance double")
    v = spark.createDataFrame([(i, i * 0.01, 0.0) for i in range(21)], "vertex long, lon double, lat double")
    overlay = O.build_overlay(e, O.nested_cells(v, 4, 2))
    sources = spark.createDataFrame([(1, 0, 0.5), (1, 3, 5.0), (2, 1, float("inf"))], "od_id long, node long, cost double")
    targets = spark.createDataFrame([(1, 9, 4.0), (1, 12, 0.25), (2, 5, 0.0)], "od_id long, node long, extra double")
    found = O.search(sources, targets, overlay)
    assert [(r["od_id"], r["cost"]) for r in found.collect()] == [(1, 12.75)]
    assert O.paths(found, overlay).first()["nodes"] == list(range(13))

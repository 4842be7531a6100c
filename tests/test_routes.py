"""Routes of many edges against Dijkstra."""

import heapq

import pytest

from pednet.operators import overlay as O
from pednet.operators import routing as P


def dijkstra(edges, src, dst):
    queue, done = [(0.0, src)], set()
    while queue:
        cost, v = heapq.heappop(queue)
        if v == dst:
            return cost
        if v not in done:
            done.add(v)
            for a, b, w in edges:
                if a == v:
                    heapq.heappush(queue, (cost + w, b))
    return None


@pytest.mark.parametrize("cell", [4096, 7, -7])
def test_routes_of_many_edges(spark, monkeypatch, cell):
    """A path of 70 edges, dear short cuts along it, and an island; whole, in cells of a few vertices, and over an overlay of those."""
    monkeypatch.setattr(P, "CELL_VERTICES", abs(cell))
    monkeypatch.setattr(P, "BUCKET", 2)
    edges = [(i, i + 1, 1.0) for i in range(70)] + [(0, 70, 90.0), (10, 40, 35.0), (100, 101, 1.0)]
    pairs = [(1, 0, 70), (2, 0, 9), (3, 5, 60), (4, 0, 101), (5, 7, 7), (6, 70, 0), (7, 500, 500), (8, 70, 70)]
    e = spark.createDataFrame(edges, "src long, dst long, w_distance double")
    od = spark.createDataFrame(pairs, "od_id long, src long, dst long")
    v = spark.createDataFrame([(i, i * 0.01, 0.0) for i in range(102)], "vertex long, lon double, lat double")
    cells = O.nested_cells(v, 7, 4) if cell < 0 else P.graph_cells(v, cell) if cell < 10 else None
    rows = P.route_batch(od, e, cells=cells).collect()
    want = {i: dijkstra(edges, a, b) for i, a, b in pairs} | {7: 0.0}
    assert {x["od_id"]: x["cost"] for x in rows} == want
    weight = {(a, b): w for a, b, w in edges}
    for x in rows:
        if x["cost"] is not None:
            _, a, b = pairs[x["od_id"] - 1]
            assert (x["nodes"][0], x["nodes"][-1], x["edges"]) == (a, b, len(x["nodes"]) - 1)
            assert sum(weight[s] for s in zip(x["nodes"][:-1], x["nodes"][1:], strict=True)) == x["cost"]
    assert P.route_batch(od.limit(0), e).count() == 0


@pytest.mark.parametrize("nested", [False, True])
def test_routes_between_places(spark, nested):
    """Three vertices in a row; one direction of the second segment is barred to a profile."""
    v = spark.createDataFrame([(0, 0.0, 0.0), (1, 0.001, 0.0), (2, 0.002, 0.0)], "vertex long, lon double, lat double")
    e = spark.createDataFrame([(0, 1, 111.2, 111.2), (1, 0, 111.2, 111.2), (1, 2, 111.2, float("inf")), (2, 1, 111.2, 111.2)], "src long, dst long, w_distance double, w_accessible double")
    od = spark.createDataFrame([(1, 0.0002, 0.0001, 0.0018, -0.0001), (2, 0.0018, 0.0, 0.0002, 0.0), (3, 0.0002, 0.0, 0.0007, 0.0), (4, 0.001, 0.0, 0.001, 0.0)], "od_id long, lon_a double, lat_a double, lon_b double, lat_b double")
    got = {r["od_id"]: r for r in P.route_compare(od, e, v, "accessible", cells=O.nested_cells(v, 2, 2) if nested else None).collect()}
    assert got[1]["status"] == "barrier" and got[1]["path"] is None
    assert len(got[1]["baseline_path"]) == 3 and 177 < got[1]["baseline_m"] < 179 and got[1]["baseline_cost"] == pytest.approx(1.6 * 111.2)
    assert got[2]["status"] == "route" and got[2]["longer_percent"] == 0 and len(got[2]["path"]) == 3
    assert got[3]["cost"] == pytest.approx(55.6) and [round(p["lon"], 6) for p in got[3]["path"]] == [0.0002, 0.0007]
    assert got[4]["cost"] == pytest.approx(0) and len(got[4]["path"]) == 2 and got[4]["distance_m"] == pytest.approx(0)


def test_snap_far_away(spark):
    from pednet.operators import spatial as S

    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 1.0), (3, None, 0.0), (4, float("nan"), 0.0)], "od_id long, lon double, lat double")
    segments = spark.createDataFrame([(10, 0.0, 0.001, 0.01, 0.001), (11, 5.0, 0.0, 5.0, 0.5)], "segment_id long, lon0 double, lat0 double, lon1 double, lat1 double")
    got = {r["od_id"]: (r["segment_id"], r["distance_m"]) for r in S.snap(points, segments).collect()}
    assert set(got) == {1, 2} and got[1][0] == 10 and got[2][0] == 11 and got[1][1] == pytest.approx(111.2, rel=0.01) and got[2][1] > 200_000
    assert S.snap(points, segments.limit(0)).count() == 0


def test_pairs_of_the_same_ends(spark, monkeypatch):
    """Pairs of the same ends are searched once, and a cell is read once for BUCKET of its pairs, not once for each bucket of the whole batch."""
    vertices = [(i, i % 40 * 0.01, i // 40 * 0.01) for i in range(400)]
    edges = [(i, j, 1.0) for i in range(400) for j in (i - 40, i + 40, i - 1 if i % 40 else -1, i + 1 if i % 40 < 39 else -1) if 0 <= j < 400]
    pairs = [(i, 7 * i % 400, (7 * i + 1) % 400) for i in range(200)]
    v = spark.createDataFrame(vertices, "vertex long, lon double, lat double")
    e = spark.createDataFrame(edges, "src long, dst long, w_distance double")
    od = spark.createDataFrame(pairs + [(1000 + i, a, b) for i, a, b in pairs] + [(5000, None, 3)], "od_id long, src long, dst long")
    monkeypatch.setattr(O, "BUCKET", 8)
    seen = []
    real = O._bucketed
    monkeypatch.setattr(O, "_bucketed", lambda rows: seen.append(real(rows)) or seen[-1])
    got = {r["od_id"]: r["cost"] for r in P.route_batch(od, e, cells=O.nested_cells(v, 16, 4)).collect()}
    steps = {(min(a, b), max(a, b)) for a, b, _ in edges}
    assert len(got) == 401 and got[5000] is None
    assert all(got[i] == got[1000 + i] for i in range(200)) and all(got[i] == 1 for i, a, b in pairs if (min(a, b), max(a, b)) in steps)
    first = seen[0]
    assert first.select("od_id").distinct().count() == 201  # with the end of the pair without a start
    assert first.select("cell", "bucket").distinct().count() < 2 * first.select("cell").distinct().count()


def test_nested_cells_of_crowds(spark):
    """Cells are the largest tiles that hold no more vertices than allowed, beside a crowd of much finer ones; few places without coordinates stay."""
    import math

    rows = [(i, i % 30 * 0.5, i // 30 * 0.5) for i in range(900)] + [(1000 + i, 5.1 + i % 30 * 1e-6, 5.1 + i // 30 * 1e-6) for i in range(600)] + [(5000, None, None)]
    cells = {r["vertex"]: r["cells"] for r in O.nested_cells(spark.createDataFrame(rows, "vertex long, lon double, lat double"), 20, 8).collect()}
    assert len(cells) == len(rows)
    count = {}
    at = lambda x, y, z: (z, math.floor((x + 180) / 360 * 2.0**z), math.floor((y + 90) / 180 * 2.0**z))
    for _, x, y in rows[:-1]:
        for z in range(O.ZOOMS):
            count[at(x, y, z)] = count.get(at(x, y, z), 0) + 1
    for i, most in enumerate((20, 160, 1280)):
        want, have = {}, {}
        for v, x, y in rows[:-1]:
            z = next((z for z in range(O.ZOOMS) if count[at(x, y, z)] <= most), O.ZOOMS - 1)
            want.setdefault(at(x, y, z), set()).add(v)
            have.setdefault(cells[v][i], set()).add(v)
        assert sorted(map(sorted, want.values())) == sorted(map(sorted, have.values()))

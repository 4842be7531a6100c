"""Sources and sinks as round trips over small files."""

import json

import pytest

from pednet.sources import layers as L
from pednet.streaming import feed


def lines(spark, layer="sidewalks", n=3):
    rows = [(i, layer, "way", "LineString", [(float(i), 0.0), (float(i), 1.0)], None, "asphalt" if i % 2 else None) for i in range(n)]
    return spark.createDataFrame(rows, "id long, layer string, element string, geom_type string, coords array<struct<lon:double,lat:double>>, empty string, surface string")


def test_layers_and_views(spark, tmp_path):
    lines(spark).drop("layer").write.parquet(f"{tmp_path}/sidewalks")
    lines(spark, n=2).drop("layer", "surface").write.parquet(f"{tmp_path}/kerbs")
    df = L.read_layers(spark, str(tmp_path), ("sidewalks", "kerbs"))
    assert {(r["layer"], r["id"], r["surface"]) for r in df.collect()} == {("sidewalks", 0, None), ("sidewalks", 1, "asphalt"), ("sidewalks", 2, None), ("kerbs", 0, None), ("kerbs", 1, None)}
    L.union_layers_view(spark, {"a": f"{tmp_path}/sidewalks", "b": f"{tmp_path}/kerbs"}, "both_layers")
    assert spark.sql("SELECT layer, count(*) AS n FROM both_layers GROUP BY layer ORDER BY layer").collect() == [("a", 3), ("b", 2)]


def test_geojson_round_trip(spark, tmp_path):
    L.export_features_jsonl(lines(spark), f"{tmp_path}/out")
    features = [json.loads(r["value"]) for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert len(features) == 3 and all(f["type"] == "Feature" and f["geometry"]["type"] == "LineString" for f in features)
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    back = L.read_geojson(spark, f"{tmp_path}/c.geojson")
    rows = back.select("tags", L.line_coords(back["coordinates"], back["geom_type"]).alias("p")).collect()
    assert {(r["tags"]["id"], tuple(map(tuple, r["p"]))) for r in rows} == {(str(i), ((float(i), 0.0), (float(i), 1.0))) for i in range(3)}


def test_versioning_and_registry(spark, tmp_path):
    (tmp_path / "v.json").write_text(json.dumps({"osmid": {"0": 11, "1": 12}, "n_revs": {"0": 3, "1": 1}, "rev_day": {"0": 5, "1": 6}, "rev_month": {"0": 1, "1": 2}, "rev_year": {"0": 2020, "1": 2021}}))
    assert sorted(map(tuple, L.read_versioning(spark, f"{tmp_path}/v.json").collect())) == [(11, 3, 5, 1, 2020), (12, 1, 6, 2, 2021)]
    (tmp_path / "r.json").write_text(json.dumps({"a": "2024-05-01T10:00:00Z", "b": "01/02/2023 03:04:05", "c": "never"}))
    got = {r["key"]: str(r["ts"]) for r in L.read_registry(spark, f"{tmp_path}/r.json").selectExpr("key", "cast(ts as string) AS ts").collect()}
    assert got == {"a": "2024-05-01 10:00:00", "b": "2023-02-01 03:04:05", "c": "None"}


def test_roads_and_contributions(spark, tmp_path):
    spark.createDataFrame([(1, "primary", "LineString"), (2, "footway", "LineString"), (3, "residential", "Point")], "id int, highway string, geom_type string").write.parquet(f"{tmp_path}/roads")
    assert [r["id"] for r in L.read_roads(spark, f"{tmp_path}/roads").collect()] == [1]
    one = lambda key, **flags: {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"@osmId": key, "surface": "sand", "@timestamp": "2024-01-02T00:00:00Z", "@contributionChangesetId": 7, **flags}}
    features = [one("way/5", **{"@creation": True}), one("node/6", **{"@deletion": True}), one("way/x"), one("way"), {"type": "Feature", "geometry": None, "properties": {}}]
    (tmp_path / "c.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    got = sorted((r["element"], r["id"], r["creation"], r["deletion"], r["changeset_id"], r["tags"]) for r in L.read_contributions(spark, f"{tmp_path}/c.json").collect())
    assert got == [("node", 6, False, True, 7, {"surface": "sand"}), ("way", 5, True, False, 7, {"surface": "sand"})]


def test_changesets_and_matrix(spark, tmp_path):
    (tmp_path / "c.xml").write_text('<osm><changeset id="1" user="u" created_at="2024-01-02T00:00:00Z" closed_at="2024-01-02T01:00:00Z" changes_count="3"><tag k="comment" v="hello"/></changeset><changeset id="2" user="v" changes_count="0"/></osm>')
    got = L.read_changesets(spark, f"{tmp_path}/c.xml").collect()
    assert [(r["changeset_id"], r["user"], r["changes"], r["comment"]) for r in got] == [(1, "u", 3, "hello")]
    (tmp_path / "m.csv").write_text("value,wheelchair,blind\nasphalt,100,90\nsand,5,x\n")
    assert {tuple(r) for r in L.read_lookup_matrix(spark, f"{tmp_path}/m.csv", "value").collect()} == {("asphalt", "wheelchair", 100.0), ("asphalt", "blind", 90.0), ("sand", "wheelchair", 5.0), ("sand", "blind", None)}


def test_writers(spark, tmp_path):
    L.write_layer(lines(spark), f"{tmp_path}/layer", fill="?")
    back = spark.read.parquet(f"{tmp_path}/layer")
    assert "empty" not in back.columns and {(r["id"], r["surface"], r["layer"]) for r in back.collect()} == {(0, "?", "sidewalks"), (1, "asphalt", "sidewalks"), (2, "?", "sidewalks")}
    assert L.write_validated(lines(spark), f"{tmp_path}/valid")["rows"] == 3
    with pytest.raises(ValueError):
        L.write_validated(lines(spark).select("id"), f"{tmp_path}/bad")
    issues = spark.createDataFrame([("sidewalks", "missing_tags", "way", 1), ("sidewalks", "missing_tags", "way", 2), ("kerbs", "outdated", "node", 3)], "layer string, category string, element string, id long")
    L.export_issue_tables(issues, f"{tmp_path}/issues")
    assert spark.read.option("header", True).csv(f"{tmp_path}/issues").count() == 3
    assert {(r["layer"], tuple(sorted(r["ids"].split(",")))) for r in L.issue_id_query(issues).collect()} == {("sidewalks", ("1", "2")), ("kerbs", ("3",))}
    formats = spark.createDataFrame([("a.parquet",), ("b.GEOJSON",), ("c.xyz",)], "path string")
    assert [r[0] for r in formats.select(L.resource_format("path")).collect()] == ["GeoParquet", "GeoJSON", "XYZ"]


def test_projects(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps([{"projectId": 4, "name": "n", "projectInfo": {"name": None, "shortDescription": "d"}, "status": "ARCHIVED"}]))
    schema = "projectId long, name string, projectInfo struct<name:string,shortDescription:string>, status string"
    r = L.read_projects(spark, f"{tmp_path}/p.json", "tasking_manager", schema).first()
    assert (r["service"], r["id"], r["title"], r["description"], r["status"]) == ("tasking_manager", "4", "n", "d", "ARCHIVED")


def test_watermark(spark):
    state = spark.createDataFrame([("a", None), ("b", "2024-01-01"), ("c", "2024-02-01"), ("d", "2024-03-01")], "layer string, since string").selectExpr("layer", "cast(since as timestamp) AS since")
    plan = {r["layer"]: (r["action"], str(r["end"])[:10]) for r in feed.advance_watermark(state, "2024-02-01", "2024-06-01").collect()}
    assert plan == {"a": ("full", "2024-02-01"), "b": ("fetch", "2024-02-01"), "c": ("current", "2024-02-01"), "d": ("stale", "2024-02-01")}
    fetched = feed.advance_watermark(state, "2024-02-01", "2024-06-01").selectExpr("layer", "end", "layer in ('a', 'd') AS ok")
    got = {r["layer"]: str(r["since"])[:10] for r in feed.record_success(state, fetched).collect()}
    assert got == {"a": "2024-02-01", "b": "2024-01-01", "c": "2024-02-01", "d": "2024-03-01"}

"""Grades and hazards of single features."""

import pytest
from pyspark.sql import functions as F

from pednet.functions import geo, normalize
from pednet.operators import grading, hazards
from pednet.policies.profiles import DISTANCE, WHEELCHAIR

FIELDS = "surface string, smoothness string, width string, incline string, `incline:across` string, wheelchair string, highway string, crossing string, lit string, access string, foot string, associated_kerbs array<string>, associated_tactile_paving array<string>, associated_transition_states array<struct<kerb:string,tactile_paving:string,kerb_surface:string,sidewalk_surface:string>>, edge_kind string, slope_percent double, slope_source string, slope_confidence int"
NAMES = [x.split()[0].strip("`") for x in FIELDS.split(", ")]


def graded(spark, **tags):
    row = [tuple(tags.get(n) for n in NAMES)]
    df = grading.prepare_features(spark.createDataFrame(row, FIELDS))
    return grading.compact_grades(grading.grade_features(df)).first()


def hazard(spark, profile, **tags):
    df = grading.prepare_features(spark.createDataFrame([tuple(tags.get(n) for n in NAMES)], FIELDS))
    return hazards.compact_hazard(hazards.assess_hazards(df, profiles=(profile,)), profile).first()


def test_good_sidewalk(spark):
    r = graded(spark, edge_kind="sidewalk", surface="concrete", smoothness="excellent", width="1.8", incline="0%", wheelchair="yes", **{"incline:across": "0%"})
    assert (r["wheelchair_grade_fwd"], r["wheelchair_grade_bwd"]) == (100, 100)


def test_stairs(spark):
    r = graded(spark, edge_kind="stairs", highway="steps", slope_percent=5.0, slope_source="regional_dtm", slope_confidence=90)
    assert not r["wheelchair_allow_fwd"] and r["blind_allow_fwd"] and r["blind_grade_fwd"] <= 40


def test_directions(spark):
    r = graded(spark, edge_kind="sidewalk", slope_percent=10.0, slope_source="x", slope_confidence=45)
    assert r["wheelchair_grade_fwd"] < r["wheelchair_grade_bwd"]


def test_no_tags(spark):
    assert graded(spark, edge_kind="sidewalk")["wheelchair_confidence"] < 20


def test_raised_kerb(spark):
    assert graded(spark, edge_kind="crossing", associated_kerbs=["flush", "raised"])["wheelchair_grade_fwd"] <= 15


def test_limit(spark):
    r = graded(spark, edge_kind="sidewalk", surface="concrete", smoothness="excellent", width="2", incline="-10%", wheelchair="yes", **{"incline:across": "0%"})
    assert r["wheelchair_grade_bwd"] < r["wheelchair_grade_fwd"] and r["wheelchair_limit"] == "incline"


def test_hazards(spark):
    r = hazard(spark, "wheelchair", edge_kind="crossing", associated_kerbs=["raised"])
    assert (r["severity"], r["traversability"]) == (4, "impassable")
    assert hazard(spark, "wheelchair", edge_kind="crossing")["status"] == "insufficient_data"
    assert hazard(spark, "wheelchair", edge_kind="sidewalk", **{"incline:across": "6%"})["category_cross_slope"] == 4
    assert hazard(spark, "wheelchair", edge_kind="sidewalk", surface="sand")["category_surface"] == 4
    r = hazard(spark, "blind", edge_kind="sidewalk", incline="10%")
    assert (r["severity_fwd"], r["severity_bwd"]) == (1, 2)


def test_transition_pair(spark):
    state = lambda k, t: (k, t, None, None)
    r = hazard(spark, "blind", edge_kind="crossing", associated_transition_states=[state("flush", "no")])
    assert (r["severity"], r["traversability"]) == (4, "passable_with_extreme_risk")
    r = hazard(spark, "blind", edge_kind="crossing", associated_transition_states=[state("flush", "yes"), state("raised", "no")], associated_tactile_paving=["yes", "no"])
    assert r["severity"] == 3


@pytest.mark.parametrize("text, metres", [("1,25 m", 1.25), ("4'6\"", 1.3716), ("1.5;0.9", 0.9), ("?", None)])
def test_width(spark, text, metres):
    got = spark.createDataFrame([(text,)], "w string").select(normalize.parse_width_m("w")).first()[0]
    assert got == (None if metres is None else pytest.approx(metres))


@pytest.mark.parametrize("text, percent, kind", [("8.5%", 8.5, "numeric"), ("5°", 8.7489, "numeric"), ("up", None, "qualitative"), (None, None, "missing"), ("abc", None, "invalid")])
def test_incline(spark, text, percent, kind):
    got = spark.createDataFrame([(text,)], "w string").select(normalize.parse_incline("w").alias("i")).first()["i"]
    assert got["kind"] == kind and got["percent"] == (None if percent is None else pytest.approx(percent, abs=1e-4))


def test_timestamps(spark):
    df = spark.createDataFrame([("02/01/2026 03:04:00",), ("2026-01-02T03:04:00Z",), ("x",)], "t string")
    got = [r[0] for r in df.select(normalize.isoformat_utc(normalize.parse_timestamp("t", "Europe/Rome"))).collect()]
    assert got == ["2026-01-02T02:04:00Z", "2026-01-02T03:04:00Z", None]


def test_weights(spark):
    df = spark.createDataFrame([(100.0, "sidewalk", 100, True), (100.0, "stairs", 100, True), (100.0, "crossing", 30, True), (100.0, "sidewalk", 50, False)], "length_m double, edge_kind string, wheelchair_grade_fwd int, wheelchair_allow_fwd boolean")
    w = lambda p: [r[0] for r in df.select(grading.directional_weight(p, "fwd", F.lit(50.0))).collect()]
    assert w(DISTANCE) == [50.0] * 4
    assert w(WHEELCHAIR) == [50.0, float("inf"), 257.5, float("inf")]


def test_slope_and_geometry(spark):
    df = spark.createDataFrame([([0.0, 10.0, 20.0, 30.0, 40.0], [0.0, 1.0, 2.0, 30.0, 4.0]), ([0.0, 10.0, 20.0], [0.0, None, 2.0]), ([0.0], [1.0])], "d array<double>, h array<double>")
    assert [r[0] for r in df.select(geo.robust_slope("d", "h")).collect()] == [10.0, 10.0, None]
    c = spark.sql("select array(named_struct('lon', 0D, 'lat', 0D), named_struct('lon', 0.001D, 'lat', 0D)) as c")
    assert c.select(geo.length_m("c", 31)).first()[0] == pytest.approx(111.3, abs=0.3)
    assert c.select(geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.001), F.lit(0.0))).first()[0] == pytest.approx(111.195, abs=0.01)
    clip = spark.range(1).select(geo.clip(F.lit(-1.0), F.lit(0.5), F.lit(2.0), F.lit(0.5), F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("c")).first()["c"]
    assert (clip["lon1"], clip["lon2"]) == (pytest.approx(0), pytest.approx(1))


def test_audit_of_features_alike(spark, monkeypatch):
    rows = [tuple(t.get(n) for n in NAMES) for t in 5 * [{"edge_kind": "sidewalk", "surface": "sand"}] + 3 * [{"edge_kind": "crossing", "incline": "12%"}] + [{"edge_kind": "stairs"}]]
    df = spark.createDataFrame(rows, FIELDS).withColumn("id", F.monotonically_increasing_id())
    once = grading.alike(df)
    assert sorted(r["n_alike"] for r in once.collect()) == [1, 3, 5]  # grades are computed for three rows, not nine
    audit = lambda rows: sorted(grading.profile_audit(grading.compact_grades(grading.grade_features(grading.prepare_features(rows)))).collect())
    assert audit(once) == audit(df)

"""Themes: attributes summarised over several layers, for a whole area or a viewport."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pednet.functions.geo import clip, haversine_m
from pednet.operators.features import dedupe_features
from pednet.operators.summaries import categorical_summary, numeric_summary

# Themes as (layers, attribute, kind, breaks, invalid below). __layer__ counts by layer.
THEMES = {
    "footway_categories": (("sidewalks", "crossings", "other_footways"), "__layer__", "categorical", None, None),
    "crossings_and_kerbs": (("crossings", "kerbs"), "__layer__", "categorical", None, None),
    "surface": (("sidewalks", "crossings", "other_footways"), "surface", "categorical", None, None),
    "smoothness": (("sidewalks", "crossings", "other_footways"), "smoothness", "categorical", None, None),
    "crossing": (("crossings",), "crossing", "categorical", None, None),
    "kerb": (("kerbs",), "kerb", "categorical", None, None),
    "tactile_paving": (("kerbs", "crossings"), "tactile_paving", "categorical", None, None),
    "wheelchair": (("sidewalks", "crossings", "other_footways"), "wheelchair", "categorical", None, None),
    "age": (("sidewalks", "crossings", "kerbs", "other_footways"), "age", "numeric", [0, 2, 4, 10], 0),
    "n_revs": (("sidewalks", "crossings", "kerbs", "other_footways"), "n_revs", "numeric", [1, 2, 5, 10], 0),
}
LINE_LAYERS = ("sidewalks", "crossings", "other_footways")


def theme_summary(features: DataFrame, name: str, weight_km: str | None = None, themes=THEMES) -> DataFrame:
    """The summary of a theme (A8) with its status: ok, or unavailable where no layer has the attribute. Lengths only if all are lines."""
    layers, attribute, kind, breaks, invalid = themes[name]
    rows = features.where(F.col("layer").isin(*layers))
    there = attribute == "__layer__" or attribute in features.columns
    value = F.col("layer") if attribute == "__layer__" else F.col(attribute) if there else F.lit(None).cast("string")
    rows = rows.withColumn("__value", value)
    lines = weight_km if weight_km and set(layers) <= set(LINE_LAYERS) else None
    out = categorical_summary(rows, "__value", lines) if kind == "categorical" else numeric_summary(rows, "__value", breaks, invalid)
    return out.withColumns({"theme": F.lit(name), "status": F.lit("ok" if there else "unavailable"), "measure": F.lit("length" if lines else "count")})


def viewport_theme(features: DataFrame, name: str, bounds: tuple[float, float, float, float], themes=THEMES) -> DataFrame:
    """A theme of the features in a box (A9): features once, lengths clipped to it. features: layer, element, id, position, lon0 ... lat1."""
    w, s, e, n = bounds
    c = clip("lon0", "lat0", "lon1", "lat1", F.lit(float(w)), F.lit(float(s)), F.lit(float(e)), F.lit(float(n)))
    rows = dedupe_features(features).withColumn("__c", c).where("__c is not null")
    rows = rows.withColumn("km", haversine_m("__c.lon1", "__c.lat1", "__c.lon2", "__c.lat2") / 1000).drop("__c")
    return theme_summary(rows, name, "km", themes)


def valid_tag_domain(rows: DataFrame) -> DataFrame:
    """Accepted values of each layer and key (F15) from a property table (layer, key, value): no ?, and none of the measured keys."""
    measured = ("width", "incline", "incline:across")
    return rows.where((F.col("value") != "?") & ~F.col("key").isin(*measured)).groupBy("layer", "key").agg(F.array_sort(F.collect_set("value")).alias("accepted"))


def score_lookup(features: DataFrame, scores: DataFrame, key: str, default: float | None = None) -> DataFrame:
    """The score of each feature's value (N33). scores: layer, key, value, score; a policy table, which Spark broadcasts where its size allows."""
    s = scores.where(F.col("key") == key).select("layer", F.col("value").alias(key), "score")
    return features.join(s, ["layer", key], "left").withColumn("score", F.coalesce("score", F.lit(default).cast("double")))


def merge_tag_rules(*rules: dict[str, list[str]]) -> dict[str, list[str]]:
    """The lists of all rules by key, repeats kept."""
    keys = dict.fromkeys(k for r in rules for k in r)
    return {k: reduce(lambda a, r: a + list(r.get(k, [])), rules, []) for k in keys}


def latest_registry(registry: DataFrame) -> DataFrame:
    """The newest timestamp of a registry."""
    return registry.agg(F.max("ts").alias("latest"))


def select_columns(df: DataFrame, exclude_words: list[str]) -> DataFrame:
    """Without the columns whose name holds one of the words."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not any(w in c for w in exclude_words)])


def category_index(spark, about: dict[str, str] | None = None) -> DataFrame:
    """category, about and ISO 19157 classes (Q10)."""
    from pednet.operators.quality import ISO_19157

    return spark.createDataFrame([(k, (about or {}).get(k, k.replace("_", " ")), *v) for k, v in ISO_19157.items()], "category string, about string, iso_element string, iso_sub_element string")


def route_delta(df: DataFrame, km: str = "km", base_km: str = "base_km", same_km: float = 0.005) -> DataFrame:
    """Difference to the baseline in km and percent (N30); under same_km it counts as the same."""
    d = F.col(km) - F.col(base_km)
    return df.withColumns({"delta_km": d, "delta_percent": 100 * d / F.nullif(F.col(base_km), F.lit(0.0)), "same": F.abs(d) < same_km})

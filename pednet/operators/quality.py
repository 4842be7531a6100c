"""Data-quality issues of features as rows (layer, category, id, element, key, value, commentary)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys that do not belong on a layer, with the comment shown to mappers.
IMPROPER_KEYS = {
    "sidewalks": {
        "kerb": "sidewalks are drawn at path axis, kerb acess points should be literally at the kerb",
        "opening_hours": "if it has opening hours it may be a private pathway, not a sidewalk",
        "paving_stones": 'paving stones is a value for "surface key"',
        "crossing": "It's inappropriate for Sidewalks, probably mistakenly tagged",
        "barrier": "if there's a barrier it may be a node in the sidewalk, but not the sidewalk itself",
        "building": "sidewalks are not buildings",
    },
    "crossings": {
        "kerb": "kerbs are points, crossings are lines",
        "barrier": "a crossing with a barrier may not be an actual crossing...",
        "name": "most crossings have no name",
        "building": "crossings are not buildings",
    },
    "kerbs": {
        "opening_hours": "a crossing may have opening hours (brigdes?), but not a kerb",
        "crossing": "It's inappropriate for Kerbs, it's for crossings",
        "crossing_ref": "It's inappropriate for Kerbs, it's for crossings",
        "name": "most kerbs have no name",
        "building": "kerbs are not buildings",
    },
    "other_footways": {"kerb": "kerbs are points, other footways are lines", "building": "footways are not buildings"},
}
# Keys that hardly suit a layer, with the comment shown to mappers.
UNCANNY_KEYS = {
    "sidewalks": {"traffic_signals": "may be used for crossings", "name": "most sidewalks don't have an actual name"},
    "crossings": {"level": "according to wiki it may be used only for indoor or if bound to a floor..."},
    "kerbs": {
        "button_operated": "it may be referring to the crossing, may be OK",
        "traffic_signals:sound": "it may be referring to the crossing, may be OK",
        "traffic_signals:vibration": "it may be referring to the crossing, may be OK",
        "crossing:island": "if in the middle of a crossing It's fine!! ",
    },
    "other_footways": {},
}
# Values to be replaced on each layer and key, with the value to take.
REPLACEABLE = {
    "crossings": {
        "crossing": {
            "marked": "should use the tag 'crossing=uncontrolled' ",
            "zebra": "should use the tag 'crossing=uncontrolled' ",
            "island": "should use the tag 'crossing:island=yes' ",
        }
    }
}
# Characters that must not be in a value, with the comment.
INVALID_CHARACTERS = {"=": "The '=' character is used ONLY in textual representation of tags to separate the key from the value"}
# Tags that a layer should have, with the comment.
MISSING = {layer: {"surface": "Surface tag is recommended to assess accessibility"} for layer in ("sidewalks", "crossings", "other_footways")}
# ISO 19157 element and sub-element of each category.
_ATTRIBUTE = ("Thematic Accuracy", "Non-quantitative Attribute Accuracy")
_TOPOLOGY = ("Logical Consistency", "Topological Consistency")
ISO_19157 = {
    "improper_keys": _ATTRIBUTE,
    "uncanny_keys": _ATTRIBUTE,
    "keys_without_wiki": _ATTRIBUTE,
    "replaceable_values": _ATTRIBUTE,
    "wrong_mispelled_or_unlisted_values": _ATTRIBUTE,
    "invalid_characters": ("Logical Consistency", "Format Consistency"),
    "disjointed_geometries": _TOPOLOGY,
    "improper_geometries": ("Logical Consistency", "Conceptual Consistency"),
    "older_than_five_years": ("Temporal Accuracy", "Temporal Validity"),
    "crossings_lacking_kerbs": _TOPOLOGY,
    "kerb_on_top_of_non_crossing": _TOPOLOGY,
    "missing_tags": ("Completeness", "Omission (missing data)"),
}
OLD_YEARS = 5

ISSUE = "struct<category:string,key:string,value:string,commentary:string>"


def _issue(category: str, key: str, value, comment):
    return F.struct(F.lit(category).alias("category"), F.lit(key).alias("key"), value.cast("string").alias("value"), F.lit(comment).alias("commentary"))


def _first(candidates):
    """The first candidate that is not null, as an array of at most one."""
    return F.slice(F.filter(F.array(*candidates, F.lit(None).cast(ISSUE)), lambda x: x.isNotNull()), 1, 1)


def tag_issues(df: DataFrame, accepted: dict[str, dict[str, list[str]]] | None = None, undocumented: dict[str, list[str]] | None = None, improper=None, uncanny=None, replaceable=None, missing=None) -> DataFrame:
    """Q1 to Q6: one row for each issue of a feature's tags. df: layer, element, id and a tags map; one projection and one explode.
    accepted: per layer and key the listed values; undocumented: per layer the keys without documentation."""
    tag = lambda k: F.element_at("tags", F.lit(k))
    there = lambda k: tag(k).isNotNull() & (tag(k) != "")
    layer = F.col("layer")
    keyed = lambda category, rules: _first([F.when((layer == name) & there(k), _issue(category, k, tag(k), c)) for name, keys in rules.items() for k, c in keys.items()])
    found = [
        keyed("improper_keys", IMPROPER_KEYS if improper is None else improper),
        keyed("uncanny_keys", UNCANNY_KEYS if uncanny is None else uncanny),
        keyed("keys_without_wiki", {n: dict.fromkeys(ks, "key without documentation") for n, ks in (undocumented or {}).items()}),
        _first([F.when((layer == n) & (tag(k) == v), _issue("replaceable_values", k, tag(k), c)) for n, keys in (REPLACEABLE if replaceable is None else replaceable).items() for k, vs in keys.items() for v, c in vs.items()]),
        _first([F.when((layer == n) & there(k) & ~tag(k).isin(*vs), _issue("wrong_mispelled_or_unlisted_values", k, tag(k), "value not listed")) for n, keys in (accepted or {}).items() for k, vs in keys.items() if vs]),
        _first([F.when(F.exists(F.map_values("tags"), lambda v: F.contains(v, F.lit(c))), _issue("invalid_characters", "", F.element_at(F.filter(F.map_values("tags"), lambda v: F.contains(v, F.lit(c))), 1), text)) for c, text in INVALID_CHARACTERS.items()]),
        _first([F.when((layer == n) & ~F.coalesce(there(k), F.lit(False)), _issue("missing_tags", k, F.lit("?"), c)) for n, keys in (MISSING if missing is None else missing).items() for k, c in keys.items()]),
    ]
    return df.select("layer", "element", "id", F.inline(F.concat(*found)))


def outdated(df: DataFrame, years: float = OLD_YEARS) -> DataFrame:
    """Q7: features of that age or more."""
    return df.where(F.col("age") >= years).select("layer", "element", "id", F.lit("older_than_five_years").alias("category"), F.lit("age").alias("key"), F.bround("age", 2).cast("string").alias("value"), F.lit("not updated for years").alias("commentary"))


def geometry_issues(df: DataFrame, category: str, comment: str) -> DataFrame:
    """Q8: the rows of a geometric product as issues."""
    return df.select("layer", "element", "id", F.lit(category).alias("category"), F.lit("not appliable").alias("key"), F.lit("not appliable").alias("value"), F.lit(comment).alias("commentary"))


#: The geometric products of Q8 as (category, commentary).
GEOMETRIC = {"disjointed_geometries": "not connected to the network", "improper_geometries": "geometry does not suit the layer", "crossings_lacking_kerbs": "fewer than two kerbs", "kerb_on_top_of_non_crossing": "kerb that no crossing meets"}


def dq_geometry(disjointed: DataFrame, improper: DataFrame, crossings: DataFrame, kerbs: DataFrame) -> DataFrame:
    """The four geometric products as one table of issues (Q8); of improper geometries the element is the other one. All: layer, element, id."""
    from pednet.functions.normalize import invert_element

    improper = improper.withColumn("element", invert_element("element"))
    out = None
    for df, (category, comment) in zip((disjointed, improper, crossings, kerbs), GEOMETRIC.items(), strict=True):
        rows = geometry_issues(df, category, comment)
        out = rows if out is None else out.unionByName(rows)
    return out


def dq_issues(*issues: DataFrame) -> DataFrame:
    """All issues with their ISO 19157 class (Q9); rows without a value go."""
    iso = lambda i: F.create_map(*[F.lit(x) for k, v in ISO_19157.items() for x in (k, v[i])])[F.col("category")]
    out = issues[0]
    for df in issues[1:]:
        out = out.unionByName(df)
    return out.where("value is not null").withColumns({"iso_element": iso(0), "iso_sub_element": iso(1)})


def dq_totals(issues: DataFrame) -> DataFrame:
    """Counts per category and layer, with totals of each and of all."""
    return issues.cube("category", "layer").agg(F.count("*").alias("n"), F.grouping_id().alias("gid")).select(F.when(F.col("gid").bitwiseAND(F.lit(2)) == 0, F.col("category")).otherwise("(all)").alias("category"), F.when(F.col("gid").bitwiseAND(F.lit(1)) == 0, F.col("layer")).otherwise("(all)").alias("layer"), "n")


def issue_points(issues: DataFrame, features: DataFrame) -> DataFrame:
    """One row for each feature with issues: categories, layers, distinct issues and its point."""
    per = issues.groupBy("element", "id").agg(F.array_sort(F.collect_set("category")).alias("categories"), F.array_sort(F.collect_set("layer")).alias("layers"), F.collect_set(F.struct("category", "key", "value")).alias("issues"))
    return per.join(features.groupBy("element", "id").agg(F.min(F.struct("lon", "lat")).alias("point")), ["element", "id"], "left")

"""Classification, filters and de-duplication of features. One pass over rows unless a window is named."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The tags that put a feature in a layer; layers are tried in this order.
OTHER_FOOTWAY = {
    "highway": ["footway", "steps", "living_street", "pedestrian", "track", "path"],
    "foot": ["yes", "designated", "permissive", "destination"],
    "footway": ["alley", "path", "yes"],
    "sidewalk": ["no"],
    "sidewalk:both": ["no"],
}
LAYERS = {
    "kerbs": {"kerb": ["lowered", "raised", "flush", "rolled", "no", "yes"], "barrier": ["kerb"]},
    "sidewalks": {"footway": ["sidewalk"]},
    "crossings": {"footway": ["crossing"]},
    "other_footways": OTHER_FOOTWAY,
}
# Tags that exclude a feature before the split.
EXCLUDED = {
    "highway": ["trunk", "motorway", "primary", "secondary", "trunk_link", "motorway_link", "primary_link", "secondary_link"],
    "access": ["no", "private"],
    "foot": ["no", "use_sidepath", "private"],
}
# Classes of other footways, in order.
FOOTWAY_CLASSES = {
    "stairways": {"highway": ["steps"]},
    "main_footways": {"highway": ["footway", "living_street", "pedestrian"], "foot": ["designated"], "footway": ["alley", "path", "yes"]},
    "potential_footways": {"highway": ["path", "track"]},
    "informal_footways": {"foot": ["yes", "permissive"]},
}
# Geometry types of each layer.
GEOMETRIES = {"sidewalks": ["LineString"], "crossings": ["LineString"], "kerbs": ["Point"], "other_footways": ["LineString", "Polygon", "MultiPolygon"]}


def tag_match(df: DataFrame, rules: dict[str, list[str]], mode: str = "any", reverse: bool = False, strict: bool = False) -> Column:
    """Whether any (or all) of the listed columns hold a listed value (F1). Absent columns and nulls never match. strict: with mode all,
    a match needs every column of df to be listed, as a frame-wide comparison would."""
    tests = [F.coalesce(F.col(f"`{k}`").isin(*v), F.lit(False)) if k in df.columns else F.lit(False) for k, v in rules.items()]
    test = reduce(or_ if mode == "any" else and_, tests, F.lit(mode != "any" and not (strict and set(df.columns) - set(rules))))
    return ~test if reverse else test


def exclude_features(df: DataFrame, rules=EXCLUDED) -> DataFrame:
    """Without major roads and restricted ways (F2)."""
    return df.where(tag_match(df, rules, reverse=True))


def split_layers(df: DataFrame, layers=LAYERS, column: str = "layer") -> DataFrame:
    """The first layer whose tags match; rows without one go."""
    out = None
    for name, rules in layers.items():
        test = tag_match(df, rules)
        out = F.when(test, name) if out is None else out.when(test, name)
    return df.withColumn(column, out).where(F.col(column).isNotNull())


def classify_element() -> Column:
    """The layer of an element of a diff, by its type too (C2); columns element, footway, kerb, barrier, highway, foot."""
    way, node = F.col("element") == "way", F.col("element") == "node"
    other = F.col("highway").isin(*OTHER_FOOTWAY["highway"]) | F.col("foot").isin(*OTHER_FOOTWAY["foot"]) | F.col("footway").isin(*OTHER_FOOTWAY["footway"])
    return (
        F.when(way & (F.col("footway") == "sidewalk"), "sidewalks")
        .when(way & (F.col("footway") == "crossing"), "crossings")
        .when(node & ((F.col("barrier") == "kerb") | F.col("kerb").isNotNull()), "kerbs")
        .when(way & other, "other_footways")
    )


def split_other_footways(df: DataFrame, classes=FOOTWAY_CLASSES, column: str = "footway_class") -> DataFrame:
    """Polygons are pedestrian areas; then the first class that matches; else null."""
    out = F.when(F.col("geom_type").isin("Polygon", "MultiPolygon"), "pedestrian_areas")
    for name, rules in classes.items():
        out = out.when(tag_match(df, rules), name)
    return df.withColumn(column, out)


def proper_geometry(df: DataFrame, types=GEOMETRIES) -> tuple[DataFrame, DataFrame]:
    """Rows whose geometry suits their layer, and the others."""
    ok = F.coalesce(reduce(or_, [(F.col("layer") == k) & F.col("geom_type").isin(*v) for k, v in types.items()]), F.lit(False))
    return df.where(ok), df.where(~ok & (F.col("layer") != "other_footways"))


def routable_lines(df: DataFrame) -> DataFrame:
    """Lines, one row a part (F5): parts is an array of vertex arrays."""
    return df.where(F.col("geom_type").isin("LineString", "MultiLineString") & (F.size("parts") > 0)).select("*", F.posexplode("parts").alias("part", "coords")).drop("parts").where(F.size("coords") > 1)


def attribute_filter(df: DataFrame, expr: str) -> DataFrame:
    """Rows that a SQL predicate holds for (F8)."""
    return df.where(expr)


def age_lookup(raw: DataFrame, processed: DataFrame) -> DataFrame:
    """raw with the age its processed feature has (J2), by layer and id; null where there is none."""
    ages = processed.groupBy("layer", "id").agg(F.max("age").alias("age"))
    return raw.drop("age").join(ages, ["layer", "id"], "left")


def keyword_match(df: DataFrame, keywords: list[str]) -> DataFrame:
    """Rows whose title or description holds a keyword, with those it holds."""
    text = F.lower(F.concat_ws(" ", "title", "description"))
    hit = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(text, F.lower(k)))
    return df.withColumn("matched_keywords", hit).where(F.size("matched_keywords") > 0)


def merge_projects(df: DataFrame) -> DataFrame:
    """One row for each (service, instance, id), with all keywords (A26); other columns are those of the first position."""
    keys = ["service", "instance", "id"]
    rest = [c for c in df.columns if c not in (*keys, "matched_keywords", "position")]
    return df.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("matched_keywords")))).alias("matched_keywords"), *[F.min_by(c, "position").alias(c) for c in rest])


def dedupe_features(df: DataFrame, position: str = "position") -> DataFrame:
    """The first row of each (layer, element, id); rows without an id stay."""
    key = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("anonymous-"), F.col(position).cast("string")))
    w = Window.partitionBy("layer", "element", key).orderBy(position)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def keep_last(df: DataFrame, keys=("element", "id"), position: str = "position") -> DataFrame:
    """The last row of each key (W2), by one aggregation with map-side combine."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in df.columns if c not in keys]), position).alias("r")).select(*keys, "r.*")


def attach_versioning(df: DataFrame, versions: DataFrame, as_of: str) -> DataFrame:
    """last_update, age and n_revs of each feature (J1); of several versions the one of most revisions; ids without a version get nulls."""
    from pednet.functions.normalize import age_years, last_update

    newest = versions.groupBy("osmid").agg(F.max_by(F.struct("n_revs", "rev_day", "rev_month", "rev_year"), F.struct("n_revs", "rev_year", "rev_month", "rev_day")).alias("v")).select("osmid", "v.*")
    v = newest.select(F.col("osmid").alias("id"), last_update("rev_day", "rev_month", "rev_year").alias("last_update"), age_years("rev_year", "rev_month", "rev_day", as_of).alias("age"), "n_revs")
    return df.join(v, "id", "left")


def rank_boundaries(df: DataFrame) -> DataFrame:
    """The best boundary candidate: administrative ones first, then importance."""
    return df.orderBy(F.desc(F.col("type") == "administrative"), F.desc("importance")).limit(1)

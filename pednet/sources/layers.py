"""Reading and writing layers, change feeds, catalogues and inventories with Spark's own formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pednet.functions.normalize import parse_timestamp

# Highway classes that count as roads.
ROADS = ("motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "motorway_link", "trunk_link", "primary_link", "secondary_link", "tertiary_link")


def read_layers(spark: SparkSession, root: str, layers=("kerbs", "sidewalks", "crossings", "other_footways")) -> DataFrame:
    """One table of all layers with a layer column (S1, U1); columns that a layer lacks are null."""
    out = None
    for name in layers:
        df = spark.read.parquet(f"{root}/{name}").withColumn("layer", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of a collection: properties as a map of texts, geometry type and its coordinates as JSON."""
    schema = "features array<struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>>"
    rows = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f"))
    return rows.select(F.col("f.properties").alias("tags"), F.col("f.geometry.type").alias("geom_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def line_coords(coordinates: Column, geom_type: Column) -> Column:
    """Vertices of a GeoJSON line from its JSON coordinates."""
    return F.when(geom_type == "LineString", F.transform(F.from_json(coordinates, "array<array<double>>"), lambda p: F.struct(p[0].alias("lon"), p[1].alias("lat"))))


def read_versioning(spark: SparkSession, path: str) -> DataFrame:
    """osmid, n_revs and revision date from a column-oriented JSON file: {column: {row: value}} (S3)."""
    columns = ("osmid", "n_revs", "rev_day", "rev_month", "rev_year")
    raw = spark.read.schema(", ".join(f"{c} map<string,bigint>" for c in columns)).json(path, multiLine=True)
    out = None
    for c in columns:
        one = raw.select(F.explode(c).alias("row", c))
        out = one if out is None else out.join(one, "row", "left")
    return out.drop("row")


def read_registry(spark: SparkSession, path: str, tz: str = "UTC") -> DataFrame:
    """key and timestamp of a JSON map."""
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "text"))
    return raw.select("key", parse_timestamp("text", tz).alias("ts"))


def read_roads(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the road classes."""
    return spark.read.parquet(path).where(F.col("highway").isin(*ROADS) & F.col("geom_type").isin("LineString", "MultiLineString"))


def read_contributions(spark: SparkSession, path: str) -> DataFrame:
    """Changes from a contribution collection: element, id, flags and tags; rows with a malformed id go."""
    f = read_geojson(spark, path)
    at = lambda k: F.element_at("tags", F.lit(k))
    parts = F.split(at("@osmId"), "/")
    flag = lambda k: F.coalesce(F.lower(at(k)) == "true", F.lit(False))
    rows = f.select(
        F.get(parts, F.lit(0)).alias("element"), F.get(parts, F.lit(1)).try_cast("long").alias("id"), flag("@creation").alias("creation"), flag("@tagChange").alias("tag_change"),
        flag("@geometryChange").alias("geometry_change"), flag("@deletion").alias("deletion"), at("@contributionChangesetId").try_cast("long").alias("changeset_id"),
        parse_timestamp(at("@timestamp")).alias("ts"), F.map_filter("tags", lambda k, v: ~k.startswith("@")).alias("tags"), "geom_type", "coordinates",
    )
    return rows.where(F.col("id").isNotNull() & F.col("element").isin("node", "way", "relation"))


_TAG = "array<struct<_k:string,_v:string>>"
_BLOCK = ",".join(f"{e}:array<struct<_id:bigint,_changeset:bigint,_timestamp:string,tag:{_TAG}>>" for e in ("node", "way", "relation"))


def read_osmchange(spark: SparkSession, path: str) -> DataFrame:
    """action, element, id, changeset_id and tags of each entry of a change file."""
    schema = ", ".join(f"{a} array<struct<{_BLOCK}>>" for a in ("create", "modify", "delete"))
    raw = spark.read.format("xml").option("rowTag", "osmChange").schema(schema).load(path)
    out = None
    for action in ("create", "modify", "delete"):
        for element in ("node", "way", "relation"):
            rows = raw.select(F.explode(action).alias("b")).select(F.explode(f"b.{element}").alias("e"))
            rows = rows.select(F.lit(action).alias("action"), F.lit(element).alias("element"), F.col("e._id").alias("id"), F.col("e._changeset").alias("changeset_id"), F.map_from_entries(F.coalesce("e.tag", F.array().cast(_TAG))).alias("tags"))
            out = rows if out is None else out.unionByName(rows)
    return out


def read_changesets(spark: SparkSession, path: str) -> DataFrame:
    """id, user, times, changes and comment of changesets that change something."""
    raw = spark.read.format("xml").option("rowTag", "changeset").schema(f"_id bigint, _user string, _created_at string, _closed_at string, _changes_count int, tag {_TAG}").load(path)
    tags = F.map_from_entries(F.coalesce("tag", F.array().cast(_TAG)))
    return raw.where("_changes_count > 0").select(F.col("_id").alias("changeset_id"), F.col("_user").alias("user"), parse_timestamp("_created_at").alias("created_at"), parse_timestamp("_closed_at").alias("closed_at"), F.col("_changes_count").alias("changes"), F.element_at(tags, F.lit("comment")).alias("comment"))


def read_lookup_matrix(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A wide score matrix as (key, column, score) rows."""
    raw = spark.read.csv(path, header=True)
    return raw.unpivot(key, [c for c in raw.columns if c != key], "column", "score").withColumn("score", F.col("score").try_cast("double"))


def drop_all_null_columns(df: DataFrame, keep=("geometry",)) -> DataFrame:
    """Without columns that hold nothing, found by one aggregation."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if counts[c] or c in keep])


def write_layer(df: DataFrame, path: str, drop_empty: bool = True, fill: str | None = None, partition: str | None = "layer") -> None:
    """Write a layer (S11): columns without values go, nulls of texts may be filled."""
    out = drop_all_null_columns(df) if drop_empty else df
    out = out if fill is None else out.na.fill(fill)
    writer = out.write.mode("overwrite")
    (writer.partitionBy(partition) if partition and partition in out.columns else writer).parquet(path)


def write_validated(df: DataFrame, path: str) -> dict:
    """Write, read again and compare row counts (S12); Spark's commit keeps readers from partial files."""
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    expected, got = df.count(), back.count()
    if expected != got or not {"geom_type", "coords"} & set(back.columns):
        raise ValueError(f"{path}: {got} rows written of {expected}")
    return {"path": path, "rows": got, "columns": back.columns}


def export_features_jsonl(df: DataFrame, path: str) -> None:
    """One GeoJSON feature a line."""
    geometry = F.struct(F.lit("LineString").alias("type"), F.transform("coords", lambda p: F.array(p["lon"], p["lat"])).alias("coordinates"))
    rest = F.struct(*[F.col(c) for c in df.columns if c not in ("coords", "geom_type")])
    df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), rest.alias("properties")))).write.mode("overwrite").text(path)


def export_issue_tables(issues: DataFrame, path: str, kind: str = "csv") -> None:
    """Issues by layer and category."""
    issues.write.mode("overwrite").partitionBy("layer", "category").format(kind).option("header", True).save(path)


def union_layers_view(spark: SparkSession, paths: dict[str, str], name: str) -> DataFrame:
    """A view over several layer files."""
    out = None
    for layer, path in paths.items():
        df = spark.read.parquet(path).withColumn("layer", F.lit(layer))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    out.createOrReplaceTempView(name)
    return out


def resource_format(path):
    """Suffix as a format name."""
    suffix = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    names = {"parquet": "GeoParquet", "json": "JSON", "geojson": "GeoJSON", "csv": "CSV", "xml": "XML", "pmtiles": "PMTiles", "html": "HTML"}
    return F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[suffix], F.upper(suffix))


def resource_inventory(spark: SparkSession, root: str, checksums: bool = True) -> DataFrame:
    """path, bytes, checksum, format and folder of each file under root (S16); hidden and temporary files are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    files = files.where(~F.col("path").rlike(r"/[._][^/]*$|\.tmp$"))
    sha = F.sha2("content", 256) if checksums else F.lit(None).cast("string")
    return files.select("path", F.col("length").alias("bytes"), sha.alias("sha256"), resource_format(F.col("path")).alias("format"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"))


def catalogue_diff(inventory: DataFrame, records: DataFrame) -> DataFrame:
    """path and status: missing_record, orphan_record or checksum_mismatch."""
    i, r = inventory.select("path", F.col("sha256").alias("a")), records.select("path", F.col("sha256").alias("b"), F.lit(1).alias("rec"))
    both = i.withColumn("inv", F.lit(1)).join(r, "path", "full_outer")
    status = F.when(F.col("rec").isNull(), "missing_record").when(F.col("inv").isNull(), "orphan_record").when(~F.col("a").eqNullSafe(F.col("b")), "checksum_mismatch")
    return both.select("path", status.alias("status")).where("status is not null")


def write_feed(daily: DataFrame) -> DataFrame:
    """date and text of each day with activity, newest first."""
    lines = F.array_join(F.array_sort(F.collect_list(F.when(F.col("count") > 0, F.concat_ws(": ", "layer", F.col("count").cast("string"))))), "\n")
    return daily.groupBy("date").agg(F.sum("count").alias("total"), lines.alias("text")).where("total > 0").orderBy(F.desc("date"))


def issue_id_query(issues: DataFrame) -> DataFrame:
    """Comma-joined ids by element of each layer and category."""
    return issues.groupBy("layer", "category", "element").agg(F.listagg(F.col("id").cast("string"), F.lit(",")).alias("ids"))


#: Project catalogues: service -> how its JSON becomes the common columns (S9); add an entry for another service.
PROJECT_SHAPES = {
    "tasking_manager": {"id": "projectId", "title": "coalesce(projectInfo.name, name)", "description": "projectInfo.shortDescription", "status": "status"},
    "maproulette": {"id": "id", "title": "name", "description": "description", "status": "cast(status as string)"},
    "mapswipe": {"id": "projectId", "title": "name", "description": "projectDetails", "status": "status"},
}


def read_projects(spark: SparkSession, path: str, service: str, schema: str) -> DataFrame:
    """Projects of a service in the common columns."""
    raw = spark.read.schema(schema).json(path, multiLine=True)
    return raw.select(F.lit(service).alias("service"), F.input_file_name().alias("instance"), *[F.expr(x).cast("string").alias(c) for c, x in PROJECT_SHAPES[service].items()])

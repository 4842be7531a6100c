"""Summaries of attributes by count, length and diversity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def label(c: Column) -> Column:
    """A value's label in summaries: trimmed; null, blank, NaN and ? are ?."""
    t = F.btrim(c.cast("string"))
    return F.when(t.isNull() | t.isin("", "?") | (F.lower(t) == "nan"), "?").otherwise(t)


def value_counts(df: DataFrame, field: str) -> DataFrame:
    """value, n and share of the values that are not null (A1)."""
    c = df.where(F.col(field).isNotNull()).groupBy(F.col(field).alias("value")).agg(F.count("*").alias("n"))
    return c.crossJoin(c.agg(F.sum("n").alias("__all"))).select("value", "n", F.bround(100 * F.col("n") / F.col("__all"), 2).alias("share"))  # one row of totals


def bar_aggregate(df: DataFrame, field: str, weight: str | None = None, color: str | None = None, drop_unknown: bool = False, exclude=()) -> DataFrame:
    """Features and weight for each value (A2)."""
    rows = df.where(F.col(field).isNotNull())
    if drop_unknown:
        rows = rows.where(F.col(field) != "?")
    if exclude:
        rows = rows.where(~F.col(field).isin(*exclude))
    more = [F.sum(color).alias("color")] if color else []
    return rows.groupBy(F.col(field).alias("value")).agg(F.count("*").alias("n"), (F.sum(weight) if weight else F.count("*").cast("double")).alias("weight"), *more)


def crosstab(df: DataFrame, x: str, y: str) -> DataFrame:
    """Counts of pairs, of each x and each y, and of all (A3): null marks a total, so x and y are labelled first."""
    rows = df.select(label(F.col(x)).alias("x"), label(F.col(y)).alias("y"))
    return rows.cube("x", "y").agg(F.count("*").alias("n"))


def box_hist(df: DataFrame, column: str, by: str | None = None, step: float = 1.0) -> DataFrame:
    """Five numbers and Tukey whiskers, and a histogram of the given step, for each group (A4)."""
    key = F.lit("all") if by is None else F.coalesce(F.col(by).cast("string"), F.lit("?"))
    rows = df.where(F.col(column).isNotNull()).select(key.alias("by"), F.col(column).cast("double").alias("v"))
    q = rows.groupBy("by").agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("greatest"))
    q = q.select("by", "n", "least", "greatest", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumns({"low": F.greatest("least", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))), "high": F.least("greatest", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))})
    bins = rows.groupBy("by", (F.floor(F.col("v") / step) * step).alias("bin")).agg(F.count("*").alias("c")).groupBy("by").agg(F.array_sort(F.collect_list(F.struct("bin", "c"))).alias("histogram"))
    return q.join(bins, "by")


def categorical_summary(df: DataFrame, value: str, weight_km: str | None = None) -> DataFrame:
    """One row: total, known, unknown and their lengths, dominant value, Shannon entropy, effective diversity, and the values."""
    rows = df.select(label(F.col(value)).alias("v"), (F.coalesce(F.col(weight_km), F.lit(0.0)) if weight_km else F.lit(0.0)).cast("double").alias("km"))
    per = rows.groupBy("v").agg(F.count("*").alias("n"), F.sum("km").alias("km"))
    every = Window.partitionBy()
    known = F.sum(F.when(F.col("v") != "?", F.col("n"))).over(every)
    per = per.withColumn("known", F.coalesce(known, F.lit(0))).withColumn("p", F.when(F.col("v") != "?", F.col("n") / known))
    listed = F.filter(F.collect_list(F.when(F.col("v") != "?", F.struct((-F.col("n")).alias("k"), F.col("v").alias("value"), "n", F.bround(100 * F.col("p"), 2).alias("percent"), F.col("km")))), lambda r: r.isNotNull())
    out = per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.max("known"), F.lit(0)).alias("known"), F.coalesce(F.sum(F.when(F.col("v") == "?", F.col("n"))), F.lit(0)).alias("unknown"),
        F.sum("km").alias("km"), F.sum(F.when(F.col("v") == "?", F.col("km"))).alias("unknown_km"),
        F.bround(-F.sum(F.col("p") * F.log("p")), 6).alias("entropy"), F.array_sort(listed).alias("values"),
    )
    return out.withColumns({"dominant": F.get("values", F.lit(0))["value"], "diversity": F.bround(F.exp("entropy"), 6), "values": F.transform("values", lambda r: r.dropFields("k"))})


def numeric_summary(df: DataFrame, value: str, breaks: list[float], invalid_below: float | None = None) -> DataFrame:
    """One row: unknown, invalid and valid values, bins (the first takes all below the second break), least, greatest, mean, median."""
    v = F.col(value).cast("double")
    v = F.when(F.isnan(v), None).otherwise(v)
    bad = (v < invalid_below) if invalid_below is not None else F.lit(False)
    rows = df.select(v.alias("v"), F.coalesce(bad, F.lit(False)).alias("bad")).withColumn("x", F.when(~F.col("bad"), F.col("v")))
    place = F.greatest(F.lit(0), F.size(F.filter(F.array(*[F.lit(float(b)) for b in breaks]), lambda b: b <= F.col("x"))) - 1)
    rows = rows.withColumn("bin", F.when(F.col("x").isNotNull(), place))
    return rows.agg(
        F.count_if(F.col("v").isNull()).alias("unknown"), F.count_if("bad").alias("invalid"), F.count("x").alias("valid"),
        F.array(*[F.count_if(F.col("bin") == i) for i in range(len(breaks))]).alias("bins"),
        F.bround(F.min("x"), 6).alias("least"), F.bround(F.max("x"), 6).alias("greatest"), F.bround(F.avg("x"), 6).alias("mean"), F.bround(F.percentile("x", 0.5), 6).alias("median"),
    )


def collapse_tail(df: DataFrame, n: int = 8) -> DataFrame:
    """The n commonest known values, the rest as one row, and the unknown (A10). df: value, n."""
    r = F.row_number().over(Window.partitionBy(F.col("value") == "?").orderBy(F.desc("n"), "value"))
    name = F.when(F.col("value") == "?", "Unknown").when(F.col("r") <= n, F.col("value")).otherwise("Other known")
    rows = df.withColumn("r", r).withColumn("name", name)
    return rows.groupBy("name").agg(F.sum("n").alias("n"), F.count("*").alias("values"), F.min(F.when(F.col("name") == "Unknown", 1 << 30).otherwise(F.least("r", F.lit(n + 1)))).alias("place"))


def feature_keys(df: DataFrame) -> DataFrame:
    """Distinct values and features of each key on each layer, from the tags map."""
    return df.select("layer", F.explode("tags").alias("key", "value")).where("value is not null").groupBy("layer", "key").agg(F.count("*").alias("n"), F.countDistinct("value").alias("n_values"))


def total_bounds(df: DataFrame) -> DataFrame:
    """Bounds of all rows' xmin, ymin, xmax, ymax."""
    return df.agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"), F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


#: name: (layer or all, operator, column[, second column]): the dashboard's analyses, over columns users map (A5).
ANALYSES = {
    f"{layer}_{column}": (layer, "bar", column)
    for layer, columns in {"sidewalks": ("surface", "smoothness", "width", "wheelchair"), "crossings": ("surface", "crossing"), "other_footways": ("surface", "highway"), "kerbs": ("kerb", "tactile_paving")}.items()
    for column in columns
} | {f"{layer}_surface_smoothness": (layer, "crosstab", "surface", "smoothness") for layer in ("sidewalks", "crossings", "other_footways")} | {f"{layer}_n_revs": (layer, "box", "n_revs") for layer in ("sidewalks", "crossings", "kerbs", "other_footways", "all")}


def analysis(df: DataFrame, name: str) -> DataFrame:
    """One of ANALYSES over a table of features with a layer column."""
    layer, kind, *columns = ANALYSES[name]
    rows = df if layer == "all" else df.where(F.col("layer") == layer)
    if kind == "bar":
        return bar_aggregate(rows, columns[0])
    if kind == "crosstab":
        return crosstab(rows, *columns)
    return box_hist(rows.withColumn(columns[0], F.nullif(F.col(columns[0]), F.lit(-1))), columns[0], by="layer")

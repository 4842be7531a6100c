"""Hazard assessments of features per profile and direction: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pednet.functions.normalize import is_unknown
from pednet.operators.rules import applies, condition
from pednet.policies.hazards import CATEGORIES, PROFILES, RULES, TRAVERSABILITY


def coverage() -> Column:
    """Percent of the evidence that is known: five items, eight on crossings (H5)."""
    known = [~is_unknown("surface"), ~is_unknown("smoothness"), F.col("incline_percent").isNotNull(), F.col("cross_slope_percent").isNotNull(), ~is_unknown("wheelchair")]
    more = [F.size("associated_kerbs") > 0, F.size("associated_tactile_paving") > 0, F.size("associated_transition_states") > 0]
    total = lambda xs: sum((x.cast("int") for x in xs), F.lit(0))
    return F.bround(F.when(F.col("edge_kind") == "crossing", total(known + more) / 8).otherwise(total(known) / 5) * 100).cast("int")


def hits(rules, sign: int = 1) -> dict[str, Column]:
    """Whether each rule holds (H1); directional ones for the direction of this sign."""
    kind = F.coalesce("edge_kind", F.lit("footway"))
    field = lambda name: F.col("incline_percent") * sign if name == "directional_incline_percent" else F.col(name)
    return {r.id: applies(r.applies_to, kind) & condition(r.condition, field) for r in rules}


def sureness(rule) -> Column:
    """A rule's confidence, no more than that of the slope it tests (H2)."""
    slope = {"longitudinal_slope": "incline_confidence", "cross_slope": "cross_slope_confidence"}.get(rule.category)
    return F.least(F.lit(rule.confidence), F.col(slope)) if slope else F.lit(rule.confidence)


def greatest(terms: list[Column], least) -> Column:
    return F.greatest(*terms, F.lit(least), F.lit(least))


def listed(terms: list[Column], some: Column) -> Column:
    """The terms that aren't null as an array, where some holds; else an empty one."""
    mark = "\x1f"
    return F.when(some, F.split(F.concat_ws(mark, *terms), mark)).otherwise(F.array().cast("array<string>"))


def assessment(rules: list, hit: dict[str, Column], profile: str, severity: Column, cover: Column) -> Column:
    """The overall verdict of a direction (H3, H4): decisive rules are those of the greatest severity that holds."""
    decisive = [(r, hit[r.id] & (severity == r.effects[profile][0]), r.effects[profile]) for r in rules]
    names = F.array(*[F.lit(t) for t in TRAVERSABILITY])
    worst = greatest([F.when(d, TRAVERSABILITY.index(rest[0]) if rest else 0) for _, d, (_, _, *rest) in decisive], 0)
    by = [greatest([F.when(hit[r.id], r.effects[profile][0]) for r in rules if r.category == c], 0).alias(c) for c in CATEGORIES]
    found = severity > 0
    return F.struct(
        severity.alias("severity"),
        F.array_sort(F.array_distinct(listed([F.when(d, e[1]) for _, d, e in decisive], found))).alias("impact"),
        F.get(names, worst).alias("traversability"),
        F.when(found, F.greatest(*[F.when(d, sureness(r)) for r, d, _ in decisive], F.lit(None).cast("int"), F.lit(None).cast("int"))).otherwise(cover).alias("confidence"),
        cover.alias("coverage"),
        F.when(found, "hazard_detected").when(cover >= 60, "no_detected_hazard").otherwise("insufficient_data").alias("status"),
        listed([F.when(d, r.id) for r, d, _ in decisive], found).alias("rule_ids"),
        F.struct(*by).alias("categories"),
    )


def assess_hazards(df: DataFrame, rules=RULES, profiles=PROFILES) -> DataFrame:
    """prepare_features(df) with <profile>_hazard_fwd and _bwd. The rules are known when the plan is made, so maxima are written out over
    them, as scalar expressions that Spark compiles; what holds is computed once for all profiles, and for both directions where these
    don't matter."""
    sides = (("fwd", 1), ("bwd", -1))
    both = {f"__hit_{k}": c for k, c in hits([r for r in rules if not r.directional]).items()}
    each = {s: {f"__hit_{s}_{k}": c for k, c in hits([r for r in rules if r.directional], sign).items()} for s, sign in sides}
    df = df.withColumns({"__cover": coverage()} | both | each["fwd"] | each["bwd"])
    hit = {s: {r.id: F.col(f"__hit_{s}_{r.id}" if r.directional else f"__hit_{r.id}") for r in rules} for s, _ in sides}
    of = {p: [r for r in rules if p in r.effects] for p in profiles}
    tops = {f"__top_{p}_{s}": greatest([F.when(hit[s][r.id], r.effects[p][0]) for r in of[p]], 0) for p in profiles for s, _ in sides}
    df = df.withColumns(tops)
    df = df.withColumns({f"{p}_hazard_{s}": assessment(of[p], hit[s], p, F.col(f"__top_{p}_{s}"), F.col("__cover")) for p in profiles for s, _ in sides})
    return df.drop("__cover", *both, *each["fwd"], *each["bwd"], *tops)


def compact_hazard(df: DataFrame, profile: str) -> DataFrame:
    """The worse direction's verdict, and the greater severity of each category (H6)."""
    f, b = F.col(f"{profile}_hazard_fwd"), F.col(f"{profile}_hazard_bwd")
    rank = lambda x: F.struct(x["severity"], (x["traversability"] == TRAVERSABILITY[-1]).cast("int"), x["confidence"])
    worst = F.when(rank(f) >= rank(b), f).otherwise(b)
    df = df.withColumn("__w", worst)
    keep = [c for c in df.columns if c not in ("__w", f"{profile}_hazard_fwd", f"{profile}_hazard_bwd")]
    w = F.col("__w")
    return df.select(*keep, w["severity"].alias("severity"), f["severity"].alias("severity_fwd"), b["severity"].alias("severity_bwd"), *[w[c].alias(c) for c in ("impact", "traversability", "confidence", "coverage", "status", "rule_ids")], *[F.greatest(f["categories"][c], b["categories"][c]).alias(f"category_{c}") for c in CATEGORIES])


def hazard_view(df: DataFrame, category: str = "all", min_severity: int = 0, min_confidence: int = 0, include_unknown: bool = False) -> DataFrame:
    """Features to show."""
    severity = F.col("severity") if category == "all" else F.col(f"category_{category}")
    known = (F.col("status") != "insufficient_data") & (F.coalesce(severity, F.lit(0)) >= min_severity) & (F.coalesce("confidence", F.lit(0)) >= min_confidence)
    return df.where(known | (F.col("status") == "insufficient_data") if include_unknown else known)


def hazard_audit(df: DataFrame) -> DataFrame:
    """Counts by severity, status and decisive rule, as (kind, value, n)."""
    rows = df.select(F.explode(F.concat(F.array(F.struct(F.lit("severity").alias("kind"), F.col("severity").cast("string").alias("value")), F.struct(F.lit("status").alias("kind"), F.col("status").alias("value"))), F.transform("rule_ids", lambda r: F.struct(F.lit("rule").alias("kind"), r.alias("value"))))).alias("x"))
    return rows.select("x.*").groupBy("kind", "value").agg(F.count("*").alias("n"))


def public_rules(spark, rules=RULES) -> DataFrame:
    """The rules without their conditions (H8)."""
    rows = [(r.id, r.category, r.confidence, r.directional, p, e[0], e[1]) for r in rules for p, e in r.effects.items()]
    return spark.createDataFrame(rows, "id string, category string, confidence int, directional boolean, profile string, severity int, impact string")

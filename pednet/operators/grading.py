"""Accessibility grades of edges, in both directions, for every profile: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pednet.functions.normalize import is_unknown, normalize_categorical, normalize_sequence, parse_incline, parse_number, parse_width_m
from pednet.operators.rules import applies, condition
from pednet.policies.profiles import PROFILES, Factor, Profile

CATEGORICAL = ("surface", "smoothness", "wheelchair", "highway", "crossing", "lit", "access", "foot")
SEQUENCES = ("associated_kerbs", "associated_tactile_paving")
#: Raw columns that prepare_features reads.
READ = ("edge_kind", "width", "incline", "incline:across", "incline_across", "slope_percent", "slope_source", "slope_confidence", *CATEGORICAL, *SEQUENCES, "associated_transition_states")
STATES = "array<struct<kerb:string,tactile_paving:string,kerb_surface:string,sidewalk_surface:string>>"


def prepare_features(df: DataFrame) -> DataFrame:
    """Raw tags to graded fields (N7). Missing columns count as unknown; slope_percent, slope_source and slope_confidence, if there,
    stand in for an incline without a number."""
    have = set(df.columns)
    raw = lambda c, kind="string": F.col(c) if c in have else F.lit(None).cast(kind)
    incline, cross = parse_incline(raw("incline")), parse_incline(raw("incline:across") if "incline:across" in have else raw("incline_across"))
    slope = raw("slope_percent", "double")
    states = raw("associated_transition_states", STATES)
    surface = normalize_categorical(raw("surface"))
    uniform = (F.col("edge_kind") == "crossing") & ~is_unknown(raw("surface")) & F.exists(states, lambda s: (normalize_categorical(s["kerb_surface"]) == surface) & (normalize_categorical(s["sidewalk_surface"]) == surface))
    out = {
        "width_m": parse_width_m(raw("width")),
        "incline_percent": F.coalesce(incline["percent"], slope),
        "incline_source": F.when(incline["percent"].isNotNull(), "direct_osm_numeric").when(slope.isNotNull(), raw("slope_source")).otherwise(incline["kind"]),
        "incline_confidence": F.when(incline["percent"].isNotNull(), 100).when(slope.isNotNull(), F.coalesce(raw("slope_confidence", "int"), F.lit(0))).otherwise(0),
        "cross_slope_percent": cross["percent"],
        "cross_slope_confidence": F.when(cross["percent"].isNotNull(), 100).otherwise(0),
        **{c: F.when(~is_unknown(raw(c)), normalize_categorical(raw(c))) for c in CATEGORICAL},
        **{c: normalize_sequence(raw(c, "array<string>")) for c in SEQUENCES},
        "associated_transition_states": F.coalesce(states, F.array().cast(STATES)),
        "uniform_transition_surface": F.coalesce(uniform, F.lit(False)),
    }
    return df.withColumns(out)


def _bands(x: Column, bands) -> Column:
    out = None
    for limit, grade in bands:
        test = F.lit(True) if limit is None else x <= limit
        out = F.when(test, float(grade)) if out is None else out.when(test, float(grade))
    return out


def factor_grade(f: Factor, sign: int = 1) -> tuple[Column, Column]:
    """Grade and confidence of one factor."""
    x = F.col(f.field)
    unknown = F.lit(float(f.unknown))
    if f.values is not None:
        table = F.create_map(*[F.lit(v) for k, g in f.values.items() for v in (k, float(g))])
        one = lambda v: F.struct(F.coalesce(table[v], unknown).alias("g"), F.when(v.isNull(), 0).when(F.coalesce(table[v], F.lit(-1.0)) >= 0, 100).otherwise(25).alias("c"))
        if f.field not in SEQUENCES:
            r = one(x)
            return r["g"], r["c"]
        items = F.transform(x, lambda v, i: F.struct(one(v)["g"].alias("g"), i.alias("i"), one(v)["c"].alias("c")))
        if f.aggregation == "maximum":
            g, c = F.array_max(F.transform(items, lambda r: r["g"])), F.array_max(F.transform(items, lambda r: r["c"]))
        elif f.aggregation == "mean":
            mean = lambda k: F.aggregate(items, F.lit(0.0), lambda a, r: a + r[k]) / F.size(items)
            g, c = mean("g"), F.bround(mean("c")).cast("int")
        else:
            least = F.array_min(items)
            g, c = least["g"], least["c"]
        return F.when(F.size(x) > 0, g).otherwise(unknown), F.when(F.size(x) > 0, c).otherwise(0)
    n = parse_number(x) if f.field not in ("width_m", "incline_percent", "cross_slope_percent") else x
    sure = {"incline_percent": F.col("incline_confidence"), "cross_slope_percent": F.col("cross_slope_confidence")}.get(f.field, F.lit(100))
    if f.bands is not None:
        grade = _bands(F.abs(n) if f.absolute else n, f.bands)
    else:
        d = n * sign
        grade = F.when(d >= 0, _bands(F.abs(d), f.ascending)).otherwise(_bands(F.abs(d), f.descending))
    return F.when(n.isNull(), unknown).otherwise(grade), F.when(n.isNull(), 0).otherwise(sure)


def _sum(terms) -> Column:
    out = F.lit(0.0)
    for t in terms:
        out = out + t
    return out


def _verdict(p: Profile, name: str, factors: list, value: Column, caps: list[Column]) -> Column:
    """struct(grade, allowed, confidence, limit, reasons) (G8). factors: name, whether it applies, grade and confidence."""
    kind = F.col("edge_kind")
    barriers = [applies(b.applies_to, kind) & condition(b) for b in p.barriers]
    stop = F.lit(False)
    for b in barriers:
        stop = stop | b
    blocked = F.array_compact(F.array(*[F.when(b, c.reason) for b, c in zip(barriers, p.barriers, strict=True)], F.lit(None).cast("string")))
    least = F.col(f"__least_{name}")
    limit = F.coalesce(*[F.when(a & (g == least), F.lit(f)) for f, a, g, _ in factors], F.lit(None).cast("string"))
    return F.struct(
        F.when(stop, 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(100), F.bround(value).cast("int")))).alias("grade"),
        F.when(stop, False).otherwise(value > 0).alias("allowed"),
        F.when(stop, 100).otherwise(F.col(f"__sure_{name}")).alias("confidence"),
        F.when(stop, "barrier").otherwise(limit).alias("limit"),
        F.when(stop, blocked).otherwise(F.array_distinct(F.array_compact(F.array(*caps, F.when(least < 50, limit))))).alias("reasons"),
    )


def grade_features(df: DataFrame, policies=PROFILES) -> DataFrame:
    """prepare_features(df) with <profile>_fwd and <profile>_bwd (G9). A policy's factors are known when the plan is made, so sums and
    minima are written out over them (G4 to G7): scalar expressions that Spark compiles. Each step is a projection of its own, so that no
    step is computed twice; a factor that doesn't depend on the direction is computed once."""
    kind = F.col("edge_kind")
    sides = [(p, sign, f"{p.name}_{side}") for p in policies if p.mode != "distance" for side, sign in (("fwd", 1), ("bwd", -1))]
    graded, factors = {}, {}
    for p, sign, name in sides:
        factors[name] = []
        for i, (f_name, f) in enumerate(p.factors.items()):
            at = f"{name if f.ascending else p.name}_{i}"
            if f"__g_{at}" not in graded:
                g, c = factor_grade(f, sign)
                graded |= {f"__g_{at}": g.cast("double"), f"__c_{at}": c.cast("double")}
            factors[name].append((f_name, applies(f.applies_to, kind), F.col(f"__g_{at}"), F.col(f"__c_{at}"), float(f.weight)))
    df = df.withColumns(graded)
    means = {}
    for _, _, name in sides:
        rows = factors[name]
        weight = _sum(F.when(a, w).otherwise(0.0) for _, a, _, _, w in rows)
        # least() wants two columns at least; nulls don't count
        means[f"__least_{name}"] = F.least(*[F.when(a, g) for _, a, g, _, _ in rows], F.lit(None).cast("double"), F.lit(None).cast("double"))
        means[f"__weight_{name}"] = weight
        means[f"__slow_{name}"] = _sum(F.when(a & (g > 0), w / F.nullif(g, F.lit(0.0))).otherwise(0.0) for _, a, g, _, w in rows)
        means[f"__sum_{name}"] = _sum(F.when(a, c * w).otherwise(0.0) for _, a, _, c, w in rows)
    df = df.withColumns(means)
    out = {}
    for _, _, name in sides:
        least, weight, slow, total = (F.col(f"__{x}_{name}") for x in ("least", "weight", "slow", "sum"))
        out[f"__mean_{name}"] = F.when(least.isNull(), 100.0).when(least <= 0, 0.0).otherwise(weight / F.nullif(slow, F.lit(0.0)))
        out[f"__sure_{name}"] = F.when(least.isNull(), 0).otherwise(F.bround(total / F.nullif(weight, F.lit(0.0)))).cast("int")
    df = df.withColumns(out)
    values, caps = {}, {}
    for p, _, name in sides:
        value, reasons = F.col(f"__mean_{name}"), []
        for cap in p.caps:  # in order (G6)
            hit = applies(cap.applies_to, kind) & condition(cap) & (value > cap.most)
            reasons.append(F.when(hit, cap.reason))
            value = F.when(hit, float(cap.most)).otherwise(value)
        values[f"__value_{name}"], caps[name] = value, len(reasons)
        values |= {f"__cap_{name}_{i}": r for i, r in enumerate(reasons)}
    df = df.withColumns(values)
    final = {name: _verdict(p, name, [x[:4] for x in factors[name]], F.col(f"__value_{name}"), [F.col(f"__cap_{name}_{i}") for i in range(caps[name])]) for p, _, name in sides}
    return df.withColumns(final).drop(*graded, *means, *out, *values)


def compact_grades(df: DataFrame, policies=PROFILES) -> DataFrame:
    """Flat grade columns (G10); the nested ones go."""
    out, gone = {}, []
    for p in policies:
        if p.mode == "distance":
            continue
        f, b = F.col(f"{p.name}_fwd"), F.col(f"{p.name}_bwd")
        out |= {f"{p.name}_grade_fwd": f["grade"], f"{p.name}_grade_bwd": b["grade"], f"{p.name}_allow_fwd": f["allowed"], f"{p.name}_allow_bwd": b["allowed"]}
        out |= {f"{p.name}_confidence": F.least(f["confidence"], b["confidence"]), f"{p.name}_limit": F.when(f["grade"] <= b["grade"], f["limit"]).otherwise(b["limit"])}
        gone += [f"{p.name}_fwd", f"{p.name}_bwd"]
    return df.withColumns(out).drop(*gone)


def alike(df: DataFrame, policies=PROFILES) -> DataFrame:
    """Raw tags that grades depend on, each set of them once, and how many features have it (n_alike). Grades of far fewer rows make the same audit."""
    rules = {c.field for p in policies for c in (*p.factors.values(), *p.barriers, *p.caps)}
    return df.groupBy(*[c for c in df.columns if c in rules or c in READ]).agg(F.count("*").alias("n_alike"))


def profile_audit(df: DataFrame, policies=PROFILES, top: int = 10) -> DataFrame:
    """Per profile: least, greatest and mean of the worse direction, grades in six bands, the commonest limits (A18). A row counts n_alike times if
    there is such a column (alike)."""
    from pyspark.sql import Window

    parts = [F.struct(F.lit(p.name).alias("profile"), F.least(f"{p.name}_grade_fwd", f"{p.name}_grade_bwd").alias("worst"), F.col(f"{p.name}_limit").alias("limit")) for p in policies if p.mode != "distance"]
    times = F.col("n_alike") if "n_alike" in df.columns else F.lit(1).cast("long")
    rows = df.select(times.alias("n"), F.inline(F.array(*parts))).groupBy("profile", "worst", "limit").agg(F.sum("n").alias("n"))
    # The bands' limits.
    edges = (0, 1, 20, 40, 60, 80, 101)
    bands = [F.sum(F.when((F.col("worst") >= a) & (F.col("worst") < b), F.col("n")).otherwise(0)).alias(f"band_{a}") for a, b in zip(edges[:-1], edges[1:], strict=True)]
    mean = F.sum(F.col("worst") * F.col("n")) / F.nullif(F.sum(F.when(F.col("worst").isNotNull(), F.col("n"))), F.lit(0))
    sums = rows.groupBy("profile").agg(F.sum("n").alias("n"), F.min("worst").alias("least"), F.max("worst").alias("greatest"), F.bround(mean, 2).alias("mean"), *bands)
    limits = rows.where("limit is not null").groupBy("profile", "limit").agg(F.sum("n").alias("c"))
    limits = limits.withColumn("r", F.row_number().over(Window.partitionBy("profile").orderBy(F.desc("c"), "limit"))).where(F.col("r") <= top)
    limits = limits.groupBy("profile").agg(F.array_sort(F.collect_list(F.struct("r", "limit", "c"))).alias("limits"))
    return sums.join(limits, "profile", "left")


def directional_weight(p: Profile, side: str, segment_m: Column) -> Column:
    """The cost of a segment; infinite where it can't be passed."""
    if p.mode == "distance":
        return segment_m
    kind = F.coalesce("edge_kind", F.lit("footway"))
    penalty = F.create_map(*[x for k, v in p.penalties.items() for x in (F.lit(k), F.lit(v).cast("double"))])[kind]
    g = F.col(f"{p.name}_grade_{side}").cast("double")
    factor = None
    for least, m in p.multipliers:
        factor = F.when(g >= least, m) if factor is None else factor.when(g >= least, m)
    whole = F.greatest(F.coalesce(F.when(F.abs(F.col("length_m")) < float("inf"), F.col("length_m")), segment_m), segment_m)
    ok = penalty.isNotNull() & F.coalesce(F.col(f"{p.name}_allow_{side}"), F.lit(True)) & (g > 0) & factor.isNotNull()
    return F.when(ok, segment_m * factor + penalty * segment_m / F.nullif(whole, F.lit(0.0))).otherwise(float("inf"))

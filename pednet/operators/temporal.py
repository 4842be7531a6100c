"""Joins by time without pairs of ranges: the newest row before each of another table's, and rows whose intervals overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a bucket of asof_join.
BUCKET_S = 86_400
#: Seconds of the unit by which interval_join deals out.
UNIT_S = 3_600


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], ts: str = "ts", tie: str | None = None, bucket_s: int = BUCKET_S) -> DataFrame:
    """left with the columns of right's row of the same keys that has the greatest ts not after left's (of equal ones that with the greatest tie), as the
    struct asof; null without one.

    Both sides are dealt to buckets of time by key, so a key of many rows is many groups. In each, a running last value does; what the buckets before
    hold is carried by a running last value over buckets, a row each. No side is compared with the other row by row, and none is broadcast.
    Rows of right without ts are never found; rows of left without ts or without a key find nothing; repeated rows of left stay."""
    put = [c for c in right.columns if c not in keys]
    value = F.struct(*put)
    order = [F.col("__t"), F.col("__side").desc()]
    at = _micros(F.col(ts))
    a = left.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(*left.columns).alias("__row"), F.lit(None).cast(right.select(value.alias("v")).schema["v"].dataType).alias("__value"), at.alias("__t"), F.lit(0).alias("__side"), F.lit(None).cast(right.schema[tie].dataType if tie else "int").alias("__tie"))
    b = right.where(F.col(ts).isNotNull()).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.lit(None).cast(a.schema["__row"].dataType).alias("__row"), value.alias("__value"), at.alias("__t"), F.lit(1).alias("__side"), (F.col(tie) if tie else F.lit(0)).alias("__tie"))
    ks = [f"__k{i}" for i in range(len(keys))]
    for k in ks:
        b = b.where(F.col(k).isNotNull())
    rows = a.unionByName(b).withColumn("__b", F.floor(F.col("__t") / (bucket_s * 1_000_000)))
    within = Window.partitionBy(*ks, "__b").orderBy(*order, F.col("__tie").asc_nulls_first())
    rows = rows.withColumn("__here", F.last("__value", ignorenulls=True).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = b.withColumn("__b", F.floor(F.col("__t") / (bucket_s * 1_000_000))).groupBy(*ks, "__b").agg(F.max_by("__value", F.struct("__t", "__tie")).alias("__last"))
    wanted = a.withColumn("__b", F.floor(F.col("__t") / (bucket_s * 1_000_000))).select(*ks, "__b").distinct()
    over = Window.partitionBy(*ks).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.join(wanted, [*ks, "__b"], "full_outer").select(*ks, "__b", F.last("__last", ignorenulls=True).over(over).alias("__before"))
    out = rows.where("__side = 0").select(*ks, "__b", "__row", "__here", "__t").join(carried, [*ks, "__b"], "left")
    return out.select("__row.*", F.when(F.col("__t").isNotNull(), F.coalesce("__here", "__before")).alias("asof"))


def _nodes(a: Column, b: Column, levels: int) -> Column:
    """Array of (level, index, whole): the dyadic intervals that make up [a, b), and (not whole) those above them."""

    def at(k: Column) -> Column:
        size = F.pow(F.lit(2.0), k).cast("long")
        lo, hi = F.ceil(a / size), F.floor(b / size)
        node = lambda i, whole, ok: F.when(ok, F.struct(k.alias("level"), i.cast("long").alias("index"), F.lit(whole).alias("whole")))
        first, last = F.floor(a / size), F.floor((b - 1) / size)
        above = lambda i: (i * size < a) | ((i + 1) * size > b)
        top = k == levels  # the last level takes all that is left
        return F.array(
            node(lo, True, (lo < hi) & ((lo % 2 == 1) | top)),
            node(hi - 1, True, (lo < hi) & ((hi % 2 == 1) | top) & ((hi - 1 != lo) | ((lo % 2 == 0) & ~top))),
            node(first, False, above(first)),
            node(last, False, above(last) & (last != first)),
        )

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at)))


def interval_join(left: DataFrame, right: DataFrame, start: str = "start", end: str = "end", unit_s: int = UNIT_S, on: list[str] | None = None) -> DataFrame:
    """left (struct l) and right (struct r) rows whose intervals [start, end) overlap, and which agree in the columns on.

    An interval, in units of unit_s, is made up of few intervals of powers of two (dyadic ones), each a key; two intervals overlap if one's key is the other's, or
    stands above one of the other's. So the join is by equality on these keys, never of two that only stand above, as all intervals do at the top. A pair counts at the key that holds its first common unit, which is one.
    Intervals that are empty, turned round or without an end overlap nothing."""
    on = on or []
    micros = unit_s * 1_000_000
    sides = []
    for df, name in ((left, "l"), (right, "r")):
        ok = df.where(F.col(start) < F.col(end))
        sides.append(ok.select(*[F.col(c).alias(f"__on{i}") for i, c in enumerate(on)], F.struct(*df.columns).alias(name), F.floor(_micros(F.col(start)) / micros).alias(f"{name}a"), F.ceil(_micros(F.col(end)) / micros).alias(f"{name}b")))
    ends = [s.agg(F.min(f"{n}a").alias("lo"), F.max(f"{n}b").alias("hi")).first() for s, n in zip(sides, "lr", strict=True)]
    known = [e for e in ends if e["lo"] is not None]
    low, high = min((e["lo"] for e in known), default=0), max((e["hi"] for e in known), default=1)
    levels = max(1, (high - low).bit_length())
    cut = []
    for s, n in zip(sides, "lr", strict=True):
        s = s.withColumns({f"{n}a": F.col(f"{n}a") - low, f"{n}b": F.col(f"{n}b") - low})
        cut.append(s.select("*", F.explode(_nodes(F.col(f"{n}a"), F.col(f"{n}b"), levels)).alias("node")).select(*[c for c in s.columns], "node.level", "node.index", F.col("node.whole").alias(f"{n}w")))
    by = ["level", "index", *[f"__on{i}" for i in range(len(on))]]
    both = cut[0].where("lw").join(cut[1].where("rw"), by)
    for mine, its in (("lw", "not rw"), ("not lw", "rw")):
        both = both.unionByName(cut[0].where(mine).join(cut[1].where(its), by))
    first = F.greatest("la", "ra")
    both = both.where((F.floor(first / F.pow(F.lit(2.0), F.col("level"))) == F.col("index")) & (F.col(f"l.{start}") < F.col(f"r.{end}")) & (F.col(f"r.{start}") < F.col(f"l.{end}")))
    return both.select("l", "r")


def overlap_totals(left: DataFrame, right: DataFrame, sums: list[str], start: str = "start", end: str = "end", bucket_s: int = BUCKET_S) -> DataFrame:
    """left rows whose interval [start, end) overlaps one of right's, with n, their number, and the totals (decimals) of right's whole numbers sums.

    No pair is made: what overlaps is what starts before the end, less what ends by the start. Both are running totals over right's times, a row for each distinct one, by
    buckets and over buckets as in asof_join. Intervals that are empty, turned round or without an end overlap nothing."""
    lefts = left.where(F.col(start) < F.col(end)).withColumns({"__s": _micros(F.col(start)), "__e": _micros(F.col(end))})
    rights = right.where(F.col(start) < F.col(end))
    total = {"n": F.count("*").cast("decimal(38,0)")} | {c: F.sum(F.col(c).cast("decimal(38,0)")) for c in sums}
    sides = []
    for kind, ts, asked in (("s", start, "__e"), ("e", end, "__s")):  # which of right's times, and left's that asks for all before it, or up to it
        have = rights.groupBy(_micros(F.col(ts)).alias("t")).agg(*[v.alias(c) for c, v in total.items()]).withColumn("after", F.lit(2 if kind == "s" else 0))
        ask = lefts.select(F.col(asked).alias("t")).distinct().withColumns({c: F.lit(None).cast("decimal(38,0)") for c in total} | {"after": F.lit(1)})
        sides.append(have.unionByName(ask).withColumn("kind", F.lit(kind)))
    rows = sides[0].unionByName(sides[1]).withColumn("__b", F.floor(F.col("t") / (bucket_s * 1_000_000)))
    within = Window.partitionBy("kind", "__b").orderBy("t", "after").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = Window.partitionBy("kind").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("kind", "__b").agg(*[F.sum(c).alias(c) for c in total]).select("kind", "__b", *[F.coalesce(F.sum(c).over(over), F.lit(0)).alias(f"{c}_before") for c in total])
    known = rows.select("kind", "__b", "t", "after", *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(c) for c in total]).where("after = 1").join(before, ["kind", "__b"])
    known = known.select("kind", "t", *[(F.col(c) + F.col(f"{c}_before")).cast("decimal(38,0)").alias(c) for c in total])
    out = lefts
    for kind, asked in (("s", "__e"), ("e", "__s")):
        out = out.join(known.where(F.col("kind") == kind).select(F.col("t").alias(asked), *[F.col(c).alias(f"__{kind}{c}") for c in total]), asked)
    more = [(F.col(f"__s{c}") - F.col(f"__e{c}")).cast("decimal(38,0)").alias(c) for c in sums]
    return out.where("__sn > __en").select(*left.columns, (F.col("__sn") - F.col("__en")).cast("long").alias("n"), *more)

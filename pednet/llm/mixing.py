"""Mixing sources to target weights by entropy balancing (Hainmueller 2012), with rates bounded by the most copies a document may have.

Targets: the mix's budget is shared over sources by weight; no source takes more than MOST times its words, and what is above goes to the
others by weight. Rates: of all document rates w in (0, MOST) that meet each source's token constraint, those of least (Fermi) entropy
distance to equal rates are w = MOST / (1 + exp(-(a + b z))), z the document's size over its source's mean: an exponentially tilted odds.
Newton iterations on the convex dual find b of every source at once; each is an aggregation over (source, size, documents) counts.
Copies: the whole part of a rate, and one more where a hash of doc_id falls below its fraction; then exchanges close the gap to CLOSE of
the target: copies of the largest documents that fit are given or taken, and of smaller ones for what is left. How many of each size is found on
counts alone, in rounds that halve a gap; then the documents are picked, in one pass.

Edge cases: null text has size 0; a null source is a source of its own and the last; documents of size 0 get the copies of their rate;
rows that repeat a doc_id share its decisions, so an exchange counts the
words of all of them, and those without one go by their text; an empty table gives no rows; sources without words have target 0.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pednet.llm import common

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
CLOSE = 1e-4
#: Newton steps that fall outside what is known of b are halvings, so this many always do.
NEWTON_ROUNDS = 200
#: Parts of a source in joins by source.
SALT = 64
#: Parts, by hash, in which the documents of a size are counted and put in order.
PARTS = 1024
#: Log odds of the rate that every document has before any tilt.
ODDS = math.log(SHARE / MOST / (1 - SHARE / MOST))


def sized(docs: DataFrame) -> DataFrame:
    """docs with size, and the source as two columns without nulls: absent, src."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.select("*", size.alias("__size"), F.col("source").isNull().alias("__absent"), F.coalesce("source", F.lit("")).alias("__src"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """absent, src, total to these and target: water filling in closed form over sources ordered by how soon they are full."""
    by = Window.orderBy("absent", "src")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sources.withColumn("w", w).withColumn("cap", F.col("total") * float(most))
    full = Window.orderBy(F.col("cap") / F.col("w"), "absent", "src")
    rows = rows.select("*", (F.sum("cap").over(full) - F.col("cap")).alias("caps"), (F.sum("w").over(Window.partitionBy()) - F.sum("w").over(full) + F.col("w")).alias("ws"), (F.sum("total").over(Window.partitionBy()) * share).alias("budget"))
    # the level is that of the first source which the rest of the budget, shared from there on, does not fill
    level = (F.col("budget") - F.col("caps")) / F.col("ws")
    rows = rows.withColumn("level", F.when(level * F.col("w") <= F.col("cap"), level))
    rows = rows.withColumn("level", F.first("level", True).over(full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return rows.select("absent", "src", "total", F.least("cap", F.coalesce("level", F.lit(float("inf"))) * F.col("w")).alias("target"))


def salted_join(rows: DataFrame, small: DataFrame, on: tuple[str, ...] = ("absent", "src")) -> DataFrame:
    """rows with the columns of their row in small; rows of a value are dealt to SALT keys, so that a hot one doesn't meet in one task."""
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("key"), F.lit(SALT)).cast("int"))
    each = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return salted.join(each, [*on, "__salt"]).drop("__salt")


def rate(b, z):
    """Of the most copies; b null: every copy."""
    return F.when(b.isNull(), F.lit(float(MOST))).otherwise(MOST / (1 + F.exp(-(ODDS + b * z))))


def balance(counts: DataFrame, sources: DataFrame) -> DataFrame:
    """absent, src, mean, b: the tilt of each source (null where it is full). counts: absent, src, size, n."""
    state = sources.select("absent", "src", "total", "target", (F.col("total") / F.greatest("docs", F.lit(1))).alias("mean"), F.lit(0.0).alias("b"), F.lit(-700.0).alias("lo"), F.lit(700.0).alias("hi"), F.lit(False).alias("done"))
    state = state.withColumn("done", F.col("target") <= 0).withColumn("b", F.when(F.col("target") < F.col("total") * MOST * (1 - 1e-12), F.col("b")))
    state = common.written(state, "tilt")
    for _ in range(NEWTON_ROUNDS):
        open_ = state.where("not done and b is not null")
        if open_.isEmpty():
            break
        z = F.col("size") / F.col("mean")
        r = rate(F.col("b"), z)
        sums = (
            counts.where("size > 0")
            .join(open_.select("absent", "src", "b", "mean"), ["absent", "src"])
            .groupBy("absent", "src")
            .agg(F.sum(F.col("n") * F.col("size") * r).alias("got"), F.sum(F.col("n") * F.col("size") * z * r * (1 - r / MOST)).alias("slope"))
        )
        gap = F.col("target") - F.col("got")
        lo, hi = F.when(gap > 0, F.col("b")).otherwise(F.col("lo")), F.when(gap < 0, F.col("b")).otherwise(F.col("hi"))
        step = F.col("b") + gap / F.col("slope")
        to = F.when((F.col("slope") > 0) & (step > lo) & (step < hi), step).otherwise((lo + hi) / 2)
        done = F.abs(gap) <= CLOSE * F.col("target")
        moved = state.join(sums, ["absent", "src"], "left")
        after = moved.select(
            "absent", "src", "total", "target", "mean",
            F.when(F.col("got").isNull() | done, F.col("b")).otherwise(to).alias("b"),
            F.when(F.col("got").isNull(), F.col("lo")).otherwise(lo).alias("lo"), F.when(F.col("got").isNull(), F.col("hi")).otherwise(hi).alias("hi"),
            (F.col("done") | F.coalesce(done, F.lit(False))).alias("done"),
        )
        after = common.written(after, "tilt")
        common.drop(state)
        state = after
    else:
        raise RuntimeError("balance: a source's target isn't met")
    return state


def mix(docs: DataFrame) -> DataFrame:
    """docs with __size, __source_size, __target and __copies. docs needs doc_id, text and source; other columns pass."""
    rows = sized(docs)
    key = [F.col("__absent").alias("absent"), F.col("__src").alias("src")]
    slim = common.written(rows.select("doc_id", decided_by().alias("key"), *key, F.col("__size").alias("size")), "sizes")
    counts = common.written(slim.groupBy("absent", "src", "size").agg(F.count("*").alias("n")), "counts")
    totals = counts.groupBy("absent", "src").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("total"), F.sum("n").alias("docs"))
    state = balance(counts, targets(totals.select("absent", "src", "total")).join(totals.drop("total"), ["absent", "src"]))
    tilt = state.select("absent", "src", F.col("total").alias("source_size"), "target", "mean", "b", (F.col("target") <= 0).alias("none"))
    w = F.when(F.col("none"), 0.0).otherwise(rate(F.col("b"), F.when(F.col("mean") > 0, F.col("size") / F.col("mean")).otherwise(F.lit(0.0))))
    unit = F.pmod(F.xxhash64("key"), F.lit(1 << 40)) / float(1 << 40)
    drawn = salted_join(slim, tilt).select("doc_id", "key", "absent", "src", "size", "source_size", "target", F.least(F.floor(w) + F.when(unit < w - F.floor(w), 1).otherwise(0), F.lit(MOST)).cast("int").alias("copies"))
    drawn = common.written(drawn, "drawn")
    common.drop(slim, counts)
    of = ["absent", "src", "key"]
    # rows that share a document's decisions take a step together
    whole = drawn.groupBy(*of).agg(F.sum("size").alias("words"), F.min("copies").alias("copies"), F.max("copies").alias("most")).where("words > 0 and copies = most").drop("most")
    whole = common.written(whole, "whole")
    gaps = drawn.groupBy("absent", "src").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"), F.first("target").alias("goal"))
    cells = whole.groupBy("absent", "src", "words").agg(F.sum(MOST - F.col("copies")).alias("up"), F.sum("copies").alias("down"))
    given = common.written(picked(whole, exchanges(cells.join(gaps, ["absent", "src"]))), "exchange")
    common.drop(whole)
    return drawn.join(given, of, "left").withColumn("copies", (F.col("copies") + F.coalesce("add", F.lit(0))).cast("int")).drop("add")


def exchanges(cells: DataFrame) -> DataFrame:
    """absent, src, words, step: how many copies the documents of so many words give (or take, if negative) for their source's gap to close. cells: absent, src,
    words, up and down (copies that they may take or give), gap and goal.

    A round fills a gap with the largest that fit, in falling order, which leaves less than one of the last of these; where none fits, with one that is up
    to half as large again. So a gap at least halves, unless nothing is left to move."""
    by = Window.partitionBy("absent", "src")
    state = common.written(cells.select("*", F.lit(0).cast("long").alias("step"), F.lit(True).alias("open")), "cells")
    while not state.where("open").isEmpty():
        gap = F.abs("gap")
        can = F.when(gap > CLOSE * F.col("goal"), F.when(F.col("gap") > 0, F.col("up") - F.col("step")).otherwise(F.col("down") + F.col("step"))).otherwise(0)
        rows = state.withColumn("can", can).withColumn("fits", F.when(F.col("words") <= gap, F.col("can")).otherwise(0))
        before = F.coalesce(F.sum(F.col("fits") * F.col("words")).over(by.orderBy(F.desc("words")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rows = rows.withColumn("take", F.greatest(F.lit(0), F.least("fits", F.floor((gap - before) / F.col("words")))).cast("long"))
        above = F.min(F.when((F.col("can") > 0) & (F.col("words") > gap) & (F.col("words") <= 1.5 * gap), F.col("words")))
        rows = rows.withColumn("take", F.when(F.max("fits").over(by) > 0, F.col("take")).when(F.col("words") == above.over(by), 1).otherwise(0) * F.signum("gap").cast("long"))
        after = rows.select("absent", "src", "words", "up", "down", (F.col("gap") - F.sum(F.col("take") * F.col("words")).over(by)).alias("gap"), "goal", (F.col("step") + F.col("take")).alias("step"), (F.col("take") != 0).alias("open"))
        after = common.written(after, "cells")
        common.drop(state)
        state = after
    return state.where("step <> 0").select("absent", "src", "words", "step")


def picked(whole: DataFrame, steps: DataFrame) -> DataFrame:
    """absent, src, key, add: the documents that exchanges fall on, those of a size in the order of their keys: by hashed parts, and within a part. whole: absent, src,
    key, words, copies."""
    cell = ["absent", "src", "words"]
    rows = salted_join(whole, steps, tuple(cell))
    rows = rows.select("*", F.when(F.col("step") > 0, MOST - F.col("copies")).otherwise(F.col("copies")).alias("can"), F.pmod(F.xxhash64("key", F.lit(7)), F.lit(PARTS)).cast("int").alias("part")).where("can > 0")
    parts = rows.groupBy(*cell, "part").agg(F.sum("can").alias("can"), F.first("step").alias("step"))
    parts = parts.withColumn("before", F.coalesce(F.sum("can").over(Window.partitionBy(*cell).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    parts = parts.where(F.col("before") < F.abs("step")).select(*cell, "part", "before")
    rows = rows.join(parts, [*cell, "part"])
    here = F.coalesce(F.sum("can").over(Window.partitionBy(*cell, "part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    add = F.greatest(F.lit(0), F.least("can", F.abs("step") - F.col("before") - here)) * F.signum("step")
    return rows.select("absent", "src", "key", add.cast("long").alias("add")).where("add <> 0")


def decided_by():
    """What a row's decisions go by: its doc_id, or its text where it has none."""
    return F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text", F.lit(1)))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """docs, each row as often as the mix takes it."""
    rows = sized(docs)
    rows = rows.withColumn("__key", decided_by())
    copies = mix(docs).groupBy("key", "absent", "src", "size").agg(F.max("copies").alias("__copies"))
    same = (rows["__key"] == copies["key"]) & (rows["__absent"] == copies["absent"]) & (rows["__src"] == copies["src"]) & (rows["__size"] == copies["size"])
    out = rows.join(copies, same).where("__copies > 0")
    return out.select(*[rows[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__nth")).drop("__nth")


def op3_mix(spark, sf_dir: str) -> DataFrame:
    m = mix(common.documents(spark, sf_dir).select("doc_id", "text", "source"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))

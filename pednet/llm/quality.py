"""Quality rules: the log-likelihood ratio of a document's hashed n-grams under a trusted target and under the raw corpus.

Features of a text: each word, each pair of neighbouring words, and each word's first and last three characters, hashed into BUCKETS.
Two multinomials over buckets (add-ALPHA smoothing) are counted over whole tables: the trusted documents (labels with quality 1 and not
toxic) and all documents. A document's score is the mean log ratio of its features; it is kept at THRESHOLD or more. No rank, sample or
random number takes part, so every document is decided alike. DataFrame functions only; the model (BUCKETS doubles) is the only thing
that passes through the driver.

Edge cases: null or blank text has no words: all counts 0, base_failed, not kept. Without trusted documents every ratio is 0, so the base
rules alone decide. Conflicting labels of one document count as not trusted. Repeated rows are scored alike; an empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pednet.llm import common

BUCKETS = 1 << 14
ALPHA = 1.0
#: The mean log ratio from which a text is kept, where rules() gets no other.
THRESHOLD = -0.25
#: Labels are broadcast up to so many rows (about 40 bytes each), else joined by shuffle.
BROADCAST_ROWS = 500_000
WINDOW = 8

BLANK = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words of a text, in order: runs of anything but space and U+0009 to U+000D."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are computed once a row, whatever is done with them later: Spark pushes a filter through a projection, and
    computes there anew what it refers to, but not through a generator."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def bucket(x: Column) -> Column:
    return F.pmod(x, F.lit(BUCKETS)).cast("int")


def neighbours(h: Column, step: int) -> Column:
    """Hashes of each value of an array with the one `step` after it. The lambda sees these two only."""
    n = F.greatest(F.size(h) - step, F.lit(0))
    return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(1 + step), n), lambda x, y: F.xxhash64(x, y))


def prefix(word: Column) -> Column:
    return bucket(F.xxhash64(F.lit("<"), F.substring(word, 1, 3)))


def suffix(word: Column) -> Column:
    return bucket(F.xxhash64(F.lit(">"), F.substring(word, -3, 3)))


def hashed(docs: DataFrame) -> DataFrame:
    """docs with __w, words; __h, their hashes; __h2, those of neighbouring pairs."""
    rows = once(docs, __w=words(F.col("text")))
    rows = once(rows, __h=F.transform("__w", lambda x: F.xxhash64(x)))
    return once(rows, __h2=neighbours(F.col("__h"), 1))


def trusted_ids(labels: DataFrame) -> DataFrame:
    ids = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return ids.where("q = 1 and coalesce(t, 0) = 0").select("doc_id")


def model(docs: DataFrame, labels: DataFrame) -> list[float]:
    """The log ratio of each bucket."""
    ids = trusted_ids(labels).withColumn("__trusted", F.lit(1))
    small = ids.count() <= BROADCAST_ROWS
    rows = hashed(docs.select("doc_id", "text").join(F.broadcast(ids) if small else ids, "doc_id", "left"))
    each = rows.select("__trusted", F.inline(F.arrays_zip("__w", "__h", "__h2")))  # a row a word; the last has no pair
    buckets = F.array(bucket(F.col("__h")), bucket(F.col("__h2")), prefix(F.col("__w")), suffix(F.col("__w")))
    each = each.select("__trusted", F.explode(buckets).alias("b")).where("b is not null")
    counts = each.groupBy("b").agg(F.count("*").alias("raw"), F.count("__trusted").alias("target")).collect()  # BUCKETS rows at most
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for r in counts:
        raw[r["b"]], target[r["b"]] = r["raw"], r["target"]
    if not sum(target):
        return [0.0] * BUCKETS
    n, m = sum(raw) + ALPHA * BUCKETS, sum(target) + ALPHA * BUCKETS
    return [math.log((t + ALPHA) / m) - math.log((x + ALPHA) / n) for t, x in zip(target, raw, strict=True)]


def rules(docs: DataFrame, ratios: list[float], least: float = THRESHOLD) -> DataFrame:
    """docs with the base counts, base_failed, score and kept (score of least or more); columns of docs with these names are replaced."""
    docs = docs.drop("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", "base_failed", "kept")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = hashed(docs)
    # windows of WINDOW words: pairs of pairs of pairs; those found again by sorting, for the few texts that have any
    rows = once(rows, __p=neighbours(neighbours(F.col("__h2"), 2), 4), __lines=F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != ""))
    rows = once(rows, __s=F.when(F.size("__p") > F.size(F.array_distinct("__p")), F.array_sort(F.transform("__p", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    n = F.size("__s") - 1
    same = once(rows, __same=F.zip_with(F.slice("__s", F.lit(1), n), F.slice("__s", F.lit(2), n), lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"]))))
    at = F.array_sort(F.array_distinct(F.flatten(F.array_compact("__same"))))
    covered = F.aggregate(at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i + WINDOW - a["end"])).alias("n"), (i + WINDOW).alias("end")), lambda a: a["n"])
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")  # a constant, folded by the optimizer
    ratio = lambda b: F.get(table, b)
    score = F.aggregate("__h", F.lit(0.0), lambda a, x: a + ratio(bucket(x))) + F.aggregate("__h2", F.lit(0.0), lambda a, x: a + ratio(bucket(x)))
    score += F.aggregate("__w", F.lit(0.0), lambda a, x: a + ratio(prefix(x)) + ratio(suffix(x)))
    rows = once(
        same,
        n_words=F.size("__w").cast("long"),
        word_chars=F.length(F.translate(text, BLANK, "")).cast("long"),
        n_symbols=(F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        n_dup_lines=(F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        n_repeat_words=F.coalesce(covered, F.lit(0)).cast("long"),
        score=score / F.greatest(3 * F.size("__w") + F.size("__h2"), F.lit(1)),
    ).select(*docs.columns, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")
    rows = rows.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least))


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return rules(docs, model(docs, labels)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")

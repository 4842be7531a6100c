"""A corpus pipeline over documents: language ID, line dedup, n-gram Jaccard join, mixing sources, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pednet.llm import jaccard, language, lines, mixing, packing, tokens
from pednet.llm.common import documents, drop, ready, written

#: Texts whose best language holds less of their n-grams are rejected.
LEAST_SCORE = 0.3
#: Documents link when their sets of five-word shingles have a Jaccard similarity of 80 % or more.
SHINGLE = 5
PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: not `und`, and not of a low score. The model is trained on the labelled ones of docs."""
    ready(spark)
    model = language.train(docs.where(~F.coalesce(language.held_out(), F.lit(False))).select("text", "lang"))
    out = language.predict(docs, model)
    return out.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat another's; those left without a line go."""
    return lines.deduplicated(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents that with the smallest doc_id; of rows that repeat a doc_id, one; rows without a doc_id stay."""
    found = jaccard.join(docs, shingle=SHINGLE, percent=PERCENT)
    kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    rows = docs.join(kept, docs["doc_id"] == kept["__id"], "left_semi")
    order = Window.partitionBy("doc_id").orderBy("text", "source", "lang")
    rows = rows.withColumn("__nth", F.row_number().over(order)).where("__nth = 1").select(*docs.columns)
    return rows.unionByName(docs.where("doc_id is null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in sequences of at most 2048 ids."""
    return packing.pack(packing.cut(docs, tokens.tokenizer_path("byte_bpe_50k.json")))


STAGES = [("language ID", language_id), ("line dedup", line_dedup), ("n-gram Jaccard join", jaccard_join), ("mixing sources", mix_sources), ("packing", pack)]

#: Language ID, MinHash and Newton iterations have no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again before the next."""
    docs, before = documents(spark, sf_dir), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
            if before is not None:  # what the stage has read is not needed any more
                drop(before)
            before = docs
    return docs

"""Language ID by language-bitmask n-gram filters.

Training counts character n-grams of GRAM characters (lower-cased, runs of anything but letters as one space) for each language over
all training rows. A language has an n-gram if that is LEAST_RATE or more of its n-grams, and SHARE or more of the rate of the language
that uses it most. The filter is a bit-sliced Bloom filter: slots by the number of known n-grams, each a bitmask of languages; an n-gram sets its languages' bits in HASHES slots, so the
AND of those slots gives all languages that contain it in one probe. A language's filled slots, to the power of HASHES, is its rate of
false positives. Prediction counts for each language the n-grams of the text that hit it, corrects the count for false positives, and
takes the highest; the score is that language's corrected share of the n-grams, from 0 to 1.

What reaches the driver and is broadcast is the filter, 32 MB at most for every 64 languages.
Edge cases: null text or text without a letter is `und` with score 0; ties go to the first language by code point; rows with null lang or
null text don't train; without training rows everything is `und`; repeated rows train as often as they come.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pednet.llm import common

GRAM = 4
HASHES = 2
#: A language has an n-gram at this share of all its n-grams or more, so that it has a million at most, whatever the corpus.
LEAST_RATE = 1e-6
SHARE = 0.1
#: Slots for each known n-gram, and the least and the most slots (8 bytes for every 64 languages).
ROOM = 4
SLOTS = (1 << 16, 1 << 22)

_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For each code point: its lower-case letter, or 0 if it isn't a letter."""
    if not _letters:
        out = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if (ch := chr(c)).isalpha():
                low = ch.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _letters.append(out)
    return _letters[0]


def grams(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all documents, the document of each, and which documents have a letter."""
    joined = "\x00".join(x if x is not None else "" for x in text.to_pylist()) + "\x00"
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    end = np.flatnonzero(codes == 0)
    if len(end) != len(text):  # U+0000 in a text
        return grams(pa.array([(x or "").replace("\x00", " ") for x in text.to_pylist()]))
    low = letters()[codes]
    doc = np.zeros(len(codes), np.int32)
    doc[end[:-1] + 1] = 1
    doc = np.cumsum(doc, dtype=np.int32)
    has = np.bincount(doc[low > 0], minlength=len(text)) > 0
    keep = low > 0
    keep[1:] |= keep[:-1] | (codes[1:] == 0)  # one blank after a run of letters
    keep[0] = True
    low, doc = low[keep], doc[keep]
    if len(low) < GRAM:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), has
    h = np.zeros(len(low) - GRAM + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(GRAM):
            h = h * np.uint64(0x9E3779B97F4A7C15) + low[i : len(low) - GRAM + 1 + i] + np.uint64(1)
    same = (doc[: len(h)] == doc[GRAM - 1 :]) & (low[1 : len(h) + 1] > 0)  # a blank stands first or last only
    return common.mix(h[same]), doc[: len(h)][same], has


def slots(h: np.ndarray, n: int) -> list[np.ndarray]:
    return [((h >> np.uint64(24 * i)) & np.uint64(n - 1)).astype(np.int64) for i in range(HASHES)]


class Filter:
    """masks: a row of 64-bit words a slot; languages: their names, a bit each."""

    def __init__(self, languages: list[str], masks: np.ndarray):
        self.languages, self.masks = languages, masks
        bit = lambda i: (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        self.false = np.array([float(bit(i).mean()) ** HASHES for i in range(len(languages))])

    def hits(self, h: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
        """For each document and language, the n-grams that hit."""
        found = None
        for s in slots(h, len(self.masks)):
            found = self.masks[s] if found is None else found & self.masks[s]
        out = np.zeros((n_docs, len(self.languages)), np.int64)
        for i in range(len(self.languages)):
            out[:, i] = np.bincount(doc[(found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1) > 0], minlength=n_docs)
        return out

    def predict(self, text: pa.Array) -> tuple[list[str], np.ndarray]:
        h, doc, has = grams(text)
        n = np.maximum(np.bincount(doc, minlength=len(text)), 1)[:, None]
        if not self.languages:
            return ["und"] * len(text), np.zeros(len(text))
        rate = (self.hits(h, doc, len(text)) / n - self.false) / np.maximum(1e-9, 1 - self.false)
        best = rate.argmax(1)
        score = np.where(has, np.clip(rate[np.arange(len(text)), best], 0, 1), 0.0)
        return [self.languages[i] if ok else "und" for i, ok in zip(best, has, strict=True)], score


def train(rows: DataFrame) -> Filter:
    """rows: text and lang of the training documents."""
    rows = rows.where("text is not null and lang is not null")
    languages = [r["lang"] for r in rows.select("lang").distinct().orderBy("lang").collect()]  # one a language

    def count(batches):
        held: dict[str, list] = {}

        def flush():
            for lang, parts in held.items():
                u, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(inv, np.concatenate([p[1] for p in parts])).astype(np.int64)
                for at in range(0, len(u), 1 << 17):
                    part = u[at : at + (1 << 17)]
                    yield pa.record_batch([pa.array(common.as_long(part)), pa.array([lang] * len(part)), pa.array(n[at : at + (1 << 17)])], names=["g", "lang", "n"])

        waiting = 0
        for batch in batches:
            for b in common.slices(batch):
                h, doc, _ = grams(b.column("text"))
                lang = b.column("lang").dictionary_encode()
                of = lang.indices.to_numpy()[doc]
                for i, name in enumerate(lang.dictionary.to_pylist()):
                    u, n = np.unique(h[of == i], return_counts=True)
                    held.setdefault(name, []).append((u, n))
                    waiting += len(u)
            if waiting > 500_000:
                yield from flush()
                held, waiting = {}, 0
        yield from flush()

    counts = rows.select("text", "lang").mapInArrow(count, "g long, lang string, n long").groupBy("g", "lang").agg(F.sum("n").alias("n"))
    counts = common.written(counts, "grams")
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rate = F.col("n") / F.col("total")
    known = counts.join(F.broadcast(total), "lang").withColumn("rate", rate)  # a row a language
    top = known.groupBy("g").agg(F.max("rate").alias("top"))
    known = known.where(F.col("rate") >= LEAST_RATE).join(top, "g").where(F.col("rate") >= SHARE * F.col("top"))
    n = min(SLOTS[1], max(SLOTS[0], 1 << (ROOM * known.count()).bit_length()))
    number = F.create_map(*[x for i, name in enumerate(languages) for x in (F.lit(name), F.lit(i))]) if languages else None
    masks = np.zeros((n, max(1, -(-len(languages) // 64))), np.uint64)
    if languages:
        u = F.col("g")
        at = [F.shiftrightunsigned(u, 24 * i).bitwiseAND(F.lit(n - 1).cast("long")) for i in range(HASHES)]
        bits = known.select(F.explode(F.array(*at)).alias("slot"), number[F.col("lang")].alias("i"))
        bits = bits.groupBy("slot", F.shiftright("i", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, i & 63)")).alias("mask")).toArrow()  # the filter itself
        masks[bits["slot"].to_numpy(), bits["word"].to_numpy()] = bits["mask"].to_numpy().view(np.uint64)
    common.drop(counts)
    return Filter(languages, masks)


def predict(docs: DataFrame, model: Filter, text_column: str = "text") -> DataFrame:
    """docs with lang_pred and score; columns of docs with these names are replaced."""
    docs = docs.drop("lang_pred", "score")
    spark = common.ready(docs.sparkSession)
    sent = spark.sparkContext.broadcast((model.languages, model.masks))
    names = docs.columns

    def label(batches):
        m = None
        for batch in batches:
            m = m or Filter(*sent.value)
            for b in common.slices(batch, text_column):
                lang, score = m.predict(b.column(text_column))
                yield pa.record_batch([*b.columns, pa.array(lang, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(label, schema)


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


def op5_language(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    model = train(docs.where(~F.coalesce(held_out(), F.lit(False))).select("text", "lang"))
    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")

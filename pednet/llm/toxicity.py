"""Toxicity by FTRL-proximal logistic regression (McMahan et al. 2013) over hashed word n-grams and skip-grams.

Features of a text: each word (a run of bytes other than ASCII marks and blanks; A-Z as a-z), each pair of neighbours and each pair with a word
between, hashed into BUCKETS; each counts once a text. Every coordinate has a rate of its own, ALPHA / (BETA + sqrt(its squared gradients)),
and an L1 penalty that leaves most weights at zero, so that the model is a short list of buckets and weights.

Training rows are dealt into shards of SHARD rows by the hash of their id. In each of ROUNDS rounds every shard, in a task of its own, goes on from the
common state over its rows in the order of their hash; the changes of the shards' states are averaged for the next round (iterative parameter mixing,
McDonald et al. 2010), summed by blocks of buckets in the order of shards, so that reruns agree. All labelled rows train: no sample is taken.
The penalty is L1 times the square root of a shard's rows, since the noise in a coordinate's gradients grows like that.

What passes through the driver and is broadcast: two doubles a bucket (8 MB) while training, the nonzero weights for scoring.
Edge cases: null text is empty; empty texts have the score of the bias alone; a document is toxic if any of its labels says so; null labels, labels
without a document, and null ids don't train; repeated rows train as often as they come; without training rows all scores are 0; an
empty table gives none; columns of docs with the names of results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pednet.llm import common, terms

BUCKETS = 1 << 19
#: Distances of the words of a pair: neighbours, and those with a word between.
STEPS = (1, 2)
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.3, 0.0
ROUNDS = 10
SHARD = 1 << 14
#: The largest step between features, where they are stored.
STEP = 0xFFFF
#: Buckets of a row of the state.
BLOCK = 1 << 14
#: Scores from which a text is predicted as toxic.
THRESHOLD = 0.7
#: Labels are broadcast up to so many rows, else joined by shuffle.
BROADCAST_ROWS = 500_000

GAP = terms.gaps("".join(chr(c) for c in range(128) if not chr(c).isalnum()))


def buckets(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The features of all documents, and the document of each; repeated ones too."""
    _, _, h, doc = terms.split(*common.utf8(text), GAP)
    parts, docs = [h], [doc]
    with np.errstate(over="ignore"):
        for k in STEPS:
            same = doc[k:] == doc[:-k]
            parts.append(common.mix(h[:-k] * np.uint64(3) + h[k:] * np.uint64(7) + np.uint64(k))[same])
            docs.append(doc[:-k][same])
    return (np.concatenate(parts) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(docs)


def steps(key: np.ndarray) -> np.ndarray:
    """Rising numbers as 16-bit steps; one of STEP goes on without a number."""
    step = np.diff(key, prepend=0)
    n = step // STEP + 1
    out = np.full(n.sum(), STEP, np.uint16)
    out[np.cumsum(n) - 1] = step % STEP
    return out


def numbers(step: np.ndarray) -> np.ndarray:
    return np.cumsum(step, dtype=np.int64)[step != STEP]


@dataclass
class State:
    """z and n of every bucket; the last of each is the bias."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def new(cls) -> State:
        return cls(np.zeros(BUCKETS + BLOCK), np.zeros(BUCKETS + BLOCK))

    def weights(self, at, l1: float) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, x: np.ndarray, y: float, l1: float) -> None:
        """One step with the distinct features x; the bias has no penalty."""
        w, bias = self.weights(x, l1), self.weights(slice(BUCKETS, BUCKETS + 1), 0.0)
        g = sigmoid(bias[0] + w.sum()) - y
        for at, old in ((x, w), (slice(BUCKETS, BUCKETS + 1), bias)):
            n = self.n[at]
            grown = n + g * g
            self.z[at] += g - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * old
            self.n[at] = grown


def sigmoid(s):
    return 1 / (1 + np.exp(-np.clip(s, -35, 35)))


@dataclass(frozen=True)
class Model:
    """Nonzero weights by bucket; bias is None without training rows."""

    at: np.ndarray
    weight: np.ndarray
    bias: float | None

    def score(self, text: pa.Array) -> np.ndarray:
        out = np.zeros(len(text))
        if self.bias is None:
            return out
        table = np.full(BUCKETS, -1, np.int32)
        table[self.at] = np.arange(len(self.at))
        x, doc = buckets(text)
        hit = np.flatnonzero(table[x] >= 0)
        once = np.unique(doc[hit] * BUCKETS + x[hit])
        np.add.at(out, once // BUCKETS, self.weight[table[once % BUCKETS]])
        return sigmoid(out + self.bias)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic."""
    spark = common.ready(docs.sparkSession)
    truth = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("__y"))
    small = truth.count() <= BROADCAST_ROWS
    rows = docs.select("doc_id", "text").join(F.broadcast(truth) if small else truth, F.col("doc_id") == F.col("__id"))
    n = rows.count()
    if not n:
        return Model(np.zeros(0, np.int64), np.zeros(0), None)
    shards = -(-n // SHARD)
    l1 = L1 * (n / shards) ** 0.5

    def features(batches):
        for batch in batches:
            for b in common.slices(batch):
                x, doc = buckets(b.column("text"))
                key = np.unique(doc * BUCKETS + x)
                cut = np.searchsorted(key, np.arange(b.num_rows + 1) * BUCKETS).tolist()
                each = pa.array([steps(key[i:j] % BUCKETS).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
                yield pa.record_batch([b.column("shard"), b.column("turn"), b.column("y"), each], names=["shard", "turn", "y", "x"])

    turn = F.xxhash64("doc_id")
    dealt = rows.select(F.pmod(turn, F.lit(shards)).cast("int").alias("shard"), turn.alias("turn"), F.col("__y").alias("y"), "text")
    dealt = dealt.mapInArrow(features, "shard int, turn long, y int, x binary").repartition(shards, "shard").sortWithinPartitions("shard", "turn", "x")
    dealt = dealt.persist(StorageLevel.DISK_ONLY)  # read once a round; what a lost executor held is made again from the texts
    state = State.new()
    blocks = len(state.z) // BLOCK

    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast((state.z, state.n))

        def learn(batches, sent=sent):
            def out(shard, now):
                change = np.stack([(now.z - sent.value[0]).reshape(blocks, BLOCK), (now.n - sent.value[1]).reshape(blocks, BLOCK)], 1)
                return pa.record_batch([pa.array(np.arange(blocks, dtype=np.int32)), pa.array(np.full(blocks, shard, np.int32)), pa.array([c.astype(np.float32).tobytes() for c in change], pa.binary())], names=["block", "shard", "change"])

            shard = now = None
            for b in batches:
                for s, y, x in zip(b.column("shard").to_pylist(), b.column("y").to_pylist(), b.column("x"), strict=True):
                    if s != shard:
                        if now is not None:
                            yield out(shard, now)
                        shard, now = s, State(sent.value[0].copy(), sent.value[1].copy())
                    now.learn(numbers(np.frombuffer(x.as_buffer(), np.uint16)), y, l1)
            if now is not None:
                yield out(shard, now)

        def total(batches):
            block, held = None, None
            for b in batches:
                for i, c in zip(b.column("block").to_pylist(), b.column("change").to_pylist(), strict=True):
                    if i != block:
                        if block is not None:
                            yield pa.record_batch([pa.array([block], pa.int32()), pa.array([held.tobytes()])], names=["block", "change"])
                        block, held = i, np.zeros(2 * BLOCK)
                    held = held + np.frombuffer(c, np.float32)
            if block is not None:
                yield pa.record_batch([pa.array([block], pa.int32()), pa.array([held.tobytes()])], names=["block", "change"])

        changes = dealt.mapInArrow(learn, "block int, shard int, change binary").repartition("block").sortWithinPartitions("block", "shard")
        for r in changes.mapInArrow(total, "block int, change binary").collect():  # the state: its size is fixed
            change = np.frombuffer(r["change"], float).reshape(2, BLOCK) / shards
            at = slice(r["block"] * BLOCK, (r["block"] + 1) * BLOCK)
            state.z[at] += change[0]
            state.n[at] += change[1]
        sent.destroy()
    dealt.unpersist()
    w = state.weights(slice(0, BUCKETS), l1)
    at = np.flatnonzero(w)
    return Model(at, w[at], float(state.weights(slice(BUCKETS, BUCKETS + 1), 0.0)[0]))


def score(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """docs with score and predicted."""
    docs = docs.drop("score", "predicted")
    spark, names = common.ready(docs.sparkSession), docs.columns
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for b in common.slices(batch, text_column):
                s = sent.value.score(b.column(text_column))
                yield pa.record_batch([*b.columns, pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=[*names, "score", "predicted"])

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(run, schema)


def held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    model = train(docs.where(~held_out()), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return score(rows, model).select("doc_id", "held_out", "score", "predicted")

"""Token-id output: documents as ids in shards, each compressed by a Re-Pair grammar (Larsson and Moffat 2000).

A shard holds about SHARD_IDS ids of whole documents in ascending doc_id order. Rounds replace adjacent id pairs by new symbols until no
pair occurs LEAST_COUNT times; no symbol crosses a document's end, so a document, or any range of ids, is decoded from its own symbols by the
rules' stored expansion lengths. A round replaces each pair where it is more frequent than the pairs that overlap it, so the most frequent
pair is replaced everywhere and others wherever they don't stand in its way; in a run of one id every second pair counts.

The file format is a Parquet table with one row a shard (columns: SHARDS).
Edge cases: null text is empty (only the end id); null doc_id sorts first; rows with one doc_id (or without one) are ordered by a hash of their text, so that
many of them spread over tasks; an empty table gives none.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pednet.llm import common, tokens

SHARD_IDS = 1 << 20
#: A rule (8 bytes: two symbols and an expansion length) pays from so many uses on, each of which saves a symbol of 2 bytes.
LEAST_COUNT = 5
#: Pairs are counted by this many bits of a hash first, and exactly where a hash has LEAST_COUNT pairs or more.
HASH_BITS = 18
END_ID = 1

SHARDS = "part int, shard int, doc_ids binary, null_ids binary, n_ids binary, symbols_before binary, terminals binary, left binary, right binary, expansion binary, symbols binary, ids long"


def compress(ids: np.ndarray, ends: np.ndarray) -> dict:
    """The grammar of a shard's ids. ends: where each document ends. Symbols below len(terminals) are terminals, then rules in order."""
    terminals, seq = np.unique(ids, return_inverse=True)
    seq = seq.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[ends[ends > 0] - 1] = True
    left, right, t = [], [], len(terminals)
    live = np.ones(len(seq), bool)  # where a pair may pay; one that doesn't never will, as its count only gets less
    while len(seq) > 1:
        at = np.flatnonzero(live[:-1] & ~last[:-1])
        a, b = seq[at], seq[at + 1]
        same = np.flatnonzero(a == b)
        if len(same):  # runs of one id: every second place
            run = np.concatenate([[True], np.diff(at[same]) > 1])
            once = np.ones(len(at), bool)
            once[same[(np.arange(len(same)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 1]] = False
            at, a, b = at[once], a[once], b[once]
        bucket = ((a * np.uint32(2654435761)) ^ (b * np.uint32(2246822519))) >> np.uint32(32 - HASH_BITS)
        maybe = (np.bincount(bucket, minlength=1 << HASH_BITS) >= LEAST_COUNT)[bucket]
        live[at[~maybe]] = False
        wide = np.uint32 if t + len(left) <= 1 << 16 else np.uint64  # of a pair
        half = wide(4 * wide().itemsize)
        at, key = at[maybe], (a[maybe].astype(wide) << half) | b[maybe].astype(wide)
        if wide is np.uint32 and len(key) < 1 << 32:  # pairs and their places sorted as one number
            order = np.sort((key.astype(np.uint64) << np.uint64(32)) | np.arange(len(key), dtype=np.uint64))
            by, order = (order >> np.uint64(32)).astype(np.uint32), (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
        else:
            order = np.argsort(key)
            by = key[order]
        new = np.flatnonzero(np.concatenate([[True], by[1:] != by[:-1]])) if len(key) else np.zeros(0, np.int64)
        pair, n = by[new], np.diff(np.append(new, len(key)))
        if not (n >= LEAST_COUNT).any():
            break
        which = np.empty(len(key), np.int64)
        which[order] = np.repeat(np.arange(len(n)), n)
        rank = np.zeros(len(n), np.int32)
        rank[np.argsort(n, kind="stable")] = np.arange(1, len(n) + 1)
        rank[n < LEAST_COUNT] = 0
        live[at[n[which] < LEAST_COUNT]] = False
        best = np.zeros(len(seq) + 1, np.int32)  # of the pair at each place, with a zero at either end
        best[at + 1] = rank[which]
        won = (best[at + 1] > best[at]) & (best[at + 1] > best[at + 2])
        paying = np.bincount(which[won], minlength=len(n)) >= LEAST_COUNT
        symbol = np.cumsum(paying) - 1 + t + len(left)
        won &= paying[which]
        left += (pair[paying] >> half).astype(int).tolist()
        right += (pair[paying] & ((wide(1) << half) - wide(1))).astype(int).tolist()
        at, which = at[won], which[won]
        seq[at] = symbol[which]
        last[at] = last[at + 1]
        live[at] = True
        live[at[at > 0] - 1] = True
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq, last, live = seq[stay], last[stay], live[stay]
    expansion = np.ones(t + len(left), np.uint32)
    for i, (x, y) in enumerate(zip(left, right, strict=True)):
        expansion[t + i] = expansion[x] + expansion[y]
    small = np.uint16 if t + len(left) < 1 << 16 else np.uint32
    return {"terminals": terminals.astype(np.uint16), "left": np.array(left, np.uint32), "right": np.array(right, np.uint32), "expansion": expansion, "symbols": seq.astype(small), "document_ends": np.flatnonzero(last) + 1}


def _unpack(row: dict) -> dict:
    terminals, expansion = np.frombuffer(row["terminals"], np.uint16), np.frombuffer(row["expansion"], np.uint32)
    return {"terminals": terminals, "expansion": expansion, "left": np.frombuffer(row["left"], np.uint32), "right": np.frombuffer(row["right"], np.uint32), "symbols": np.frombuffer(row["symbols"], np.uint16 if len(expansion) < 1 << 16 else np.uint32)}


def expand(g: dict, symbols: np.ndarray) -> np.ndarray:
    """The ids that symbols stand for."""
    t, size = len(g["terminals"]), g["expansion"].astype(np.int64)
    base = np.concatenate([[0], np.cumsum(size)])
    arena = np.empty(base[-1], np.uint16)
    arena[:t] = g["terminals"]
    for i, (x, y) in enumerate(zip(g["left"].tolist(), g["right"].tolist(), strict=True)):
        at, n = base[t + i], size[x]
        arena[at : at + n] = arena[base[x] : base[x] + n]
        arena[at + n : base[t + i + 1]] = arena[base[y] : base[y] + size[y]]
    n = size[symbols]
    total = np.cumsum(n)
    return arena[np.repeat(base[symbols] - (total - n), n) + np.arange(total[-1] if len(total) else 0)]


def decode_range(row: dict, start: int, length: int) -> np.ndarray:
    """ids[start : start + length] of a shard row: only the symbols that overlap the range are expanded."""
    g = _unpack(row)
    ends = np.cumsum(g["expansion"][g["symbols"]].astype(np.int64))
    i, j = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, start + length, "left")) + 1
    before = int(ends[i - 1]) if i else 0
    return expand(g, g["symbols"][i:j])[start - before : start - before + length]


def encode(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Write the documents' ids as compressed shards, in ascending id order; returns the written table."""
    common.ready(docs.sparkSession)

    def shards(batches):
        from pyspark import TaskContext

        enc, part, k, held, size = tokens.encoder(tokenizer), TaskContext.get().partitionId(), 0, [], 0

        def flush():
            ids, n = np.concatenate([x[2] for x in held]), np.concatenate([x[3] for x in held])
            g = compress(ids, np.cumsum(n))
            ends = np.concatenate([[0], g["document_ends"]]).astype(np.int64)[: len(n)]
            raw = [np.concatenate([x[0] for x in held]).tobytes(), np.packbits(np.concatenate([x[1] for x in held])).tobytes(), n.tobytes(), ends.tobytes(), *(g[c].tobytes() for c in ("terminals", "left", "right", "expansion", "symbols"))]
            cols = [pa.array([part], pa.int32()), pa.array([k], pa.int32()), *(pa.array([x], pa.binary()) for x in raw), pa.array([len(ids)], pa.int64())]
            return pa.record_batch(cols, names=[x.split()[0] for x in SHARDS.split(", ")])

        for batch in batches:
            for b in common.slices(batch):
                ids, n = tokens.with_end(*enc.encode(*common.utf8(b.column("text"))), END_ID)
                doc = b.column("id")
                held.append((pa.compute.fill_null(doc, 0).to_numpy(zero_copy_only=False), doc.is_null().to_numpy(zero_copy_only=False), ids, n))
                size += len(ids)
                if size >= SHARD_IDS:
                    yield flush()
                    held, size, k = [], 0, k + 1
        if held:
            yield flush()

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return common.written(rows.repartitionByRange("id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"), "text").mapInArrow(shards, SHARDS), "ids")


def decode(shards: DataFrame) -> DataFrame:
    """Each document's place and checksum, from the files: doc_id, start, n_tokens, ids_crc32."""
    common.ready(shards.sparkSession)

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = np.frombuffer(row["n_ids"], np.int64)
                ids = expand(g := _unpack(row), g["symbols"]).astype("<u4")
                at = np.concatenate([[0], np.cumsum(n)])
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                doc = pa.array(np.frombuffer(row["doc_ids"], np.int64), mask=np.unpackbits(np.frombuffer(row["null_ids"], np.uint8), count=len(n)).astype(bool))
                same = [pa.array(np.full(len(n), row[c]), pa.int32()) for c in ("part", "shard")]
                yield pa.record_batch([doc, pa.array(n), pa.array(crc, pa.int64()), *same, pa.array(at[:-1])], names=["doc_id", "n_tokens", "ids_crc32", "part", "shard", "inside"])

    # ids before a shard: one row a part in the only window over everything, then shards within their part
    each = shards.select("part", "shard", "ids")
    parts = each.groupBy("part").agg(F.sum("ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    each = each.select("part", "shard", (F.sum("ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("ids")).alias("before_shard"))
    docs = shards.mapInArrow(read, "doc_id long, n_tokens long, ids_crc32 long, part int, shard int, inside long")
    return docs.join(each.join(parts, "part"), ["part", "shard"]).select("doc_id", (F.col("before_part") + F.col("before_shard") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def op2_repair_ids(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return decode(encode(docs, tokens.tokenizer_path("word_bpe_49k.json")))

"""Packing: documents' ids into sequences of at most WINDOW ids, by non-negative least squares on the length histogram (Krell et al. 2021).

A document is cut into pieces of WINDOW ids and a rest. Rests are counted by length in steps of STEP ids. Every combination of up to three
lengths, or of a run of one length and another, that fills a window is a column; non-negative least squares gives each column's repeat count; counts are rounded, and a greedy
best fit packs what is left. Only the histogram (WINDOW / STEP numbers) and the plan made from it pass through the driver. Pieces
find their sequence by their rank among the pieces of one length, from ranks within a task and offsets of tasks.

Edge cases: null text is an empty document of one id (the end id); repeated rows are documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pednet.llm import common, tokens

WINDOW = 2048
STEP = 8
END_ID = 1

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task int, bin int, local long"


def combinations(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shallow fillings that add up to size, each once: up to three lengths, or a run of one length and another. Rows of lengths (0: none)
    and of how often each stands there."""
    one = [((size - b - c, b, c), (1, 1, 1)) for c in range(size // 3 + 1) for b in range(c, (size - c) // 2 + 1)]
    runs = [((b, size - k * b, 0), (k, 1, 0)) for b in range(1, size // 3 + 1) for k in range(3, size // b + 1)]
    return tuple(np.array(x, np.int64) for x in zip(*one, *runs, strict=True))


def solve(lengths: np.ndarray, times: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """x >= 0 of least |A x - histogram| by the active-set method (Lawson and Hanson 1974); A counts each column's lengths. As many x at most
    are above zero as there are lengths. It ends when no length is off by half a piece, or no column makes the sum of squares less."""
    a = np.zeros((len(histogram), len(lengths)))
    np.add.at(a, (lengths.ravel(), np.repeat(np.arange(len(lengths)), lengths.shape[1])), times.ravel())
    a[0] = 0  # length 0 stands for nothing
    goal, x, active = histogram.astype(float), np.zeros(len(lengths)), np.zeros(len(lengths), bool)
    goal[0], least, tried = 0, np.inf, np.zeros(len(lengths), bool)  # tried: columns that made no difference since the last that did
    while True:
        rest = goal - a @ x
        if np.abs(rest).max() < 0.5:
            return x
        if rest @ rest < least * (1 - 1e-9):
            least, tried[:] = rest @ rest, False
        slope = np.where(active | tried, -np.inf, a.T @ rest)
        new = slope.argmax()
        if slope[new] <= 1e-7 * max(1.0, goal.max()):
            return x
        active[new] = tried[new] = True
        while True:
            at = np.flatnonzero(active)
            gram = a[:, at].T @ a[:, at]
            z = np.linalg.solve(gram + 1e-10 * np.eye(len(at)), a[:, at].T @ goal)
            if (z > 0).all():
                x[at] = z
                break
            low = z <= 0
            way = (x[at][low] / np.maximum(x[at][low] - z[low], 1e-300)).min()
            x[at] += way * (z - x[at])
            gone = at[x[at] <= 1e-9 * max(1.0, goal.max())]
            gone = gone if len(gone) else at[low][:1]
            x[gone], active[gone] = 0, False


def plan(histogram: np.ndarray) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many such sequences) that use up the histogram; index: length in steps."""
    size, left = len(histogram) - 1, histogram.astype(np.int64).copy()
    out = solved(left)
    while left.any():  # the largest first, then whatever fits best; a filling is repeated as often as its lengths last
        room, filling, now = size, [], left.copy()
        while room > 0 and (fits := np.flatnonzero(now[: room + 1])).size:
            filling.append(int(fits[-1]))
            now[fits[-1]] -= 1
            room -= int(fits[-1])
        lengths, need = np.unique(filling, return_counts=True)
        n = int((left[lengths] // need).min())
        left[lengths] -= n * need
        out.append((filling, n))
    return out


def solved(left: np.ndarray) -> list[tuple[list[int], int]]:
    """What the solution fills, rounded: the whole part of each count, then one more for the largest fractions that still find their pieces.
    Takes the pieces out of left."""
    columns, times = combinations(len(left) - 1)
    x, out = solve(columns, times, left), []
    whole = np.floor(x + 1e-6).astype(np.int64)
    for count, order in ((whole, np.argsort(-whole, kind="stable")), ((x - whole > 1e-6).astype(np.int64), np.argsort(whole - x, kind="stable"))):
        for k in order.tolist():
            if count[k] <= 0:
                break
            filling = np.repeat(columns[k], times[k] * (columns[k] > 0))
            lengths, need = np.unique(filling, return_counts=True)
            n = int(min(count[k], (left[lengths] // need).min()))
            if n > 0:
                left[lengths] -= n * need
                out.append((filling.tolist(), n))
    return out


def segments(the_plan: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, pieces of this length a sequence, slot), by rank."""
    rank, out, sequence = {}, {}, 0
    for filling, n in the_plan:
        for slot, b in enumerate(filling):
            if slot and filling[slot - 1] == b:
                continue
            m = filling.count(b)
            out.setdefault(b, []).append((rank.get(b, 0), sequence, m, slot))
            rank[b] = rank.get(b, 0) + m * n
        sequence += n
    return {b: np.array(x, np.int64) for b, x in out.items()}


def cut(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents' pieces with their checksums, and each piece's rank among those of its length in its task."""
    common.ready(docs.sparkSession)

    def pieces(batches):
        from pyspark import TaskContext

        enc, task, seen = tokens.encoder(tokenizer), TaskContext.get().partitionId(), np.zeros(WINDOW // STEP + 1, np.int64)
        for batch in batches:
            for b in common.slices(batch):
                ids, n = tokens.with_end(*enc.encode(*common.utf8(b.column("text"))), END_ID)
                raw, first = ids.astype("<u4").tobytes(), np.cumsum(n) - n
                count = -(-n // WINDOW)
                doc = np.repeat(np.arange(len(n)), count)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
                length = np.minimum(WINDOW, n[doc] - start)
                at = first[doc] + start
                crc = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(at.tolist(), (at + length).tolist(), strict=True)]
                bins = -(-length // STEP)
                order = np.argsort(bins, kind="stable")
                new = np.bincount(bins, minlength=len(seen))
                local = np.empty(len(bins), np.int64)
                local[order] = np.arange(len(bins)) - np.repeat(np.cumsum(new) - new, new) + seen[bins[order]]
                seen += new
                cols = [b.column("id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[doc]), pa.array(np.full(len(doc), task, np.int32)), pa.array(bins.astype(np.int32)), pa.array(local)]
                yield pa.record_batch(cols, names=[x.split()[0] for x in PIECES.split(", ")])

    return common.written(docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")).mapInArrow(pieces, PIECES), "pieces")


def pack(pieces: DataFrame) -> DataFrame:
    """Each piece with its sequence_id and its offset there."""
    counts = pieces.groupBy("task", "bin").agg(F.count("*").alias("n"))
    histogram = np.zeros(WINDOW // STEP + 1, np.int64)
    for r in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # WINDOW / STEP rows at most
        histogram[r["bin"]] = r["n"]
    where = segments(plan(histogram)) if histogram.any() else {}

    def place(batches):
        for b in batches:
            bins, rank = b.column("bin").to_numpy(), b.column("before").to_numpy() + b.column("local").to_numpy()
            seq, slot = np.zeros(len(bins), np.int64), np.zeros(len(bins), np.int64)
            for x in np.unique(bins).tolist():
                at = np.flatnonzero(bins == x)
                s = where[x][np.searchsorted(where[x][:, 0], rank[at], "right") - 1]
                k = rank[at] - s[:, 0]
                seq[at], slot[at] = s[:, 1] + k // s[:, 2], s[:, 3] + k % s[:, 2]
            yield pa.record_batch([b.column(i) for i in range(5)] + [pa.array(seq), pa.array(slot)], names=[*b.schema.names[:5], "sequence_id", "slot"])

    before = counts.select("task", "bin", (F.sum("n").over(Window.partitionBy("bin").orderBy("task")) - F.col("n")).alias("before"))
    rows = pieces.join(before, ["task", "bin"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "bin", "local", "before")
    rows = rows.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long")
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")).drop("slot")


def op6_pack(spark, sf_dir: str) -> DataFrame:
    return pack(cut(common.documents(spark, sf_dir), tokens.tokenizer_path("byte_bpe_50k.json")))

"""Line dedup: fuzzy equal lines over all documents, one line of each component kept.

A line's normal form is lower case with single spaces; blank lines take no part. Equal normal forms are one line. A line's signature holds
BANDS bands of ROWS MinHash values of its character shingles, by one permutation with optimal densification (Shrivastava 2017): one hash a
shingle, its high half choosing the value's place and its low half the value, empty places filled from others. Two lines are
candidates if a band agrees (0.995 of the pairs at similarity 0.8, 2e-6 of those at 0.07), and link if the exact Jaccard similarity of
their shingle sets is PERCENT or more.

Bands travel packed: a task sends, for each of as many hash ranges as the lines need, one row with the bands and lines that fall there. A bucket
is a band with several lines, in blocks of at most BLOCK; equal buckets are one. Each block (with the bucket's least line, if it has several blocks) is verified exactly and gives at most one link a line.
Buckets of several blocks whose lines are still in several components are then compared in units of two blocks, one of
them outside the bucket's largest component. Distributed union-find joins all links. Of a component, the line of the smallest (doc_id, text
hash, line number) stays.

Edge cases: null and empty texts have no lines; lines shorter than a shingle are equal or not, never fuzzy; rows that repeat a doc_id and
text are one document and keep the same lines; ties of similarity don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pednet.llm import common

SHINGLE = 5
PERCENT = 80
BANDS = 18
ROWS = 6
#: Lines that are verified with one another at once.
BLOCK = 512
#: Shingles of a block's matrix at once; bits of a shingle's hash; and how far from the limit a count of these decides.
MATRIX = 4096
HASH = 44
NEAR = 1

_M = BANDS * ROWS
_EMPTY = np.uint32(0xFFFFFFFF)
#: Where an empty place looks for a value: a permutation of the places an attempt.
_PROBES = np.stack([np.random.default_rng(23 + i).permutation(_M) for i in range(64)])


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def shingle_set(line: str) -> set[str]:
    return {line[i : i + SHINGLE] for i in range(len(line) - SHINGLE + 1)}


def similar(a: set[str], b: set[str]) -> bool:
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= PERCENT * (len(a) + len(b) - both)


def codes_of(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of all lines (0 after each), where shingles start, and the line of each."""
    codes = np.frombuffer(("\x00".join(x.replace("\x00", " ") if "\x00" in x else x for x in lines) + "\x00").encode("utf-32-le", "replace"), np.uint32)
    end = codes == 0
    line = np.cumsum(end, dtype=np.int32) - end
    if len(codes) < SHINGLE:
        return codes, np.zeros(0, np.int64), np.zeros(0, np.int64)
    n = len(codes) - SHINGLE + 1
    start = np.flatnonzero((line[:n] == line[SHINGLE - 1 :]) & ~end[SHINGLE - 1 :])
    return codes, start, line[start]


def hashes(codes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hashes of the shingles that start there."""
    n = len(codes) - SHINGLE + 1
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            h *= np.uint64(0x9E3779B97F4A7C15)
            h += codes[i : n + i]
            h += np.uint64(1)
    return common.mix(h[start])


def bands(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Which lines have a shingle, and these lines' band hashes."""
    codes, start, line = codes_of(lines)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros((0, BANDS), np.uint64)
    h = hashes(codes, start)
    with np.errstate(over="ignore"):
        new = np.concatenate([[True], line[1:] != line[:-1]])
        row = np.cumsum(new, dtype=np.int32) - np.int32(1)
        place = row * np.int64(_M) + ((h >> np.uint64(32)) * np.uint64(_M) >> np.uint64(32)).astype(np.int64)
        low = np.full((int(row[-1]) + 1) * _M, _EMPTY, np.uint32)
        np.minimum.at(low, place, np.minimum(h.astype(np.uint32), _EMPTY - np.uint32(1)))
        filled, left = low.copy(), np.flatnonzero(low == _EMPTY)
        k = left % _M
        base, attempt = left - k, 0
        while len(left):  # every row has a value
            v = low[base + (_PROBES[attempt][k] if attempt < len(_PROBES) else (k + attempt) % _M)]
            ok = v != _EMPTY
            filled[left[ok]] = v[ok]
            ok = ~ok
            left, base, k, attempt = left[ok], base[ok], k[ok], attempt + 1
        filled = filled.reshape(-1, _M)
        out = np.zeros((len(filled), BANDS), np.uint64)
        for i in range(_M):
            out[:, i // ROWS] = common.mix(out[:, i // ROWS] + filled[:, i] + np.uint64(i))
    return line[new], out


def split(docs: DataFrame) -> DataFrame:
    """A row for each line that isn't blank: id, row (hash of the text), nth, n (lines of the document, in its first row), k1 and k2 (digest
    of the normal form); where the task meets it first, also the normal form and its bands."""

    def run(batches):
        for batch in batches:
            for b in common.slices(batch):
                ids, doc, nth, n, keys, hashes = b.column("id"), [], [], [], [], []
                seen, fresh, texts = set(), [], []
                for i, text in enumerate(b.column("text").to_pylist()):
                    if not text:
                        continue
                    first = len(nth)
                    for at, line in enumerate(text.split("\n")):
                        if norm := normal(line):
                            if norm not in seen:
                                seen.add(norm)
                                fresh.append(len(nth))
                                texts.append(norm)
                            keys.append(common.digest(norm.encode("utf-8", "replace")))
                            nth.append(at)
                    if len(nth) > first:
                        hashes += [common.digest(text.encode("utf-8", "replace"))[:8]] * (len(nth) - first)
                        doc += [i] * (len(nth) - first)
                        n += [len(nth) - first] + [None] * (len(nth) - first - 1)
                which, sig = bands(texts)
                k = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                line, packed = [None] * len(nth), [None] * len(nth)
                for i, x in zip(which.tolist(), sig, strict=True):
                    line[fresh[i]], packed[fresh[i]] = texts[i], x.tobytes()
                cols = [ids.take(pa.array(doc, pa.int64())), pa.array(np.frombuffer(b"".join(hashes), "<i8")), pa.array(nth, pa.int32()), pa.array(n, pa.int32()), pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(line, pa.string()), pa.array(packed, pa.binary())]
                yield pa.record_batch(cols, names=["id", "row", "nth", "n", "k1", "k2", "line", "bands"])

    return docs.mapInArrow(run, "id long, row long, nth int, n int, k1 long, k2 long, line string, bands binary")


def buckets(every: DataFrame, bits: int) -> DataFrame:
    """Blocks of the bands that several lines have: bucket, members (at most BLOCK)."""

    def blocks(key, line, _):
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        out = []
        for a, c in zip(new.tolist(), np.diff(np.append(new, len(key))).tolist(), strict=True):
            size = -(-c // -(-c // BLOCK))  # blocks of like size
            out += [(key[a], line[i : min(i + size, a + c)]) for i in range(a, a + c, size)]
        return pa.record_batch([pa.array(np.array([k for k, _ in out], np.uint64).view(np.int64)), common.lists([m for _, m in out], pa.int64())], names=["bucket", "members"])

    keys = every.where("bands is not null").select(F.col("k1").alias("owner"), F.col("bands").alias("keys"))
    return common.meet(common.pack(keys, bits), blocks, "bucket long, members array<long>")


def shingles_of(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each line, as sorted hashes of HASH bits below the line's number, and where each line's begin (with the end)."""
    codes, start, line = codes_of(lines)
    key = np.zeros(0, np.uint64)
    if len(start):
        key = (line.astype(np.uint64) << np.uint64(HASH)) | (hashes(codes, start) >> np.uint64(64 - HASH))
        key.sort()
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return key & np.uint64((1 << HASH) - 1), np.searchsorted(key, np.arange(len(lines) + 1, dtype=np.uint64) << np.uint64(HASH))


def overlaps(shingle: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For all pairs of lines, the shingles in common. first: where each line's begin (with the end)."""
    n = len(first) - 1
    line = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
    key = (shingle[first[0] : first[-1]] << np.uint64(64 - HASH)) | line
    key.sort()
    new = np.concatenate([[True], (key[1:] ^ key[:-1]) >= np.uint64(1 << (64 - HASH))]) if len(key) else np.zeros(0, bool)
    times = np.diff(np.append(np.flatnonzero(new), len(key)))
    shared = np.repeat(times > 1, times)
    line = (key[shared] & np.uint64((1 << (64 - HASH)) - 1)).astype(np.int64)
    column = np.cumsum(new[shared]) - 1
    both = np.zeros((n, n), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, MATRIX):
        a, b = np.searchsorted(column, [at, at + MATRIX])
        x = np.zeros((n, min(MATRIX, int(column[-1]) + 1 - at)), np.float32)
        x[line[a:b], column[a:b] - at] = 1
        both += x @ x.T
    return both.astype(np.int64)


def decided(both: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs are similar by their counts of hashed shingles, and which counts are so near the limit that hashes met by chance
    could decide: these are compared as texts. sizes: of both lines together."""
    least = -(-PERCENT * sizes // (100 + PERCENT))
    return (both >= least) & (both > 0), np.abs(both - least) <= NEAR


def joined(lines: list[str], root: np.ndarray, shingle: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each line the first line of its component, from exact similarity and what is joined already (equal roots)."""
    n, size = len(lines), np.diff(first)
    near, doubt = decided(overlaps(shingle, first), size[:, None] + size[None, :])
    near &= ~doubt
    near |= root[:, None] == root[None, :]
    label = np.arange(n)
    while True:
        low = np.where(near, label[None, :], n).min(1)
        low = np.minimum(low, low[low])
        if (low == label).all():
            break
        label = low
    sets = {}
    for i, j in zip(*np.nonzero(np.triu(doubt & (label[:, None] != label[None, :]), 1)), strict=True):
        if label[i] != label[j] and similar(*(sets.setdefault(k, sets.get(k) or shingle_set(lines[k])) for k in (i, j))):
            label[np.isin(label, (label[i], label[j]))] = min(label[i], label[j])
    return label


def pairs_of(lines: list[str], shingle: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the places at, those whose line is similar to the next."""
    size = np.diff(first)
    both = np.concatenate([at, at + 1])
    unit = np.concatenate([np.arange(len(at))] * 2).repeat(size[both]).astype(np.uint64)
    inside = np.arange(size[both].sum()) - np.repeat(np.cumsum(size[both]) - size[both], size[both])
    key = (unit << np.uint64(HASH)) | shingle[np.repeat(first[both], size[both]) + inside]
    key.sort()
    count = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(HASH)).astype(np.int64), minlength=len(at))
    near, doubt = decided(count, size[at] + size[at + 1])
    for k in np.flatnonzero(doubt).tolist():
        near[k] = similar(shingle_set(lines[at[k]]), shingle_set(lines[at[k] + 1]))
    return at[near]


def links_of(units: DataFrame) -> DataFrame:
    """Links (a, b) of each unit, fewer than it has lines. units: unit, k1, root, line; sorted by unit."""

    def run(batches):
        for t, edges in common.whole_groups(batches, "unit"):
            key, root, lines = t.column("k1").to_numpy(), t.column("root").to_numpy(), t.column("line").to_pylist()
            shingle, first = shingles_of(lines)
            edges = np.array(edges)
            n = np.diff(edges)
            one = pairs_of(lines, shingle, first, edges[:-1][n == 2])
            links = [np.stack([one, one + 1])]
            for i, j in zip(edges[:-1][n > 2].tolist(), edges[1:][n > 2].tolist(), strict=True):
                to = joined(lines[i:j], root[i:j], shingle, first[i : j + 1])
                links.append(np.stack([np.arange(i, j), i + to])[:, to != np.arange(j - i)])
            a, b = np.concatenate(links, 1)
            new = root[a] != root[b]
            if new.any():
                yield pa.record_batch([pa.array(key[a[new]]), pa.array(key[b[new]])], names=["a", "b"])

    return units.mapInArrow(run, "a long, b long").distinct()


def verified(every: DataFrame, units: DataFrame) -> DataFrame:
    """The written links of units (unit, k1, root)."""
    units = common.written(units, "units")
    lines = every.where("line is not null").select("k1", "line")
    lines = common.restrict(lines, units.select("k1").distinct(), "k1").groupBy("k1").agg(F.min("line").alias("line"))
    rows = units.join(lines, "k1").select("unit", "k1", "root", "line")
    links = common.written(links_of(rows.repartition("unit").sortWithinPartitions("unit", "k1")), "links")
    common.drop(units)
    return links


def fuzzy(every: DataFrame) -> DataFrame:
    """(id, root) of the lines, by k1, that are similar to others. every: split(docs), written."""
    bits = common.range_bits(every.where("bands is not null").count() * BANDS)
    blocks = common.written(buckets(every, bits), "buckets")
    sizes = blocks.groupBy("bucket").agg(F.count("*").alias("blocks"), F.min(F.array_min("members")).alias("least"))
    large = common.written(sizes.where("blocks > 1"), "large")
    every_block = blocks.join(large, "bucket", "left").select(F.when(F.col("least").isNull(), F.col("members")).otherwise(F.array_union(F.array("least"), "members")).alias("members"))
    units = every_block.select(F.xxhash64("members").alias("unit"), "members").groupBy("unit").agg(F.first("members").alias("members"))
    links = verified(every, units.select("unit", F.explode("members").alias("k1")).select("unit", "k1", F.col("k1").alias("root")))
    roots = common.components(links)
    if large.isEmpty():
        common.drop(blocks, large, links)
        return roots
    # large buckets whose lines are not all connected: blocks outside their largest component with one another and with those inside
    roots, found = common.written(roots, "roots"), roots
    common.drop(found)
    rest = blocks.join(large.select("bucket"), "bucket", "left_semi").select("bucket", F.explode("members").alias("k1")).distinct()
    rest = rest.join(roots.withColumnRenamed("id", "k1"), "k1", "left").select("bucket", "k1", F.coalesce("root", "k1").alias("root"))
    rest = common.written(rest, "rest")
    common.drop(blocks, large)
    by_root = rest.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    of = by_root.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n")).where("n > top.n")
    of = of.select("bucket", F.col("top.root").alias("most"), F.ceil(F.col("top.n") / BLOCK).cast("int").alias("inside"), F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("outside"))
    rows = rest.join(of, "bucket").withColumn("own", F.col("root") == F.col("most"))
    block = F.pmod(F.xxhash64("k1"), F.when(F.col("own"), F.col("inside")).otherwise(F.col("outside"))).cast("int")
    upto = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    rows = rows.withColumn("block", block)
    across = rows.select("*", F.explode(F.when(F.col("own"), upto("outside")).otherwise(upto("inside"))).alias("other"))
    across = across.select(F.when(F.col("own"), F.xxhash64("bucket", "block", "other", F.lit("across"))).otherwise(F.xxhash64("bucket", "other", "block", F.lit("across"))).alias("unit"), "k1", "root")
    apart = rows.where("not own").select("*", F.explode(upto("outside")).alias("other"))
    apart = apart.select(F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "k1", "root")
    more = verified(every, across.unionByName(apart))
    common.drop(rest)
    out = roots
    if not more.isEmpty():
        out = common.components(links.unionByName(more))
        common.drop(roots)
    common.drop(links, more)
    return out


def kept_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each document with lines: id, row (hash of its text), n_lines, kept (line numbers from 0, in order); written."""
    common.ready(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    every = common.written(split(rows), "split")
    roots = fuzzy(every)
    one = every.groupBy("k1", "k2").agg(F.min(F.struct("id", "row", "nth")).alias("first"))
    one = one.join(roots.withColumnRenamed("id", "k1"), "k1", "left")
    single = F.when(F.col("root").isNull(), F.col("k2"))  # lines without links are told apart by both halves
    keep = one.groupBy(F.coalesce("root", "k1").alias("c"), single.alias("c2")).agg(F.min("first").alias("first")).select("first.*")
    keep = keep.groupBy("id", "row").agg(F.array_sort(F.collect_set("nth")).alias("kept"))
    counts = every.where("n is not null").select("id", "row", F.col("n").cast("long").alias("n_lines")).distinct()
    same = counts["id"].eqNullSafe(keep["id"]) & (counts["row"] == keep["row"])
    out = counts.join(keep, same, "left").select(counts["id"], counts["row"], "n_lines", F.coalesce("kept", F.array().cast("array<int>")).alias("kept"))
    out = common.written(out, "kept")
    common.drop(every)
    return out


def deduplicated(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, n_chars and any other columns) without the lines that repeat others; documents left without a line go."""
    kept = kept_lines(docs).select(F.col("id").alias("__id"), F.col("row").alias("__row"), F.when(F.size("kept") < F.col("n_lines"), F.col("kept")).alias("__kept"), (F.size("kept") > 0).alias("__some"))

    def number(batches):
        for b in batches:
            rows = [None if not t else int.from_bytes(common.digest(t.encode("utf-8", "replace"))[:8], "little", signed=True) for t in b.column("text").to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(rows, pa.int64())], names=[*b.schema.names, "__row"])

    def rebuild(batches):
        for b in batches:
            out = []
            for text, keep in zip(b.column("text").to_pylist(), b.column("__kept").to_pylist(), strict=True):
                if keep is not None:
                    stay = set(keep)
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i in stay or not normal(x))
                out.append(text)
            at = b.schema.get_field_index("text")
            yield b.set_column(at, "text", pa.array(out, pa.string())).drop_columns(["__kept"])

    marked = docs.mapInArrow(number, T.StructType([*docs.schema.fields, T.StructField("__row", T.LongType())]))
    same = marked["doc_id"].eqNullSafe(kept["__id"]) & (marked["__row"] == kept["__row"])
    rows = marked.join(kept, same, "left").where("coalesce(__some, true)").select(*[marked[c] for c in docs.columns], "__kept")
    out = rows.mapInArrow(rebuild, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    kept = kept_lines(docs)
    ids = docs.select("doc_id").distinct()
    per = kept.groupBy("id").agg(F.sum("n_lines").alias("n_lines"), F.sum(F.size("kept")).alias("n_kept"), F.array_sort(F.flatten(F.collect_list("kept"))).alias("kept_lines"))
    out = ids.join(per, ids["doc_id"].eqNullSafe(per["id"]), "left")
    return out.select("doc_id", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.coalesce("n_kept", F.lit(0)).cast("long").alias("n_kept"), F.coalesce("kept_lines", F.array().cast("array<int>")).alias("kept_lines"))

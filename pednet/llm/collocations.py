"""Phrase collocations by direct-address tiling: frequent phrases of growing length, ranked anew at every length.

Texts are lower-cased (A-Z), cut into pieces at marks and line ends, and pieces into words at blanks. Everything is counted per language: a
symbol of the first level is a word of a language. Symbols of LEAST or more occurrences are ranked by frequency, the rank being their code; texts become sequences of
codes with breaks where a piece ends or a rarer symbol stands. A frequent phrase of k + 1 words is a pair of neighbouring symbols of level k (two phrases
that overlap in k - 1 words), so each level counts pairs of codes, and the frequent pairs, ranked again, are the symbols of the next.

Pairs are counted by tiles of TILE x TILE codes: those of a task's buffer that fill a tile to a certain density are counted by numpy's bincount at
the address of the pair, all others as sorted coordinates with counts. Counts of tasks are summed by Spark.

RANKS symbols of a level at most have ranks, which bounds what is collected and broadcast. Further frequent symbols are told from rare ones by a Bloom
filter of fixed size, and have a 62-bit hash as code; those that the filter lets through fall out by their counts. Hashes of words are checked: if a frequent
word shares its hash with any other word, another seed is taken. Unranked phrases of two words and more aren't checked (10^8 of them
would hold two alike with probability 0.001).

Edge cases: null text is empty; null lang is `und`; phrases never cross pieces or texts; repeated rows count each; without frequent words, or
on an empty table, there are no rows; ties of score and frequency go to the phrase that is first by UTF-8 bytes; other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pednet.llm import common, terms

LEAST = 100
LONGEST = 5
TOP = 2000
#: Symbols of a level that get ranks (12 bytes each in a broadcast).
RANKS = 1 << 20
#: Codes on each side of a tile, and the share of a tile's addresses from which its pairs are counted densely.
TILE = 512
DENSE = 1 / 16
#: Pairs that a task counts at once, and distinct words that it holds.
HELD = 1 << 20
WORDS = 1 << 19
#: Rows that a task hands over at once.
ROWS = 1 << 16
#: Codes from here on are hashes.
HASHED = 1 << 62
BITS = 1 << 25

STOP = terms.gaps(".,;:!?\n\x0b\x0c\r")
GAP = STOP | terms.gaps(" \t")


# --- words ---------------------------------------------------------------------------------------------------


def symbols(b: pa.RecordBatch, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of lang and text: the bytes in lower case; start, end, document and key of each word; whether it follows its predecessor."""
    data, off = common.utf8(b.column("text"))
    start, end, h, doc = terms.split(data, off, GAP, seed)
    lang = b.column("lang").dictionary_encode()
    name = np.array([int.from_bytes(common.digest(x.encode())[:8], "little") for x in lang.dictionary.to_pylist()], np.uint64)
    with np.errstate(over="ignore"):
        h = common.mix(h + name[lang.indices.to_numpy()][doc] * np.uint64(3))
    stops = np.cumsum(STOP[data]) if len(data) else np.zeros(0, np.int64)
    joined = np.zeros(len(start), bool)
    joined[1:] = (doc[1:] == doc[:-1]) & (stops[start[1:]] == stops[start[:-1]])
    lower = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    return lower, start, end, doc, (h >> np.uint64(2)).astype(np.int64) | HASHED, joined


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    off = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(start - off[:-1], size) + np.arange(off[-1])
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(data[at].tobytes())])


def count_words(rows: DataFrame, least: int, seed: int) -> DataFrame:
    """settled() words of lang and text, written."""
    most = WORDS

    def count(batches):
        key, n, names = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def out():
            order = np.argsort(np.concatenate([x[0] for x in names]), kind="stable")
            lang, word = (pa.concat_arrays([x[i] for x in names]).take(pa.array(order)) for i in (1, 2))
            return pa.record_batch([pa.array(key), lang, word.cast(pa.string()), pa.array(n)], names=["p", "lang", "word", "n"])

        for batch in batches:
            for b in common.slices(batch):
                data, start, end, doc, p, _ = symbols(b, seed)
                if not len(p):
                    continue
                u, first, times = np.unique(p, return_index=True, return_counts=True)
                fresh = np.flatnonzero(~np.isin(u, key, assume_unique=True))
                at = first[fresh]
                names.append((u[fresh], b.column("lang").take(pa.array(doc[at])), strings(data, start[at], end[at])))
                both = np.concatenate([key, u[fresh]])
                order = np.argsort(both, kind="stable")
                key, n = both[order], np.concatenate([n, np.zeros(len(fresh), np.int64)])[order]
                n[np.searchsorted(key, u)] += times
                if len(key) > most:
                    yield out()
                    key, n, names = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        if len(key):
            yield out()

    return common.written(settled(rows.mapInArrow(count, "p long, lang string, word string, n long"), least), "words")


def settled(counts: DataFrame, least: int) -> DataFrame:
    """p, lang, word, words, n of the frequent words (words: how many words share p), and a row a language with null p for all others."""
    each = counts.repartition("p").groupBy("p", "lang", "word").agg(F.sum("n").alias("n"))
    each = each.groupBy("p").agg(F.count("*").alias("words"), F.sum("n").alias("n"), F.first("lang").alias("lang"), F.first("word").alias("word"), F.collect_list(F.struct("lang", "n")).alias("all"))
    rare = F.transform("all", lambda x: F.struct(F.lit(None).cast("long").alias("p"), x["lang"].alias("lang"), F.lit(None).cast("string").alias("word"), x["n"].alias("n"), F.lit(1).cast("long").alias("words")))
    parts = F.when(F.col("n") >= least, F.array(F.struct("p", "lang", "word", "n", "words"))).otherwise(rare)  # rare words of one p count each to its language
    return each.select(F.inline(parts)).groupBy("p", "lang", "word", "words").agg(F.sum("n").alias("n"))


# --- codes ---------------------------------------------------------------------------------------------------


def pair_keys(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """What stands for a pair of codes: both, if they are ranks, else a hash."""
    with np.errstate(over="ignore"):
        hashed = common.mix(common.mix(x.view(np.uint64)) + y.view(np.uint64)) >> np.uint64(2)
        exact = (x << 32) | y
    return np.where((x < HASHED) & (y < HASHED), exact, hashed.astype(np.int64) | HASHED)


def bits_of(p: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.stack([(common.mix(p.view(np.uint64) + np.uint64(i + 1)) % np.uint64(BITS)).astype(np.int64) for i in range(3)])


class Ranks:
    """Codes of a level's symbols: their ranks by frequency, or hashes beyond RANKS; rare symbols have -1."""

    def __init__(self, keys: np.ndarray, rank: np.ndarray, bits: np.ndarray | None):
        self.keys, self.rank, self.bits = keys, rank, bits

    @classmethod
    def of(cls, frequent: DataFrame, columns: list[str]) -> tuple[Ranks, int]:
        """frequent: n and the columns that make a symbol's key (p, or x and y); and how many there are."""
        total = frequent.count()
        top = frequent.select("n", *columns)
        if total > RANKS:
            top = top.orderBy(F.desc("n"), *columns).limit(RANKS)
        got = top.toArrow()  # RANKS rows at most
        n, *cols = (got[c].to_numpy() for c in ("n", *columns))
        key = cols[0] if len(cols) == 1 else pair_keys(*cols)
        rank = np.empty(len(key), np.int64)
        rank[np.lexsort((*cols[::-1], -n))] = np.arange(len(key))
        order = np.argsort(key)
        bits = None
        if total > RANKS:

            def places(batches):
                for b in batches:
                    p = b.column(0).to_numpy() if len(columns) == 1 else pair_keys(b.column(0).to_numpy(), b.column(1).to_numpy())
                    at = np.unique(bits_of(p))
                    yield pa.record_batch([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["w", "m"])

            words = frequent.select(*columns).mapInArrow(places, "w long, m long").groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()  # the filter: 4 MB
            bits = np.zeros(BITS >> 6, np.uint64)
            bits[words["w"].to_numpy()] = words["m"].to_numpy().view(np.uint64)
        return cls(key[order], rank[order], bits), total

    def codes(self, p: np.ndarray) -> np.ndarray:
        out = np.full(len(p), -1, np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, p), len(self.keys) - 1)
            out = np.where(self.keys[at] == p, self.rank[at], out)
        if self.bits is not None:
            rest = np.flatnonzero(out < 0)
            one = bits_of(p[rest])
            rest = rest[((self.bits[one >> 6] >> (one & 63).astype(np.uint64)) & np.uint64(1)).all(0)]
            q = p[rest]
            out[rest] = np.where(q >= HASHED, q, (common.mix(q.view(np.uint64)) >> np.uint64(2)).astype(np.int64) | HASHED)
        return out


def packed(codes: np.ndarray, joined: np.ndarray) -> bytes:
    """A sequence of codes with -1 at breaks, no two of them together. joined: whether a symbol follows its predecessor."""
    broken = np.flatnonzero(~joined)
    codes = np.insert(codes, broken, -1)
    keep = codes >= 0
    keep[1:] |= codes[:-1] >= 0
    return codes[keep].astype("<i8" if len(codes) and codes.max() >= HASHED else "<i4").tobytes()


def unpacked(row: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(row, "<i8" if wide else "<i4").astype(np.int64)


def sequence_rows(rows: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    got = [packed(*x) for x in rows]
    return pa.record_batch([pa.array([bool(len(c)) and bool(c.max() >= HASHED) for c, _ in rows]), pa.array(got, pa.binary())], names=["wide", "codes"])


SEQUENCES = "wide boolean, codes binary"


def encode(rows: DataFrame, ranks: Ranks, seed: int) -> DataFrame:
    """The written sequences of the first level; a row holds those of some documents."""
    sent = rows.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        for batch in batches:
            for b in common.slices(batch):
                *_, p, joined = symbols(b, seed)
                yield sequence_rows([(sent.value.codes(p), joined)])

    return common.written(rows.mapInArrow(run, SEQUENCES), "sequences")


def deepen(sequences: DataFrame, ranks: Ranks) -> DataFrame:
    """The written sequences of the next level."""
    sent = sequences.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        for b in batches:
            for wide, row in zip(b.column("wide").to_pylist(), b.column("codes").to_pylist(), strict=True):
                c = unpacked(row, wide)
                x, y = c[:-1], c[1:]
                both = (x >= 0) & (y >= 0)
                out = np.full(len(x), -1, np.int64)
                out[both] = sent.value.codes(pair_keys(x[both], y[both]))
                yield sequence_rows([(out, np.ones(len(out), bool))])

    return common.written(sequences.mapInArrow(run, SEQUENCES), "sequences")


# --- pairs ---------------------------------------------------------------------------------------------------


def tiles(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of codes with their counts."""
    out = []
    ranked = (x < HASHED) & (y < HASHED)
    rx, ry = x[ranked], y[ranked]
    tile = (rx // TILE << 32) | (ry // TILE)
    order = np.argsort(tile, kind="stable")
    edge = np.concatenate([[0], np.flatnonzero(np.diff(tile[order])) + 1, [len(order)]])
    full = np.flatnonzero(np.diff(edge) >= DENSE * TILE * TILE)
    sparse = np.ones(len(order), bool)
    for i in full.tolist():
        part = order[edge[i] : edge[i + 1]]
        sparse[part] = False
        address = (rx[part] % TILE) * TILE + ry[part] % TILE
        n = np.bincount(address, minlength=TILE * TILE)
        at = np.flatnonzero(n)
        out.append((rx[part[0]] // TILE * TILE + at // TILE, ry[part[0]] // TILE * TILE + at % TILE, n[at]))
    key, n = np.unique((rx[sparse] << 32) | ry[sparse], return_counts=True)
    out.append((key >> 32, key & 0xFFFFFFFF, n))
    if not ranked.all():
        hx, hy = x[~ranked], y[~ranked]
        order = np.lexsort((hy, hx))
        hx, hy = hx[order], hy[order]
        new = np.flatnonzero(np.concatenate([[True], (hx[1:] != hx[:-1]) | (hy[1:] != hy[:-1])]))
        out.append((hx[new], hy[new], np.diff(np.append(new, len(hx)))))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def count_pairs(sequences: DataFrame, least: int) -> DataFrame:
    """x, y, n of the frequent pairs of neighbouring codes, written."""
    most = HELD

    def count(batches):
        held, size = [], 0
        for b in batches:
            for wide, row in zip(b.column("wide").to_pylist(), b.column("codes").to_pylist(), strict=True):
                c = unpacked(row, wide)
                both = (c[:-1] >= 0) & (c[1:] >= 0)
                held.append((c[:-1][both], c[1:][both]))
                size += len(held[-1][0])
                if size >= most:
                    yield from emit(held)
                    held, size = [], 0
        if size:
            yield from emit(held)

    def emit(held):
        cols = tiles(*(np.concatenate(c) for c in zip(*held, strict=True)))
        for at in range(0, len(cols[0]), ROWS):
            yield pa.record_batch([pa.array(c[at : at + ROWS].astype(np.int64)) for c in cols], names=["x", "y", "n"])

    each = sequences.mapInArrow(count, "x long, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("n"))
    return common.written(each.where(F.col("n") >= least), "pairs")


# --- phrases -------------------------------------------------------------------------------------------------


def coded(frequent: DataFrame, ranks: Ranks, columns: list[str]) -> DataFrame:
    """frequent with each symbol's code."""
    sent = frequent.sparkSession.sparkContext.broadcast(ranks)
    names = frequent.columns

    def run(batches):
        for b in batches:
            cols = [b.column(c).to_numpy() for c in columns]
            p = cols[0] if len(cols) == 1 else pair_keys(*cols)
            yield pa.record_batch([*b.columns, pa.array(sent.value.codes(p))], names=[*names, "code"])

    return frequent.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in frequent.dtypes) + ", code long")


def scores(candidates: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of each candidate: that of its lowest cut, the shortest first part among equal ones. Whole numbers without a limit."""

    def run(batches):
        for b in batches:
            out = []
            for a, n, pre, suf in zip(*(b.column(c).to_pylist() for c in ("a", "n", "pre", "suf")), strict=True):
                out.append(min((1000 * a * n // (left * right), k, left, right) for k, (left, right) in enumerate(zip(pre, suf[::-1], strict=True))))
            score, _, left, right = (pa.array(c, pa.int64()) for c in zip(*out, strict=True)) if out else (pa.array([], pa.int64()),) * 4
            yield pa.record_batch([b.column("lang"), b.column("phrase"), b.column("a"), left, right, b.column("n"), score], names=["lang", "phrase", "a", "l", "r", "n", "score"])

    return candidates.mapInArrow(run, "lang string, phrase string, a long, l long, r long, n long, score long")


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases of 2 to longest words with least occurrences or more that no longer one stands for."""
    spark = common.ready(docs.sparkSession)
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    for seed in range(8):
        words = count_words(rows, least, seed)
        if words.where("words > 1").isEmpty():
            break
        common.drop(words)
    else:
        raise RuntimeError("hashes of frequent words collide under every seed")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where("p is not null")
    ranks, found = Ranks.of(frequent, ["p"])
    level = coded(frequent.select("p", "lang", "word", "n"), ranks, ["p"])
    empty = F.array().cast("array<long>")
    levels = [common.written(level.select("code", "n", "lang", F.array("word").alias("words"), empty.alias("pre"), empty.alias("suf")), "symbols")]
    sequences = encode(rows, ranks, seed) if found else None
    pairs = []
    for k in range(2, longest + 1):
        if not found:
            break
        counted = count_pairs(sequences, least)
        ranks, found = Ranks.of(counted, ["x", "y"])
        pairs.append(counted)
        if not found:
            break
        last = levels[-1]
        first = last.select(F.col("code").alias("x"), F.col("n").alias("nx"), "lang", F.col("words").alias("front"), F.col("pre").alias("px"))
        second = last.select(F.col("code").alias("y"), F.col("n").alias("ny"), F.element_at("words", -1).alias("end"), F.col("suf").alias("sy"))
        grown = coded(counted, ranks, ["x", "y"]).join(first, "x").join(second, "y")
        grown = grown.select("code", "n", "lang", F.concat("front", F.array("end")).alias("words"), F.concat("px", F.array("nx")).alias("pre"), F.concat("sy", F.array("ny")).alias("suf"))
        levels.append(common.written(grown, "symbols"))
        if k < longest:
            sequences, old = deepen(sequences, ranks), sequences
            common.drop(old)
    if sequences is not None:
        common.drop(sequences)
    out = None
    for i, level in enumerate(levels[1:]):  # an occurrence of a longer phrase is one of each part: equal counts mean that it always stands there
        level = level.withColumnRenamed("n", "a")
        if i + 2 < len(levels):
            longer = pairs[i + 1]
            inside = longer.select(F.col("x").alias("code"), "n").unionByName(longer.select(F.col("y").alias("code"), "n")).groupBy("code").agg(F.max("n").alias("most"))
            level = level.join(inside, "code", "left").where("most is null or most < a")
        level = level.select("lang", F.array_join("words", " ").alias("phrase"), "a", "pre", "suf")
        out = level if out is None else out.unionByName(level)
    if out is None:
        return spark.createDataFrame([], "lang string, phrase string, a long, l long, r long, n long, score long")
    return scores(out.join(totals, "lang"))


def best(found: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first phrases by score, occurrences and bytes, with their rank from 1."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return best(phrases(common.documents(spark, sf_dir)))

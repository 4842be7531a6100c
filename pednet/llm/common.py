"""What the operators share: shared folders, written tables, Bloom filters, components, word kernels."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Bits of the Bloom filters that are broadcast (4 MB). A fuller filter lets more rows through; results stay the same.
BLOOM_BITS = 1 << 25
#: Text that the numpy kernels take at once.
SLICE_BYTES = 1 << 19

MASK = (1 << 64) - 1


# --- shared folder -------------------------------------------------------------------------------------------


#: Rows of an Arrow batch: with long texts, the default of 10,000 is hundreds of MB in a worker. Rows of texts or sets may be long too, and a batch is held by Spark
#: and by the worker, so its bytes are bounded as well.
BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, also when it runs from a source folder, and bound their batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    # workers give what they free back to the system, but for arrays as large as those of a slice of text, which would be mapped anew each time
    env.setdefault("MALLOC_MMAP_THRESHOLD_", str(12 * SLICE_BYTES))
    env.setdefault("MALLOC_TRIM_THRESHOLD_", str(32 * SLICE_BYTES))
    # one heap a worker, and no pool of Arrow's own beside it, which keeps what is freed
    env.setdefault("MALLOC_ARENA_MAX", "1")
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir. Where it is unset, a temporary folder if all runs on this machine, else an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage and survives lost executors."""
    spark = ready(df.sparkSession)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Empty tables that written() made and nothing reads any more, and let Spark delete the shuffle files of finished steps (it does when the
    driver collects garbage)."""
    for df in tables:
        path = os.path.dirname(df.inputFiles()[0])
        df.sparkSession.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(path)
    freed(tables[0].sparkSession)


def freed(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/documents.parquet")


def bloom(df: DataFrame, column: str, bits: int = BLOOM_BITS) -> np.ndarray:
    """A Bloom filter of a long column as 64-bit words; what reaches the driver is bits / 8 bytes at most."""
    parts = [F.pmod(F.xxhash64(F.col(column), F.lit(i)), F.lit(bits)) for i in range(3)]
    rows = (
        df.select(F.explode(F.array(*parts)).alias("p"))
        .groupBy(F.shiftright("p", 6).cast("int").alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("m"))
        .toArrow()
    )
    out = np.zeros(bits >> 6, dtype=np.uint64)
    out[rows["w"].to_numpy()] = rows["m"].to_numpy().view(np.uint64)
    return out


def bloom_test(df: DataFrame, column: str, words: np.ndarray, schema_column: str = "maybe") -> DataFrame:
    """Rows whose long column may be in the filter; the three positions are computed by Spark, the bits looked up in numpy."""
    spark = df.sparkSession
    sent, bits = spark.sparkContext.broadcast(words), len(words) << 6

    @F.pandas_udf("boolean")
    def hit(a, b, c):
        import pandas as pd

        w, out = sent.value, None
        for x in (a, b, c):
            x = x.to_numpy().astype(np.int64)
            one = (w[x >> 6] >> (x & 63).astype(np.uint64)) & np.uint64(1)
            out = one if out is None else out & one
        return pd.Series(out.astype(bool))

    return df.where(hit(*[F.pmod(F.xxhash64(F.col(column), F.lit(i)), F.lit(bits)) for i in range(3)]))


# --- connected components ------------------------------------------------------------------------------------


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Distributed union-find: (a, b) links to (id, root), root being the smallest id of the component.

    Alternates large-star and small-star steps (Kiveris et al. 2014). Each round is a shuffle over the links with map-side combine,
    written to the shared folder; it ends when no row changes. Ids without links do not appear.
    """
    def put(df: DataFrame) -> tuple[DataFrame, dict]:
        """df written, and a digest of its rows, taken while it is written."""
        seen = Observation()
        out = written(df.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.bit_xor(F.xxhash64("b", "a")).alias("y")), "links")
        return out, seen.get

    edges, had = put(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(rounds):
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: every larger neighbour of a points to the smallest neighbour of a
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.unionByName(low.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        # small star: every smaller neighbour of a, and a, point to the smallest of them
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(low2.select("a", F.col("m").alias("b"))).distinct()
        before, (edges, has) = edges, put(small)
        drop(before)
        if has == had:
            break
        had = has
    else:
        raise RuntimeError("components: not converged")
    roots = edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())


# --- word kernels --------------------------------------------------------------------------------------------


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


#: Bytes of 0x20 and 0x09 to 0x0D part words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_EXACT = _table(7)
_LOWER = _EXACT.copy()
_LOWER[65:91] = _EXACT[97:123]
_EXACT[SPACE] = _LOWER[SPACE] = 0
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            have = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base & MASK, np.uint64)]), dtype=np.uint64)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (Stafford's variant 13)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES):
    """Parts of a batch with limited text each."""
    text = batch.column(column)
    if len(text) == 0:
        return
    size = np.concatenate([[0], np.cumsum(np.nan_to_num(pa.compute.binary_length(text).to_numpy(zero_copy_only=False).astype(float)))])
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, size[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def utf8(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array (null: empty) and the documents' offsets."""
    text = pa.compute.fill_null(text, "").cast(pa.large_string())
    text = pa.concat_arrays([text])
    _, off, data = text.buffers()
    off = np.frombuffer(off, np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def words(data: np.ndarray, off: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each word, and for each document where its words begin (one more at the end)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    word = ~SPACE[data]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    before[edge], after[edge - 1] = False, False
    start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    if len(start) == 0:
        return start, end, np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    with np.errstate(over="ignore"):
        val = (_LOWER if lower else _EXACT)[data] * powers(_P, len(data))
        h = np.add.reduceat(val, start) * powers(_PINV, len(data))[start] + (end - start).astype(np.uint64)
    return start, end, mix(h), np.searchsorted(start, off)


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows of one document; with fewer words, of the whole sequence; none without words."""
    if len(h) == 0:
        return h
    k = min(k, len(h))
    with np.errstate(over="ignore"):
        out = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            out = mix(out + h[i : len(h) - k + 1 + i] + np.uint64(0x9E3779B97F4A7C15))
    return out


def digest(b: bytes) -> bytes:
    """16 bytes that stand for a text or a set."""
    import xxhash

    return xxhash.xxh3_128_digest(b)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# --- choosing rows -------------------------------------------------------------------------------------------

#: Ids are broadcast up to so many rows (8 bytes each); beyond, a Bloom filter of fixed size and a shuffled join do the same.
BROADCAST_IDS = 500_000


def restrict(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """rows whose long column is among ids (one column of the same name, distinct)."""
    if ids.count() <= BROADCAST_IDS:
        return rows.join(F.broadcast(ids), column, "left_semi")
    return bloom_test(rows, column, bloom(ids, column)).join(ids, column, "left_semi")


def about(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """rows whose long column is among ids; beyond BROADCAST_IDS, a Bloom filter lets some others through, and no row is shuffled."""
    if ids.count() <= BROADCAST_IDS:
        return rows.join(F.broadcast(ids), column, "left_semi")
    return bloom_test(rows, column, bloom(ids, column))


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list array of long or binary-free numbers from arrays."""
    off = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64), kind))


class Sets:
    """A small union-find over positions, inside a task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        self.up[self.find(x)] = self.find(y)


def groups_of(batches, key: str):
    """Runs of rows with one key, as one batch each; rows come sorted by it. Only a run is held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        if held and held[-1].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def whole_groups(batches, key: str):
    """Tables of whole runs of rows with one key, and where each run begins (with the end); rows come sorted by it. What is held is a batch
    and the last run before it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(keys != keys[-1])
        cut = int(at[-1]) + 1 if len(at) else 0  # the last run may go on
        if cut == 0 and (len(held) == 1 or held[-2].column(key)[-1].as_py() == keys[-1]):
            continue
        held[-1] = batch.slice(0, cut)
        yield _runs(pa.Table.from_batches(held), key)
        held = [batch.slice(cut)]
    if held:
        yield _runs(pa.Table.from_batches(held), key)


def _runs(t: pa.Table, key: str) -> tuple[pa.Table, list[int]]:
    keys = t.column(key).to_numpy()
    return t, [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]


# --- keys that several owners have ---------------------------------------------------------------------------

#: Keys that a task packs at once, that a hash range has on average, and that a task holds of a range.
PACK = 1 << 19
RANGE = 1 << 15
HELD = 1 << 19
#: A key that so many of PACK are is dealt to SALTS rows.
HOT = 128
SALTS = 32


def range_bits(keys: int) -> int:
    """How many leading bits of a 64-bit key make its hash range, for so many keys."""
    return min(31, max(0, keys // RANGE).bit_length())


def short(key: np.ndarray, bits: int) -> np.ndarray:
    """What meet() tells keys apart by: the range and the 32 bits below it."""
    return key >> np.uint64(32 - bits)


def pack(df: DataFrame, bits: int, places: bool = False) -> DataFrame:
    """Rows of many keys, to be brought together by unit (hash range and salt): keys (32 bits), owners and perhaps places. df: owner long, keys
    binary (64 bits each) and perhaps places binary (32 bits each). A key that a task meets often goes to SALTS units by owner, and
    a mark (place -1) to the unit where those of other tasks go, so that these aren't taken to be alone."""

    def rows(key, owner, place):
        order = np.argsort(key)
        key, owner, place = key[order], owner[order], place[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        times = np.diff(np.append(new, len(key)))
        often, one = np.repeat(times > HOT, times), new[times > HOT]
        unit = (short(key, bits) >> np.uint64(32)).astype(np.int64) * (SALTS + 1)
        unit[often] += 1 + (mix(owner[often].view(np.uint64)) % np.uint64(SALTS)).astype(np.int64)
        if len(one):
            unit = np.append(unit, unit[one] // (SALTS + 1) * (SALTS + 1))
            order = np.argsort(unit, kind="stable")
            unit, key, owner, place = unit[order], np.append(key, key[one])[order], np.append(owner, owner[one])[order], np.append(place, np.full(len(one), -1, np.int32))[order]
        cut = np.concatenate([[0], np.flatnonzero(unit[1:] != unit[:-1]) + 1, [len(unit)]]).tolist()
        parts = [(short(key, bits) & np.uint64(0xFFFFFFFF)).astype(np.uint32), owner, *([place] if places else [])]
        cols = [pa.array([x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for x in parts]
        return pa.record_batch([pa.array(unit[cut[:-1]]), *cols], names=["unit", "keys", "owners", "places"][: 1 + len(cols)])

    def run(batches):
        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            each = b.column("keys").to_pylist()
            key = np.frombuffer(b"".join(each), np.uint64)
            place = np.frombuffer(b"".join(b.column("places").to_pylist()), np.int32) if places else np.zeros(len(key), np.int32)
            held.append((key, np.repeat(b.column("owner").to_numpy(), [len(x) // 8 for x in each]), place))
            size += len(key)
            if size >= PACK:
                yield rows(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, size = [], 0
        if size:
            yield rows(*(np.concatenate(x) for x in zip(*held, strict=True)))

    schema = "unit long, keys binary, owners binary" + ", places binary" * places
    return df.mapInArrow(run, schema).repartition("unit").sortWithinPartitions("unit")


def meet(packed: DataFrame, emit, schema: str, places: bool = False) -> DataFrame:
    """What emit makes of keys that several owners have, or may have (keys met often): it gets such a range's keys (64 bits, as of short()), owners
    and places, sorted by these three, each entry once. A key of many owners may come in several parts. A task holds HELD entries."""

    def run(batches):
        unit, held, size, before = None, [], 0, np.zeros(0, np.uint32)

        def close(last: bool):
            nonlocal held, size, before
            key, owner, place = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(key)
            new = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
            times = np.diff(np.append(new, len(key)))
            maybe = np.repeat((times > 1) | np.isin(key[order[new]], before) | (unit % (SALTS + 1) > 0), times)
            alone, some = order[~maybe], order[maybe]
            some = some[np.lexsort((place[some], owner[some], key[some]))]
            k, o, p = key[some], owner[some], place[some]
            apart = np.append(True, k[1:] != k[:-1])[: len(k)]
            owners = apart | np.append(True, o[1:] != o[:-1])[: len(k)]
            once = owners | np.append(True, p[1:] != p[:-1])[: len(k)]
            run_of = np.cumsum(apart) - 1
            many = np.bincount(run_of, owners) > 1
            many |= np.bincount(run_of, p < 0) > 0
            many |= np.isin(k[apart], before) | (unit % (SALTS + 1) > 0)
            use = many[run_of] & once
            before = np.zeros(0, np.uint32) if last else np.concatenate([before, k[apart][many]])
            alone = np.concatenate([alone, some[~many[run_of]]])
            held = [] if last else [(key[alone], owner[alone], place[alone])]
            size = 0 if last else len(alone)
            if use.any():
                yield emit(np.uint64(unit // (SALTS + 1)) << np.uint64(32) | k[use].astype(np.uint64), o[use], p[use])

        for b in batches:
            cols = [b.column(c).to_pylist() for c in b.schema.names]
            for u, *parts in zip(*cols, strict=True):
                if held and (u != unit or size > HELD):
                    yield from close(u != unit)
                unit = u
                key = np.frombuffer(parts[0], np.uint32)
                held.append((key, np.frombuffer(parts[1], np.int64), np.frombuffer(parts[2], np.int32) if places else np.zeros(len(key), np.int32)))
                size += len(key)
        if held:
            yield from close(True)

    return packed.mapInArrow(run, schema)

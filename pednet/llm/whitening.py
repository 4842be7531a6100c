"""Whitening of embeddings by spectrum slicing.

Components of a vector become whole numbers x = floor(SCALE * c) + OFFSET. The fit list is each distinct x vector once. Three passes over it, each with
partial sums a task, give n and the sums S, the scatter matrix about the rounded mean (integers, so the order of tasks doesn't matter, and
the covariance is the exact one rounded once), and the covariance of the whitened vectors, whose distance from the identity is reported.

The covariance V (a row and a column a dimension) is solved on the driver. The signs of D in V - s I = L D Lᵀ (symmetric pivoting with blocks of one
and two) count the eigenvalues above s; halving intervals by these counts isolates each of the leading ones. Rayleigh quotient iteration then
converges cubically from the middle of its interval. The counts just below and above what it found certify that it is the k-th; if they
don't, the interval is halved further. Eigenvalues that no count can tell apart (closer than rounding) share an interval, and their
vectors are found one after another, orthogonal to those before.

What is broadcast: TOP vectors and one mean. The driver holds some matrices of dimension x dimension.
Edge cases: vectors that are null or hold a null or a non-finite component take no part; shorter vectors count as filled up with c = 0; rows
without an id are kept, with a null id; repeated rows are whitened each, but fitted once; directions without variance (within rounding)
have no component, so one distinct vector, or an empty table, gives no rows; numbers whose exact sums leave 64 bits are an error; columns
other than id and vector are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pednet.llm import common
from pednet.llm.vafile import matrix, product

SCALE = 64
OFFSET = 1_000_000
TOP = 16
#: Vectors that a task multiplies at once.
CHUNK = 4096
EPS = float(np.finfo(float).eps)
_ALPHA = (1 + 17**0.5) / 8

OUT = "{id} long, component int, n long, deviation long, whitened double, explained double"


# --- the spectrum of a symmetric matrix ----------------------------------------------------------------------


def inertia(a: np.ndarray) -> tuple[int, int]:
    """How many eigenvalues of a symmetric matrix are positive, and how many are negative, by the signs of D in its L D Lᵀ."""
    a = np.array(a, float)
    n, k, pos, neg = len(a), 0, 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        d = a[k, k]
        below = np.abs(a[k + 1 :, k])
        r = k + 1 + int(below.argmax()) if len(below) else k
        most = float(below.max()) if len(below) else 0.0
        two = False
        if most and abs(d) < _ALPHA * most:
            row = np.abs(a[r, k:])
            row[r - k] = 0
            other = float(row.max())
            if abs(d) * other < _ALPHA * most * most:
                if abs(a[r, r]) >= _ALPHA * other:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    two = True
        if two:  # such a block has one eigenvalue of each sign
            c = a[k + 2 :, k : k + 2].copy()
            a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(a[k : k + 2, k : k + 2], c.T)
            pos, neg, k = pos + 1, neg + 1, k + 2
            continue
        d = a[k, k]
        if d:
            c = a[k + 1 :, k].copy()
            a[k + 1 :, k + 1 :] -= np.outer(c / d, c)
        pos, neg, k = pos + (d > 0), neg + (d < 0), k + 1
    return int(pos), int(neg)


def leading(v: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, and their unit vectors (columns); at most top, and none without variance."""
    n, norm = len(v), float(np.abs(v).sum(1).max()) if len(v) else 0.0
    if not norm:
        return np.zeros(0), np.zeros((n, 0))
    fine = 4 * n * EPS * norm
    eye, counts = np.eye(n), {}

    def above(s: float) -> int:
        if s not in counts:
            counts[s] = inertia(v - s * eye)[0]
        return counts[s]

    top = min(top, above(fine))
    values, vectors = [], np.zeros((n, 0))
    while len(values) < top:
        k = len(values)  # the next one is the (k+1)-th
        known = sorted(counts)
        lo = max(s for s in known if counts[s] > k)
        hi = min([s for s in known if s > lo and counts[s] <= k], default=norm * (1 + 4 * EPS))
        while above(lo) - k > 1 and hi - lo > fine:  # until it is alone
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if above(mid) > k else (lo, mid)
        while True:
            members = above(lo) - k
            found, basis = [], vectors
            for _ in range(min(members, top - k)):
                e, x = _rayleigh(v, (lo + hi) / 2, basis)
                found.append(e)
                basis = np.column_stack([basis, x])
            slack = fine if members == 1 else 2 * (hi - lo) + fine
            if all(above(e - slack) >= k + members and above(e + slack) <= k for e in found):
                break
            if hi - lo <= fine:
                raise ArithmeticError("an eigenvalue could not be certified")
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if above(mid) > k else (lo, mid)
        order = np.argsort(found)[::-1]
        values += [found[i] for i in order]
        vectors = np.column_stack([vectors, basis[:, k:][:, order]])
    return np.array(values), vectors


def _rayleigh(v: np.ndarray, shift: float, known: np.ndarray, rounds: int = 60) -> tuple[float, np.ndarray]:
    """The eigenvalue near shift and its vector, orthogonal to known ones: two steps with the shift itself, then with Rayleigh quotients."""
    n = len(v)
    norm = float(np.abs(v).sum(1).max())

    def clear(x):
        for _ in range(2):
            x = x - known @ (known.T @ x)
        return x / np.linalg.norm(x)

    x = clear(np.random.default_rng(5).standard_normal(n))
    value, best = shift, (np.inf, shift, x)
    for i in range(rounds):
        if i >= 2:
            value = float(x @ v @ x)
            off = float(np.linalg.norm(v @ x - value * x))
            if off >= best[0] and best[0] <= 64 * n * EPS * norm:
                break
            if off < best[0]:
                best = (off, value, x)
        try:
            y = np.linalg.solve(v - value * np.eye(n), x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(v - (value + EPS * norm) * np.eye(n), x)
        x = clear(y)
    return best[1], best[2]


# --- passes --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    """n distinct vectors with sums S; falling eigenvalues with their vectors; the trace; centre (S / n, rounded) and what is left of the mean."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    centre: np.ndarray
    rest: np.ndarray
    kind: str = "<i8"

    @property
    def components(self) -> int:
        return len(self.values)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(float) - self.rest) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        d = x - self.centre
        off = np.array([s - self.n * int(c) for s, c in zip(self.sums, self.centre, strict=True)], np.int64)
        most = (self.n * int(np.abs(d).max(initial=0)) + int(np.abs(off).max(initial=0))) ** 2 * x.shape[1]
        if most < 2**63:
            return ((self.n * d - off) ** 2).sum(1)
        exact = [sum((self.n * int(a) - int(b)) ** 2 for a, b in zip(row, off, strict=True)) for row in d]
        return np.array(exact, np.int64)  # an OverflowError where it leaves 64 bits


def scaled(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """id, and x without OFFSET, of the rows that take part."""
    v = F.col(column)
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    x = F.transform(v, lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("long"))
    return vectors.where(v.isNotNull() & fine).select(F.col(id_column).cast("long").alias("id"), x.alias("x"))


def fit(rows: DataFrame) -> tuple[Fit, float, int]:
    """The model of scaled() rows, its identity error, and the vectors' dimension."""
    ends = rows.agg(F.max(F.size("x")).alias("dim"), F.min(F.array_min("x")).alias("lo"), F.max(F.array_max("x")).alias("hi")).first()
    dim = ends["dim"] or 0
    none = Fit(0, (0,) * dim, np.zeros(0), np.zeros((dim, 0)), 0.0, np.zeros(dim, np.int64), np.zeros(dim))
    if not dim:
        return none, 0.0, 0
    kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= min(ends["lo"], 0) and max(ends["hi"], 0) <= np.iinfo(k).max)

    def packed(batches):
        for b in batches:
            yield pa.record_batch([pa.array([r.tobytes() for r in matrix(b.column("x"), dim).astype(kind)], pa.binary())], names=["x"])

    table = common.written(rows.select("x").mapInArrow(packed, "x binary").distinct(), "vectors")

    def chunks(batches):
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                part = b.column("x").slice(at, CHUNK)
                yield np.frombuffer(b"".join(part.to_pylist()), kind).reshape(len(part), dim).astype(np.int64) + OFFSET

    def totals(batches):
        n, s = 0, np.zeros(dim, object)
        for x in chunks(batches):
            n, s = n + len(x), s + x.sum(0).astype(object)
        yield pa.record_batch([pa.array([n], pa.int64()), pa.array([[int(y) for y in s]], pa.list_(pa.int64()))], names=["n", "s"])

    parts = table.mapInArrow(totals, "n long, s array<long>").select("n", F.posexplode("s").alias("i", "s"))
    got = sorted(parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())  # a row a dimension
    n, sums = got[0]["n"], tuple(r["s"] for r in got)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    off = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]  # sums about the centre

    def scatter(batches):
        m = np.zeros((dim, dim), np.int64)
        for x in chunks(batches):
            d = (x - centre).T.copy()
            m += product(d, d)
        yield pa.record_batch([pa.array(np.arange(dim, dtype=np.int32)), pa.array([m[i, i:] for i in range(dim)], pa.list_(pa.int64()))], names=["i", "m"])

    cells = table.mapInArrow(scatter, "i int, m array<long>").select("i", F.posexplode("m").alias("j", "m")).groupBy("i", "j").agg(F.sum("m").alias("m")).toArrow()
    v = np.zeros((dim, dim))
    for i, j, m in zip(*(cells.column(c).to_pylist() for c in ("i", "j", "m")), strict=True):
        v[i, i + j] = v[i + j, i] = (n * m - off[i] * off[i + j]) / (n * n)  # whole numbers, rounded once
    values, vectors = leading(v)
    model = Fit(n, sums, values, vectors, float(np.trace(v)), centre, np.array([o / n for o in off]), kind)
    k = model.components
    if not k:
        common.drop(table)
        return model, 0.0, dim

    def second(batches):
        s, m = np.zeros(k), np.zeros((k, k))
        for x in chunks(batches):
            w = model.whiten(x)
            s, m = s + w.sum(0), m + w.T @ w
        yield pa.record_batch([pa.array(np.arange(k + 1, dtype=np.int32)), pa.array([s, *m], pa.list_(pa.float64()))], names=["i", "m"])

    exact = F.sum(F.col("m").cast("decimal(38,18)")).cast("double")  # whatever the order of tasks
    cells = table.mapInArrow(second, "i int, m array<double>").select("i", F.posexplode("m").alias("j", "m")).groupBy("i", "j").agg(exact.alias("m")).collect()
    m = np.zeros((k + 1, k))
    for r in cells:
        m[r["i"], r["j"]] = r["m"]
    mean = m[0] / n
    error = float(np.abs(m[1:] / n - np.outer(mean, mean) - np.eye(k)).max())
    common.drop(table)
    return model, error, dim


def whiten(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """A row for each vector and component: id, component from 1, n, deviation, whitened, explained, identity_error."""
    spark = common.ready(vectors.sparkSession)
    rows = scaled(vectors, id_column, column)
    model, error, dim = fit(rows)
    schema = OUT.format(id=f"`{id_column}`")
    if not model.components:
        return spark.createDataFrame([], schema + ", identity_error double")
    sent = spark.sparkContext.broadcast(model)

    def run(batches):
        f = sent.value
        k = f.components
        share = f.values / f.trace
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                b = batch.slice(at, CHUNK)
                x = matrix(b.column("x"), dim) + OFFSET
                each = b.column("id").take(pa.array(np.repeat(np.arange(len(x)), k)))
                yield pa.record_batch(
                    [each, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, f.n)), pa.array(np.repeat(f.deviation(x), k)), pa.array(f.whiten(x).ravel()), pa.array(np.tile(share, len(x)))],
                    names=[id_column, "component", "n", "deviation", "whitened", "explained"],
                )

    return rows.mapInArrow(run, schema).withColumn("identity_error", F.lit(error))


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(common.ready(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))

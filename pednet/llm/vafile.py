"""Exact top-k by a vector-approximation file (Weber et al. 1998), for integer inner products.

Each vector is kept twice: as whole numbers floor(SCALE * x), and as one cell of BITS bits a dimension. Cells of a dimension are of equal
width between its least and greatest value over all vectors. For a query, a cell bounds the score from below and above. A first scan reads cells only: the
k-th best lower bound within any part of the file bounds the k-th score of all from below. A second scan reads the exact vectors of those
rows whose upper bound reaches that, best bound first, until the k-th score found exceeds every bound left, which makes it certain.
Queries come in blocks of BLOCK, so what is sent to tasks has a fixed bound; every block scans the whole file.

Edge cases: vectors that are null or hold a null or a non-finite component, and rows without an id, take no part; shorter vectors count as
filled up with zeros; a query's own id is never its candidate; repeated rows are candidates each; ties go to the smaller id; with fewer
candidates than k, all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pednet.llm import common

SCALE = 1024
BITS = 6
BLOCK = 2048
TOP = 10
#: Rows of the file that a task scores at once.
CHUNK = 2048


def index(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The written file (id, cells, exact), and each dimension's least value and cell width."""
    v = F.col(column)
    whole = F.transform(v, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.col(id_column).isNotNull() & v.isNotNull() & fine).select(F.col(id_column).cast("long").alias("id"), whole.alias("v"))
    ends = rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("n")).collect()  # a row a dimension
    dim = len(ends)
    lo, hi = np.zeros(dim, np.int64), np.zeros(dim, np.int64)
    for r in ends:
        lo[r["d"]], hi[r["d"]] = r["lo"], r["hi"]
    lo, hi = np.minimum(lo, 0), np.maximum(hi, 0)  # zeros fill up short vectors
    width = (hi - lo) // (1 << BITS) + 1

    def cells(batches):
        for b in batches:
            x = matrix(b.column("v"), dim)
            raw = ((x - lo) // width).astype(np.uint8)
            pack = lambda m: pa.array([r.tobytes() for r in m], pa.binary())
            yield pa.record_batch([b.column("id"), pack(raw), pack(x)], names=["id", "cells", "exact"])

    return common.written(rows.mapInArrow(cells, "id long, cells binary, exact binary"), "cells"), lo, width


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    out = np.zeros((len(lists), dim), np.int64)
    size = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def rows_of(column: pa.Array, dtype, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), dim)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where these are exact, else in integers."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


class Query:
    """A block of queries with what turns cells into bounds."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, lo: np.ndarray, width: np.ndarray):
        self.ids, self.q, self.lo, self.width = ids, q, lo, width
        pos, neg = np.maximum(q, 0), np.minimum(q, 0)
        self.base = product(q, lo[None, :])[:, 0]
        self.more = product(pos, (width - 1)[None, :])[:, 0]  # above the score at a cell's low corner
        self.less = product(neg, (width - 1)[None, :])[:, 0]

    def bounds(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        corner = self.base[:, None] + product(self.q * self.width, cells.astype(np.int64))
        return corner + self.less[:, None], corner + self.more[:, None]


def search(file: DataFrame, lo: np.ndarray, width: np.ndarray, query_rows: list, k: int = TOP) -> DataFrame:
    """The k best of the whole file for each query of a block: query_id, rank, vec_id, score."""
    spark, dim = file.sparkSession, len(lo)
    ids, first = np.unique(np.array([r["id"] for r in query_rows], np.int64), return_index=True)
    q = np.stack([np.frombuffer(query_rows[i]["exact"], np.int64) for i in first])
    sent = spark.sparkContext.broadcast((ids, q))

    def thresholds(batches):
        block = Query(*sent.value, lo, width)
        best = np.full((len(block.ids), k), np.iinfo(np.int64).min)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                b = batch.slice(at, CHUNK)
                low, _ = block.bounds(rows_of(b.column("cells"), np.uint8, dim))
                low[block.ids[:, None] == b.column("id").to_numpy()[None, :]] = np.iinfo(np.int64).min
                best = -np.partition(-np.concatenate([best, low], 1), k - 1, 1)[:, :k]
        yield pa.record_batch([pa.array(np.arange(len(block.ids))), pa.array(best.min(1))], names=["n", "low"])

    low = np.full(len(ids), np.iinfo(np.int64).min)
    for r in file.select("id", "cells").mapInArrow(thresholds, "n long, low long").groupBy("n").agg(F.max("low").alias("low")).collect():  # BLOCK rows at most
        low[r["n"]] = r["low"]
    sent2 = spark.sparkContext.broadcast(low)

    def refine(batches):
        block, floor_ = Query(*sent.value, lo, width), sent2.value.copy()
        best = [np.zeros((0, 2), np.int64) for _ in block.ids]
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                b = batch.slice(at, CHUNK)
                rid = b.column("id").to_numpy()
                _, up = block.bounds(rows_of(b.column("cells"), np.uint8, dim))
                up[block.ids[:, None] == rid[None, :]] = np.iinfo(np.int64).min
                exact = b.column("exact")
                for n in range(len(block.ids)):
                    near = np.flatnonzero((up[n] >= floor_[n]) & (rid != block.ids[n]))
                    near = near[np.argsort(-up[n][near], kind="stable")]
                    for start in range(0, len(near), 4 * k):  # best bound first
                        part = near[start : start + 4 * k]
                        if len(best[n]) >= k and up[n][part[0]] < best[n][-1, 0]:
                            break
                        x = np.frombuffer(b"".join(exact[i].as_py() for i in part.tolist()), np.int64).reshape(len(part), dim)
                        got = np.concatenate([best[n], np.stack([product(x, block.q[n : n + 1])[:, 0], rid[part]], 1)])
                        best[n] = got[np.lexsort((got[:, 1], -got[:, 0]))][:k]
                    if len(best[n]) >= k:
                        floor_[n] = max(floor_[n], best[n][-1, 0])
        got = [np.concatenate([np.full((len(x), 1), i), x], 1) for i, x in zip(block.ids, best, strict=True) if len(x)]
        if got:
            m = np.concatenate(got)
            yield pa.record_batch([pa.array(m[:, 0]), pa.array(m[:, 2]), pa.array(m[:, 1])], names=["query_id", "vec_id", "score"])

    found = file.mapInArrow(refine, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query, k: int = TOP) -> DataFrame:
    """Exact top k of all rows for the rows where is_query holds (a column expression over id)."""
    spark = common.ready(vectors.sparkSession)
    file, lo, width = index(vectors)
    queries = file.where(is_query).select("id", "exact")
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out, after = none, None
    while True:  # a block at a time, by id
        block = (queries if after is None else queries.where(F.col("id") > after)).orderBy("id").limit(BLOCK).collect()
        if not block:
            return out
        found = search(file, lo, width, block, k)
        out = found if out is none else out.unionByName(found)
        after = block[-1]["id"]


def op4_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(common.ready(spark).read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0)


OP4_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

"""Exact top-k inner products: vectors by descending length, SVD-rotated partial sums, Cauchy-Schwarz bounds."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affilspark.llm._spark import cut, parts, table, union

#: Queries that one pass compares (a broadcast of QUERIES * dimension * 8 bytes), longest vectors that
#: give the first thresholds, vectors of one block.
QUERIES, SEEDS, BLOCK = 8192, 2048, 1024


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = 256) -> DataFrame:
    """id, copy (1 for an id's first row), v = floor(scale * x) as array<long>, norm2 (a double).

    Vectors that are null, empty or hold null or non-finite components, and rows without an id, are left out.
    Components beyond a long are held at its ends; ids are whole numbers.
    """
    x = F.col(vec_col)
    bad = F.exists(x, lambda y: y.isNull() | F.isnan(y) | (F.abs(y.cast("double")) == float("inf")))
    ints = vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(~bad).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda y: F.floor(F.lit(float(scale)) * y.cast("double")).cast("long")).alias("v"))
    copy = F.row_number().over(Window.partitionBy("id").orderBy("v"))
    return ints.withColumn("copy", copy).withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, y: a + y.cast("double") * y.cast("double")))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, n = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (n == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(n), d), np.int64)
    out[np.arange(d) < n[:, None]] = flat
    return out


def rotation(vectors: DataFrame, d: int) -> np.ndarray:
    """The right singular vectors of all vectors, largest first, from d x d sums made in the tasks."""

    def gram(batches):
        total = np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column(0), d).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    sums = vectors.select("v").mapInArrow(gram, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    total = np.zeros((d, d))
    total[sums["i"], sums["j"]] = sums["x"]
    return np.linalg.eigh((total + total.T) / 2)[1][:, ::-1].copy()


def _best(q: np.ndarray, s: np.ndarray, i: np.ndarray, k: int):
    """The k best of each query among (query, score, id), ties to smaller ids."""
    order = np.lexsort((i, -s, q))
    q, s, i = q[order], s[order], i[order]
    first = np.searchsorted(q, q, "left")
    keep = np.arange(len(q)) - first < k
    return q[keep], s[keep], i[keep]


def _exact(a: np.ndarray, b: np.ndarray, large: bool) -> np.ndarray:
    """Inner products of rows; if sums may pass a long, in whole numbers of any size, held at its ends."""
    if not large:
        return np.einsum("ij,ij->i", a, b)
    return np.array([max(min(sum(x * y for x, y in zip(p, q, strict=True)), (1 << 63) - 1), -(1 << 63)) for p, q in zip(a.tolist(), b.tolist(), strict=True)], np.int64)


def _search(shared, k: int, d: int, large: bool):
    """Scores the candidates of a partition, longest first, against all queries of the broadcast."""

    def run(batches):
        qid, qcopy, qv, rot, theta = shared.value
        qlen = np.sqrt((qv.astype(float) ** 2).sum(axis=1))
        head = max(1, d // 4)
        qr = qv @ rot
        qrest = np.sqrt(np.maximum((qr[:, head:] ** 2).sum(axis=1), 0))
        theta = theta.copy()
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            ids, copies, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), d)
            for lo in range(0, len(ids), BLOCK):
                c, cid, ccopy = x[lo : lo + BLOCK], ids[lo : lo + BLOCK], copies[lo : lo + BLOCK]
                longest = math.sqrt(float((c.astype(float) ** 2).sum(axis=1).max()))
                slack = 1e-9 * qlen * longest + 1e-6  # more than what sums of doubles can be off
                live = np.flatnonzero(qlen * longest + slack >= theta)
                if not len(live):
                    continue
                cr = c @ rot
                rest = np.sqrt(np.maximum((cr[:, head:] ** 2).sum(axis=1), 0))
                bound = qr[live, :head] @ cr[:, :head].T + qrest[live, None] * rest
                a, b = np.nonzero(bound + slack[live, None] >= theta[live, None])
                a = live[a]
                own = (qid[a] == cid[b]) & (qcopy[a] == ccopy[b])
                a, b = a[~own], b[~own]
                for at in range(0, len(a), 1 << 18):
                    p, r = a[at : at + (1 << 18)], b[at : at + (1 << 18)]
                    s = _exact(qv[p], c[r], large)
                    ok = s >= theta[p]
                    best = _best(np.r_[best[0], p[ok]], np.r_[best[1], s[ok]], np.r_[best[2], cid[r][ok]], k)
                    n = np.bincount(best[0], minlength=len(qid))
                    least = np.full(len(qid), np.inf)
                    np.minimum.at(least, best[0], best[1])
                    full = n >= k
                    theta[full] = np.maximum(theta[full], least[full])
        yield pa.RecordBatch.from_arrays([pa.array(qid[best[0]]), pa.array(qcopy[best[0]].astype(np.int32)), pa.array(best[2]), pa.array(best[1])], names=["query_id", "copy", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest integer inner products over all other rows.

    queries: a condition on `id`. Candidates are range-partitioned and sorted by falling length. The
    SEEDS longest give each query a first threshold; a block is skipped for a query if length times
    length is below it, and of the rest only pairs whose rotated partial sum plus the product of the
    residual lengths reaches it are multiplied out, in integers. Ties go to smaller ids. Queries meet
    the candidates in chunks of QUERIES. Fewer candidates than k give fewer rows. Shorter vectors
    count as ending in zeros. An id that occurs twice is two rows: each is the other's candidate. Ids are
    whole numbers; scores beyond a long's range are held at its ends. Other columns are ignored, whatever
    their names; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    q = quantised(vectors, id_col, vec_col, scale)
    ranged = cut(q.repartitionByRange(parts(spark), F.desc("norm2")).sortWithinPartitions(F.desc("norm2"), "id"))
    d, most = ranged.agg(F.max(F.size("v")), F.max("norm2")).first()
    kind = "query_id long, copy int, vec_id long, score long"
    if d is None:
        empty = spark.createDataFrame([], kind)
        return empty.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    rot = rotation(ranged, d)
    seeds = ranged.orderBy(F.desc("norm2"), "id").limit(SEEDS).select("id", "copy", "v").toArrow()
    sid, scopy, sv = (seeds.column(i).combine_chunks() for i in range(3))
    sid, scopy, sv = sid.to_numpy(), scopy.to_numpy(), _matrix(sv, d)
    asked = ranged.where(queries)
    chunks = max(1, math.ceil(asked.count() / QUERIES))
    found = []
    for chunk in range(chunks):
        own = asked.where(F.pmod(F.xxhash64("id"), F.lit(chunks)) == chunk).select("id", "copy", "v").toArrow()
        if not own.num_rows:
            continue
        qid, qcopy, qv = own.column(0).to_numpy(), own.column(1).to_numpy(), _matrix(own.column(2).combine_chunks(), d)
        theta = np.full(len(qid), -np.inf)
        for lo in range(0, len(qid), 1024):
            s = (qv[lo : lo + 1024].astype(float) @ sv.T.astype(float)).round()
            s[(qid[lo : lo + 1024, None] == sid) & (qcopy[lo : lo + 1024, None] == scopy)] = -np.inf
            if s.shape[1] >= k:
                theta[lo : lo + 1024] = np.partition(s, -k, axis=1)[:, -k]
        if float(most) >= 2.0**52:  # sums of floats would not be exact
            theta[:] = -np.inf
        shared = spark.sparkContext.broadcast((qid, qcopy, qv, rot, theta))
        got = ranged.select("id", "copy", "v").mapInArrow(_search(shared, k, d, float(most) >= 2.0**61), kind)
        found.append(got if chunks == 1 else cut(got))
    if not found:
        return top_k(vectors.limit(0), queries, k, id_col, vec_col, scale)
    rank = F.row_number().over(Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id"))
    return union(found).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


#: DuckDB: all inner products of the query rows, by plain sums.
OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

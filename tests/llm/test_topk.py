"""Exact top-k against all inner products, and the oracles of the SQL-expressible queries."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from affilspark.llm import queries, topk

SF = "/root/testdata/sf0.001"


def test_top_k_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)) * rng.random((400, 1)) * 4
    rows = [(i, v.astype(float).tolist()) for i, v in enumerate(x)]
    rows += [(400, rows[3][1]), (401, rows[3][1]), (500, rows[7][1]), (500, rows[8][1]), (402, None), (403, [1.0, None]), (404, [float("nan")] * 6), (405, [float("inf")] + [0.0] * 5), (None, rows[1][1]), (406, [0.5, 0.5]), (407, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as score", "2 as id")
    ok = [(i, v) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    ints = np.zeros((len(ok), 6), np.int64)
    for n, (_, v) in enumerate(ok):
        ints[n, : len(v)] = np.floor(256 * np.array(v))
    want = []
    for n, (i, _) in enumerate(ok):
        if i % 50 == 0:
            scored = sorted((-int(ints[n] @ ints[m]), ok[m][0]) for m in range(len(ok)) if m != n)
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored[:5])]
    got = topk.top_k(table, F.col("id") % 50 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_large_components(spark):
    rows = [(0, [2e7, 1.0]), (1, [1e7, 3.0]), (2, [2e7, -1.0]), (3, [1e30, 0.0]), (4, [0.0, 0.0])]
    got = [tuple(r)[2:] for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") == 0, k=3).orderBy("rank").collect()]
    assert got == [(1, (1 << 63) - 1), (2, (1 << 63) - 1), (3, (1 << 63) - 1)]
    rows = [(0, [5e6, 1.0]), (1, [4e6, 3.0]), (2, [-5e6, -1.0])]
    got = [tuple(r) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 65536 * (20_000_000_000_000 + 3)), (0, 2, 2, -65536 * (25_000_000_000_000 + 1))]


def test_top_k_small(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, F.col("id") % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(two, F.col("id") % 50 == 0).collect()] == [(0, 1, 3, 131072)]
    assert topk.top_k(two, F.col("id") == 99).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    key = list(want.columns)
    assert sorted(map(tuple, got[key].astype(str).values)) == sorted(map(tuple, want.astype(str).values))

"""Components against a plain search, and the spread of hot keys."""

import random
import re

from pyspark.sql import functions as F

from affilspark.llm import components
from affilspark.llm.components import connected_components, with_least


def test_components_of_hubs_chains_and_loops(spark):
    r = random.Random(8)
    edges = [(0, i) for i in range(1, 400)]  # a hub that is the least, and one that is the greatest
    edges += [(i, 5000) for i in range(1000, 1400)]
    edges += [(i, i + 1) for i in range(6000, 6060)] + [(7000, 7000), (7001, 7001)]
    edges += [(r.randint(8000, 8300), r.randint(8000, 8300)) for _ in range(200)]
    edges += [(b, a) for a, b in edges[::3]] + edges[::5]
    label = {v: v for e in edges for v in e}
    while True:
        new = dict(label)
        for a, b in edges:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            break
        label = new
    met = {v for a, b in edges if a != b for v in (a, b)}
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(met) and {x.a: x.root for x in got} == {v: label[v] for v in met}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_least_of_a_hot_key_is_spread(spark):
    rows = spark.range(20_000).select((F.col("id") % 40 == 0).cast("long").alias("k"), F.when(F.col("id") > 9, F.col("id")).alias("v"), "id")
    got = with_least(rows.withColumn("k", F.when(F.col("k") == 1, F.col("id") % 7).otherwise(9)), "k", "v")
    want = {k: min(i for i in range(10, 20_000) if (i % 7 if i % 40 == 0 else 9) == k) for k in (*range(7), 9)}
    assert {tuple(x) for x in got.select("k", "m").distinct().collect()} == set(want.items()) and got.count() == 20_000
    nulls = with_least(rows.where("id < 5").select("k", F.lit(None).cast("long").alias("v")), "k", "v")
    assert nulls.count() == 5 and nulls.where("m is null").count() == 5
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"Join \[k#\d+L?, salt#\d+\]", plan)


def test_least_values_sent_or_joined(spark, monkeypatch):
    rows = spark.range(20_000).select(F.when(F.col("id") % 40 == 0, F.col("id") % 1000).otherwise(-1).alias("a"), (F.col("id") * 7919 % 20_011).alias("b"))
    want = {tuple(x) for x in rows.groupBy("a").agg(F.min("b")).collect()}
    for sent in (1 << 18, 100, 3):
        monkeypatch.setattr(components, "SENT", sent)
        got = components._with_least_sent(rows, "a", "b", 20_000)
        assert got.count() == 20_000 and {tuple(x) for x in got.select("a", "m").distinct().collect()} == want
        joins = len(re.findall(r"SortMergeJoin|ShuffledHashJoin", got._jdf.queryExecution().sparkPlan().toString()))
        assert joins <= (sent < 20_000)  # the hot key's rows never go through it
    monkeypatch.setattr(components, "SENT", 3)
    test_components_of_hubs_chains_and_loops(spark)

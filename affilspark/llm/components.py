"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affilspark.llm._spark import cut, parts

#: Most keys whose least value is sent to every task (16 bytes each).
SENT = 1 << 18


def with_least(rows: DataFrame, key: str, value: str) -> DataFrame:
    """rows with `m`, the least `value` of their `key`, which is not null.

    Rows are dealt by key and a salt of their content, and a key's least value is sent once to each salt it
    has, so the rows of a hot key stay in as many tasks as there are partitions.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(parts(rows.sparkSession))).cast("int"))
    each = salted.groupBy(key, "salt").agg(F.min(value).alias("m"))
    least = each.groupBy(key).agg(F.min("m").alias("m"), F.collect_list("salt").alias("salt")).select(key, "m", F.explode("salt").alias("salt"))
    return salted.join(least, [key, "salt"]).drop("salt")


def _with_least_sent(rows: DataFrame, key: str, value: str, most: int) -> DataFrame:
    """rows with `m`, the least `value` of their `key`; `most` is a bound on their number, and values are not null.

    The least values of keys with over most / SENT rows, of which there are at most SENT, are sent to every
    task, so the rows of hot keys stay where they are; the others meet theirs in a join, in which no key has more
    rows than that. Where this leaves keys of one row only, their value is the least and there is no join.
    """
    bound = max(1, -(-most // SENT))
    least = rows.groupBy(key).agg(F.min(value).alias("m"), F.count("*").alias("n"))
    met = rows.join(F.broadcast(least.where(F.col("n") > bound).select(key, "m")), key, "left")
    if bound == 1:
        return met.withColumn("m", F.coalesce("m", value))
    cold = met.where("m is null").drop("m").join(least.where(F.col("n") <= bound).select(key, "m"), key)
    return met.where("m is not null").unionByName(cold)


def _stars(edges: DataFrame, large: bool, most: int) -> DataFrame:
    """One half-step: hangs each vertex's larger (or smaller) neighbours on the least vertex around it; most: a bound on twice the edges."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = _with_least_sent(both, "a", "b", most).where("b > a")
        return near.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    near = _with_least_sent(down, "a", "b", most)
    hung = F.explode(F.array(*[F.struct(F.col(c).alias("a"), F.col("m").alias("b")) for c in ("a", "b")])).alias("e")
    return near.select(hung).select("e.*").where("a <> b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Vertices of edges(a, b) with `root`, the least vertex of their component.

    Alternating large-star and small-star steps; a round makes no more edges than it gets, and
    a hub's edges stay one row each and its least neighbour is sent to them, so no task gathers a
    component. Loops are dropped; no edges give no rows. The driver sees one checksum a round.
    """
    now = cut(edges.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        now = cut(_stars(_stars(now, True, 2 * mark[0]), False, 2 * mark[0]))
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("b").alias("a"), F.col("b").alias("root")).distinct()
    return now.select("a", F.col("b").alias("root")).unionByName(roots)

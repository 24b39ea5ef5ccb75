"""Building blocks of entity resolution: what is left, what is best, what is united."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affilspark.functions.text import percent


def unmatched(df: DataFrame, matches: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key no match has."""
    return df.join(matches.select(key).distinct(), key, "left_anti")


def restrict(df: DataFrame, ids: DataFrame, *keys: str) -> DataFrame:
    """Rows of df whose keys occur in ids."""
    return df.join(ids.select(*keys).distinct(), list(keys), "left_semi")


def best_per_key(df: DataFrame, key: str | list[str], *order: Column | str) -> DataFrame:
    """The first row per key; Spark limits each task's rows of a key before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order))
    return df.withColumn("_rk", rank).where(F.col("_rk") == 1).drop("_rk")


def union_matches(*tables: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """All rows of the tables; columns a table lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out.select(*columns) if columns else out


def coverage_audit(total: DataFrame, matched: DataFrame, key: str, weight: str, stage: int) -> DataFrame:
    """One row: rows and weight in all and matched (each key once), percent of weight (null for none)."""
    alls = total.agg(F.count("*").alias("total_pairs_distinct"), F.coalesce(F.sum(weight), F.lit(0)).alias("total_pairs_weighted"))
    once = matched.groupBy(key).agg(F.max(weight).alias(weight))
    some = once.agg(F.count("*").alias("matched_distinct"), F.coalesce(F.sum(weight), F.lit(0)).alias("matched_weighted"))
    return alls.crossJoin(some).withColumn("stage", F.lit(stage)).withColumn("matched_pct_weighted", percent(F.col("matched_weighted"), F.col("total_pairs_weighted")))


def covered(spark: SparkSession, *rows: tuple[int, int, int, int, int]) -> DataFrame:
    """coverage_audit() from known numbers: stage, rows and weight in all, and matched."""
    known = spark.createDataFrame(list(rows), "stage int, total_pairs_distinct long, total_pairs_weighted long, matched_distinct long, matched_weighted long")
    return known.withColumn("matched_pct_weighted", percent(F.col("matched_weighted"), F.col("total_pairs_weighted")))


def covered_by_source(spark: SparkSession, total: int | None, rows: list[tuple[int, str, int, int]]) -> DataFrame:
    """coverage_by_source() from known numbers: stage, source, keys and weight."""
    known = spark.createDataFrame(rows, "stage int, match_source string, matched_distinct long, matched_weighted long")
    return known.withColumn("matched_pct_weighted_source", percent(F.col("matched_weighted"), F.lit(total).cast("long")))


def coverage_by_source(best: DataFrame, total: DataFrame, key: str = "org_row_id", weight: str = "pair_cnt", sources: DataFrame | None = None, stage: int = 5) -> DataFrame:
    """Distinct keys and weight per match source of a stage, with its percent of all weight; `sources` adds rows of 0."""
    got = best.groupBy("match_source").agg(F.countDistinct(key).alias("matched_distinct"), F.sum(weight).alias("matched_weighted"))
    if sources is not None:
        got = sources.select("match_source").join(got, "match_source", "left").fillna(0, ["matched_distinct", "matched_weighted"])
    whole = total.agg(F.sum(weight).alias("_w"))
    return got.crossJoin(F.broadcast(whole)).withColumn("matched_pct_weighted_source", percent(F.col("matched_weighted"), F.col("_w"))).withColumn("stage", F.lit(stage)).drop("_w")

"""Role titles to a taxonomy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affilspark.functions.text import blank_to_null, trim
from affilspark.operators.curate import is_filled
from affilspark.operators.matching import best_per_key

FIELDS = ["edu_level_isced2011", "career_stage_efrc", "occupation_isco08", "field_fos2015"]


def role_title_map(src: DataFrame) -> DataFrame:
    """One row per trimmed, lower-cased title: the first in file order (src_rownum).

    Inner whitespace is kept, while titles are matched with their first run made one space, so a mapped
    title with a double space is not found.
    """
    rows = src.where(is_filled("role_title_raw")).select(
        "src_rownum", "role_title_raw", F.lower(trim("role_title_raw")).alias("role_title_norm"), *[blank_to_null(c).alias(c) for c in FIELDS], F.coalesce(F.col("is_academic") == 1, F.lit(False)).alias("is_academic")
    )
    return best_per_key(rows, "role_title_norm", "src_rownum").drop("src_rownum")


def match_role_title(titles: DataFrame, mapped: DataFrame) -> DataFrame:
    """All titles with their taxonomy codes, null where none is known."""
    return titles.join(mapped.select("role_title_norm", *FIELDS, "is_academic"), "role_title_norm", "left").select(*titles.columns, *FIELDS, "is_academic")


def _hit() -> Column:
    return F.coalesce(*[F.col(c).cast("string") for c in [*FIELDS, "is_academic"]]).isNotNull()


def role_title_metrics(matched: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """The counts of role_title_audit() without distinct ones: matched with `_first`, which marks one row of each title, and the counts."""
    first = F.row_number().over(Window.partitionBy("role_title_norm").orderBy("role_title_raw")) == 1
    one = lambda when: F.coalesce(F.sum(F.when(when, 1).otherwise(0)), F.lit(0))
    named = F.col("_first") & F.col("role_title_norm").isNotNull()
    counts = {"total_rows": F.count(F.lit(1)), "distinct_role_title_norm": one(named), "matched_rows": one(_hit()), "matched_role_title_norm": one(named & _hit())}
    return matched.withColumn("_first", first), counts


def with_matched_percent(counts: DataFrame) -> DataFrame:
    return counts.withColumn("matched_pct_rows", F.lit(100.0) * F.col("matched_rows") / F.nullif(F.col("total_rows"), F.lit(0)))


def role_title_audit(matched: DataFrame) -> DataFrame:
    """One row: rows and distinct titles, matched rows and titles, percent of rows (not rounded; null for none)."""
    hit = _hit()
    rows = F.sum(F.when(hit, 1).otherwise(0))
    return matched.agg(
        F.count("*").alias("total_rows"), F.countDistinct("role_title_norm").alias("distinct_role_title_norm"), F.coalesce(rows, F.lit(0)).alias("matched_rows"),
        F.countDistinct(F.when(hit, F.col("role_title_norm"))).alias("matched_role_title_norm"), (F.lit(100.0) * rows / F.nullif(F.count("*"), F.lit(0))).alias("matched_pct_rows"),
    )

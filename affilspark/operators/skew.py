"""Joins whose tasks stay even: hot keys in tiles, rows with null keys past the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pairs of rows that a key may make in one task.
PAIRS = 1 << 20


def tiled_join(left: DataFrame, right: DataFrame, keys: list[str], pairs: int = PAIRS) -> DataFrame:
    """left.join(right, keys), where a key that makes more than `pairs` pairs is dealt in tiles of about that many.

    Both sides are counted by key. A heavy key's rows are cut in slices on either side, by a hash of the row, and each row is
    sent once to every slice of the other side, so all pairs meet once. Other keys have one tile; a key's copies
    are about as many as the square root of its tiles.
    """
    key = lambda df, is_left: df.select(*keys, F.lit(is_left).alias("_s"))
    n = lambda side: F.sum((F.col("_s") == side).cast("long"))
    both = key(left, 0).unionByName(key(right, 1)).groupBy(*keys).agg(n(0).alias("_l"), n(1).alias("_r")).where(F.col("_l") * F.col("_r") > pairs)
    side = F.sqrt(F.lit(float(pairs)))
    # slices of about sqrt(pairs) rows; a side that has fewer stays whole and the other is cut finer
    heavy = both.withColumn("_a", F.ceil(F.col("_l") / F.greatest(side, pairs / F.col("_r")))).withColumn("_b", F.ceil(F.col("_r") / F.greatest(side, pairs / F.col("_l"))))
    heavy = heavy.select(*keys, F.col("_a").cast("int"), F.col("_b").cast("int"))

    def dealt(df: DataFrame, own: str, other: str, own_slices: str, other_slices: str) -> DataFrame:
        known = df.join(heavy, keys, "left")
        slice_ = F.pmod(F.xxhash64(*df.columns), F.coalesce(own_slices, F.lit(1))).cast("int")
        return known.withColumn(own, slice_).withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other_slices, F.lit(1)) - 1))).drop("_a", "_b")

    return dealt(left, "_x", "_y", "_a", "_b").join(dealt(right, "_y", "_x", "_b", "_a"), [*keys, "_x", "_y"]).drop("_x", "_y")


def left_join_past_nulls(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left.join(right, keys, "left"); rows with a null key, which match nothing, do not take part in its shuffle."""
    full = F.lit(True)
    for k in keys:
        full &= F.col(k).isNotNull()
    added = [f for f in right.schema.fields if f.name not in keys]
    rest = left.where(~full).select(*[F.col(k) for k in keys], *[c for c in left.columns if c not in keys], *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    return left.where(full).join(right, keys, "left").unionByName(rest)

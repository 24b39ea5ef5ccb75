"""Country text to ISO codes."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


@pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Spark has no compatibility normalization; meant for distinct values."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).strip())


def country_map(counted: DataFrame, iso: DataFrame, territories: DataFrame, raw: str = "organization_country", cnt: str = "cnt") -> DataFrame:
    """organization_country_raw, organization_country_iso2, mapping_method, cnt of distinct raw countries.

    Two letters in `iso(alpha2)` are `iso2`; else `territories(from, alpha2)` decides, for other
    lengths by the whole name with single spaces (`territorial`); all else, null too, is `fallback`.
    Territory keys have no whitespace (see read_country_lookups), so names of several words never hit.
    Python sees distinct values only; both lookups are joins of small tables.
    """
    x = counted.select(F.col(raw).alias("raw"), F.col(cnt).alias("cnt")).withColumn("clean", nfkc("raw"))
    code: Column = F.upper(F.regexp_replace("clean", r"(?U)\s+", ""))
    two = code.rlike(r"^\p{L}{2}$")
    x = x.withColumn("code", F.when(two, code)).withColumn("name", F.when(two, code).otherwise(F.upper(F.regexp_replace(F.lower("clean"), r"(?U)\s+", " "))))
    known = iso.select(F.col("alpha2").alias("code"), F.lit(True).alias("is_iso")).distinct()
    legal = iso.select(F.col("alpha2")).distinct()
    land = territories.join(legal, "alpha2", "left_semi").select(F.col("from").alias("name"), F.col("alpha2").alias("land")).dropDuplicates(["name"])
    x = x.join(F.broadcast(known), "code", "left").join(F.broadcast(land), "name", "left")
    iso2 = F.when(F.col("is_iso"), F.col("code")).otherwise(F.col("land"))
    method = F.when(F.col("is_iso"), "iso2").when(F.col("land").isNotNull(), "territorial").otherwise("fallback")
    return x.select(F.col("raw").alias("organization_country_raw"), iso2.alias("organization_country_iso2"), method.alias("mapping_method"), "cnt")

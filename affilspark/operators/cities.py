"""City resolution against a gazetteer: exact names, aliases, then shared tokens behind a first-token block."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affilspark.functions.text import first_token, norm_text, row_key, token_overlap, token_set, trim
from affilspark.operators.matching import best_per_key, union_matches
from affilspark.operators.skew import PAIRS, tiled_join

CITY = ["city_row_id", "organization_city_raw", "organization_city_norm", "organization_country_iso2", "pair_cnt"]
PLACE = ["geoname_id", "city_official_name", "admin1_code", "admin2_code", "timezone"]
MATCH = [*CITY, *PLACE, "confidence", "match_rule"]
GAZETTEER = "geoname_id string, ascii_name string, alternate_names string, country_code string, admin1_code string, admin2_code string, timezone string"


def city_rows(cities: DataFrame) -> DataFrame:
    """city_text with city_row_id, a key of raw country and city."""
    return cities.withColumn("city_row_id", row_key("organization_country_raw", "organization_city_raw")).select(*CITY)


def _places(gaz: DataFrame) -> DataFrame:
    return gaz.select(F.col("geoname_id").cast("string").alias("geoname_id"), F.col("ascii_name").alias("city_official_name"), "admin1_code", "admin2_code", "timezone", "country_code", "alternate_names")


def match_exact(pending: DataFrame, gaz: DataFrame) -> DataFrame:
    """Rule 1: country and normalized official name; all candidates stay. Null names or countries never match."""
    ref = _places(gaz).select(*PLACE, F.col("country_code").alias("organization_country_iso2"), norm_text("city_official_name").alias("organization_city_norm"))
    return pending.join(ref, ["organization_country_iso2", "organization_city_norm"]).withColumn("confidence", F.lit(1.0)).withColumn("match_rule", F.lit(1)).select(*MATCH)


def gazetteer_names(gaz: DataFrame) -> DataFrame:
    """Distinct (name, country, id) of official names (not trimmed) and comma-separated alternates (trimmed)."""
    place = _places(gaz)
    own = place.select(norm_text("city_official_name", trimmed=False, empty_to_null=False).alias("name"), "country_code", "geoname_id")
    other = explode_aliases(place, "alternate_names").select(norm_text("alias", empty_to_null=False).alias("name"), "country_code", "geoname_id")
    return own.unionByName(other).distinct()


def explode_aliases(df: DataFrame, col: str, sep: str = ",") -> DataFrame:
    """A row per separated name in `alias`; blank ones are left out."""
    return df.withColumn("alias", F.explode(F.split(F.coalesce(F.col(col), F.lit("")), sep, -1))).where(F.length(trim("alias")) > 0)


def match_alias(pending: DataFrame, gaz: DataFrame) -> DataFrame:
    """Rule 2: country and any name of the place."""
    names = gazetteer_names(gaz).select(F.col("country_code").alias("organization_country_iso2"), F.col("name").alias("organization_city_norm"), "geoname_id")
    found = pending.join(names, ["organization_country_iso2", "organization_city_norm"]).join(_places(gaz).select(*PLACE), "geoname_id")
    return found.withColumn("confidence", F.lit(1.0)).withColumn("match_rule", F.lit(2)).select(*MATCH)


def match_tokens_first(pending: DataFrame, gaz: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """Rule 3: the place of the same country that shares most tokens, ids as text breaking ties.

    Candidates share the first token of the place's official name or of an alias; blocks are distinct,
    so a place is compared once, and so are texts: cities of one code and normalized text have one match. Shared
    tokens count those of the official name; confidence is their share of the city's tokens. Pairs are made
    of texts and places alone; a (country, first token) that makes over `pairs` of them is dealt in tiles.
    The best is an aggregate, so tasks reduce before the shuffle.
    """
    ref = _places(gaz).where(F.col("country_code").isNotNull() & F.col("city_official_name").isNotNull())
    ref = ref.withColumn("official", norm_text("city_official_name", trimmed=False, empty_to_null=False))
    own = ref.select("geoname_id", "country_code", first_token("official").alias("first_tok"))
    other = explode_aliases(_places(gaz).where("country_code is not null"), "alternate_names")
    other = other.select("geoname_id", "country_code", first_token(norm_text("alias", empty_to_null=False)).alias("first_tok"))
    block = own.unionByName(other).where("first_tok <> ''").distinct().withColumnRenamed("country_code", "organization_country_iso2")
    block = block.join(ref.select("geoname_id", token_set("official").alias("g_toks")), "geoname_id")
    text = ["organization_country_iso2", "organization_city_norm"]
    city = pending.select(*text).where("organization_country_iso2 is not null and organization_city_norm is not null").distinct()
    city = city.select(*text, token_set("organization_city_norm").alias("p_toks"), first_token("organization_city_norm").alias("first_tok")).where("first_tok <> ''")
    shared, _, conf = token_overlap(F.col("p_toks"), F.col("g_toks"))
    met = tiled_join(city, block, ["organization_country_iso2", "first_tok"], pairs)
    scored = met.select(*text, "geoname_id", shared.alias("inter_sz"), conf.alias("confidence")).where("inter_sz > 0")
    best = scored.groupBy(*text).agg(F.min(F.struct((-F.col("inter_sz")).alias("n"), "geoname_id", "confidence")).alias("b")).select(*text, "b.geoname_id", "b.confidence")
    return pending.join(best, text).join(_places(gaz).select(*PLACE), "geoname_id").withColumn("match_rule", F.lit(3)).select(*MATCH)


def city_weights(cities: DataFrame) -> DataFrame:
    keys = ["organization_country_iso2", "organization_city_norm", "organization_city_raw"]
    return cities.groupBy(*keys).agg(F.sum("pair_cnt").alias("pair_cnt"))


def attach_weight(matches: DataFrame, weights: DataFrame) -> DataFrame:
    """Matches with the summed weight of (code, norm, raw): spellings of one code share it."""
    return matches.drop("pair_cnt").join(weights, ["organization_country_iso2", "organization_city_norm", "organization_city_raw"]).select(*MATCH)


def best_city(*stages: DataFrame) -> DataFrame:
    """Of all stages the match of the lowest rule, highest confidence and least id (as text) per city."""
    return best_per_key(union_matches(*stages, columns=MATCH), "city_row_id", F.asc_nulls_last("match_rule"), F.desc("confidence"), F.asc_nulls_last("geoname_id"))

"""Fact and dimensions of affiliations, value profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affilspark.functions.text import lower_key, norm_text, org_key, percent, start_year, trim
from affilspark.operators.skew import left_join_past_nulls
from affilspark.sources.schemas import AFFILIATION_COLUMNS

_KEY = "orcid affiliation_type role_title department_name organization_name organization_city organization_country start_date end_date".split()
_ORG = "organization_name organization_city organization_country disambiguation_source disambiguated_organization_identifier".split()


def with_lineage(df: DataFrame, **constants: str) -> DataFrame:
    """Constant columns such as source_version, ingested_at or decided_at; parameters, so reruns agree."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def fact_affiliation(aff: DataFrame) -> DataFrame:
    """aff_id (equal rows share it), the affiliation columns, start_year, is_edu, is_emp."""
    kind = lambda x: F.coalesce(F.col("affiliation_type") == x, F.lit(False))
    return aff.select(lower_key(*_KEY).alias("aff_id"), *AFFILIATION_COLUMNS, start_year("start_date").alias("start_year"), kind("education").alias("is_edu"), kind("employment").alias("is_emp"))


def dim_person(fact: DataFrame) -> DataFrame:
    """Per person the least non-null names, which makes "any name" repeatable, and the record count."""
    return fact.groupBy(F.col("orcid").alias("person_id")).agg(F.min("given_names").alias("given_names"), F.min("family_name").alias("family_name"), F.count("*").alias("records"))


def dim_org_raw(fact: DataFrame) -> DataFrame:
    """Distinct raw organizations with raw_org_key."""
    key = org_key("disambiguation_source", "disambiguated_organization_identifier", "organization_name", "organization_country", "organization_city")
    return fact.select(*_ORG).distinct().select(key.alias("raw_org_key"), *_ORG)


def weighted_distinct(df: DataFrame, *cols: str, name: str = "cnt") -> DataFrame:
    """Distinct combinations with their row count; nulls group together."""
    return df.groupBy(*cols).agg(F.count("*").alias(name))


def value_frequency(df: DataFrame, col: str) -> DataFrame:
    return weighted_distinct(df.select(F.col(col).alias("value")), "value")


def normalization_metrics(weight: str, mapped: str) -> dict[str, Column]:
    """The sums of normalization_audit()."""
    has = F.col(mapped).isNotNull()
    part = lambda when: F.sum(F.when(when, F.col(weight)).otherwise(0))
    return {"total_weighted": F.sum(weight), "distinct_rows": F.count(F.lit(1)), "mapped_weighted": part(has), "unmapped_weighted": part(~has)}


def with_mapped_percent(sums: DataFrame) -> DataFrame:
    return sums.withColumn("mapped_pct", percent(F.col("mapped_weighted"), F.col("total_weighted")))


def normalization_audit(df: DataFrame, weight: str, mapped: str) -> DataFrame:
    """One row: weight and rows in all, weight with and without a mapped value, percent mapped (null for none)."""
    return with_mapped_percent(df.agg(*[c.alias(k) for k, c in normalization_metrics(weight, mapped).items()]))


def attach_country(df: DataFrame, cmap: DataFrame, raw: str) -> DataFrame:
    """Adds organization_country_iso2 by raw value; null never matches. The map has a row per raw country."""
    codes = cmap.select(F.col("organization_country_raw").alias("_raw"), "organization_country_iso2")
    return df.join(codes, df[raw] == F.col("_raw"), "left").drop("_raw")


def city_text(dim_org: DataFrame, cmap: DataFrame) -> DataFrame:
    """Distinct (country, city) with code, normalized city and pair_cnt, their number of raw organizations.

    The raw country is kept, so a city has one stable key.
    """
    pairs = weighted_distinct(dim_org.select(F.col("organization_country").alias("organization_country_raw"), F.col("organization_city").alias("organization_city_raw")), "organization_country_raw", "organization_city_raw", name="pair_cnt")
    return attach_country(pairs, cmap, "organization_country_raw").withColumn("organization_city_norm", norm_text("organization_city_raw"))


def org_text(dim_org: DataFrame, cmap: DataFrame, cities: DataFrame, dedupe_city: bool = False) -> DataFrame:
    """Distinct (country, city, name) with code, normalized name ('' for null) and city, and pair_cnt.

    Two raw countries of one code make a city occur twice under (code, raw city), which repeats its
    organizations; dedupe_city joins distinct pairs instead. Rows without a code or city go past that join.
    """
    raw = {"organization_country": "organization_country_raw", "organization_city": "organization_city_raw", "organization_name": "organization_name_raw"}
    rows = weighted_distinct(dim_org.select(*[F.col(k).alias(v) for k, v in raw.items()]), *raw.values(), name="pair_cnt")
    named = cities.select("organization_country_iso2", "organization_city_raw", "organization_city_norm")
    named = named.distinct() if dedupe_city else named
    return left_join_past_nulls(attach_country(rows, cmap, "organization_country_raw"), named, ["organization_country_iso2", "organization_city_raw"]).withColumn("organization_name_norm", norm_text("organization_name_raw", empty_to_null=False))


def role_title_text(fact: DataFrame) -> DataFrame:
    titles = weighted_distinct(fact.select(F.col("role_title").alias("role_title_raw")), "role_title_raw", name="pair_cnt")
    return titles.select("role_title_raw", norm_text("role_title_raw").alias("role_title_norm"), "pair_cnt")


def is_filled(c: str) -> Column:
    return F.length(trim(F.coalesce(F.col(c), F.lit("")))) > 0

"""Nested registry records to flat tables, and tables derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affilspark.functions.text import clean_domain, percent, trim
from affilspark.operators.matching import best_per_key

#: Preference of name types.
NAME_TYPES = ("ror_display", "label", "alias", "acronym")


def _text(c: Column | str) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def registry_organization(raw: DataFrame) -> DataFrame:
    admin = {f"admin_{a}_{b}": f"admin.{a}.{b}" for a in ("created", "last_modified") for b in ("date", "schema_version")}
    return raw.select("id", _text("status").alias("status"), F.coalesce("types", F.array().cast("array<string>")).alias("types"), "established", *[_text(path).alias(name) for name, path in admin.items()])


def registry_name(raw: DataFrame) -> DataFrame:
    """A row per name and type; a name without types gives none."""
    names = raw.select("id", F.explode("names").alias("n")).select("id", "n.value", "n.lang", F.explode("n.types").alias("type"))
    return names.select("id", *[_text(c).alias(c) for c in ("value", "lang", "type")])


def registry_link(raw: DataFrame) -> DataFrame:
    return raw.select("id", F.explode("links").alias("l")).select("id", _text("l.type").alias("type"), _text("l.value").alias("value"))


def registry_external_id(raw: DataFrame) -> DataFrame:
    """A row per value of each identifier type."""
    ids = raw.select("id", F.explode("external_ids").alias("e")).select("id", "e.type", "e.preferred", F.explode("e.all").alias("value"))
    return ids.select("id", *[_text(c).alias(c) for c in ("type", "value", "preferred")])


def registry_location(raw: DataFrame) -> DataFrame:
    d = "l.geonames_details"
    return raw.select("id", F.explode("locations").alias("l")).select(
        "id", F.col("l.geonames_id").cast("string").alias("geonames_id"), _text(f"{d}.country_code").alias("country_code"), _text(f"{d}.country_subdivision_code").alias("admin1_code"),
        F.col(f"{d}.lat").try_cast("double").alias("lat"), F.col(f"{d}.lng").try_cast("double").alias("lng"), _text(f"{d}.name").alias("city_name"),
    )


def registry_relationship(raw: DataFrame) -> DataFrame:
    return raw.select("id", F.explode("relationships").alias("r")).select("id", _text("r.type").alias("type"), _text("r.label").alias("label"), _text("r.id").alias("related_id"))


def registry_domain(raw: DataFrame) -> DataFrame:
    return raw.select("id", F.explode("domains").alias("value_raw")).select("id", "value_raw", clean_domain("value_raw").alias("value"))


def registry_org_type(organization: DataFrame) -> DataFrame:
    return organization.select("id", F.explode("types").alias("type"))


def preferred_name(names: DataFrame) -> DataFrame:
    """One name per id: the best type, then the least value."""
    prio = F.coalesce(F.array_position(F.array(*[F.lit(t) for t in NAME_TYPES]), F.col("type")), F.lit(0))
    first = best_per_key(names, "id", F.when(prio > 0, prio).otherwise(9), F.asc_nulls_last("value"))
    return first.select("id", F.col("value").alias("preferred_name"), F.col("lang").alias("preferred_lang"), F.col("type").alias("preferred_type"))


def registry_enriched(organization: DataFrame, names: DataFrame) -> DataFrame:
    return organization.drop("types").join(names, "id", "left")


def preferred_metrics() -> dict[str, Column]:
    """Organizations of registry_enriched(), and those with a preferred name."""
    has = F.sum(F.when(F.length(trim(F.coalesce("preferred_name", F.lit("")))) > 0, 1).otherwise(0))
    return {"org_total": F.count(F.lit(1)), "org_with_preferred_name": F.coalesce(has, F.lit(0))}


def with_preferred_percent(counts: DataFrame) -> DataFrame:
    return counts.withColumn("preferred_name_coverage_pct", percent(F.col("org_with_preferred_name"), F.col("org_total")))


def registry_audit(organization: DataFrame, enriched: DataFrame, **tables: DataFrame) -> DataFrame:
    """One row: row counts of the tables by name, and how many organizations have a preferred name."""
    out = organization.agg(F.count("*").alias("organization_rows"))
    for name, t in tables.items():
        out = out.crossJoin(t.agg(F.count("*").alias(f"{name}_rows")))
    return with_preferred_percent(out.crossJoin(enriched.agg(*[c.alias(k) for k, c in preferred_metrics().items()])))


def crosswalk(external_ids: DataFrame, kind: str) -> DataFrame:
    """value_norm to the least registry id with that identifier."""
    rows = external_ids.where(F.lower("type") == kind).select(F.lower(trim("value")).alias("value_norm"), "id")
    return rows.groupBy("value_norm").agg(F.min("id").alias("ror_id"))

"""Command-line jobs over folders: `spark-submit jobs.py <job> --in ... --out ... --at <time>`.

registry and resolve keep their tables in a Store: run again, they read what has not changed and go on where a
run was cut off.
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affilspark.functions.country import country_map
from affilspark.operators import curate as K
from affilspark.operators import registry as R
from affilspark.operators import roles
from affilspark.plans.store import Store
from affilspark.plans.workflow import resolve_cities, resolve_orgs
from affilspark.sources import readers, writers
from affilspark.sources.schemas import RINGGOLD, ROLE_MAP
from affilspark.sources.xml import broken_xml, pack_xml


def pack(spark: SparkSession, o: argparse.Namespace) -> None:
    """A tree of XML files to blocks, and the files that cannot be read to an error table beside them."""
    pack_xml(spark, o.source, f"{o.out}/blocks")
    broken_xml(spark.read.schema("path string, xml string").parquet(f"{o.out}/blocks")).write.mode("overwrite").parquet(f"{o.out}/errors")


def curate(spark: SparkSession, o: argparse.Namespace) -> None:
    """Person XML (as files or packed) or NDJSON to fact_affiliation, dim_person, dim_org_raw and value frequencies."""
    aff = readers.read_affiliation_ndjson(spark, o.source) if o.ndjson else readers.read_packed_xml(spark, f"{o.source}/blocks") if o.packed else readers.read_person_xml(spark, o.source)
    fact = K.with_lineage(K.fact_affiliation(aff), source_version=o.version, ingested_at=o.at)
    writers.write_by_year(fact, f"{o.out}/fact_affiliation")
    fact = spark.read.parquet(f"{o.out}/fact_affiliation")
    writers.write_ordered(K.dim_person(fact), f"{o.out}/dim_person", "person_id")
    writers.write_ordered(K.dim_org_raw(fact), f"{o.out}/dim_org_raw", F.asc_nulls_last("raw_org_key"))
    dim_org = spark.read.parquet(f"{o.out}/dim_org_raw")
    for name in ("organization_country", "organization_city", "organization_name", "role_title"):
        writers.write_ordered(K.value_frequency(fact if name == "role_title" else dim_org, name), f"{o.out}/field_freq/{name}", *writers.by_frequency("cnt", "value"))


def registry(spark: SparkSession, o: argparse.Namespace) -> Store:
    """Nested registry JSON to its flat and derived tables."""
    store = Store(spark, o.out, ingested_at=o.at)
    store.source("registry", o.source)
    raw = store.keep(readers.read_registry_json(spark, o.source), "raw", ("registry",))

    def keep(df: DataFrame, name: str, *needs: str, **metrics: Column) -> DataFrame:
        return store.keep(df, name, needs or ("raw",), [c for c in df.columns if c not in ("types", "lat", "lng")], metrics)

    organization, names = keep(R.registry_organization(raw), "organization"), keep(R.registry_name(raw), "name")
    preferred = keep(R.preferred_name(names), "name_preferred", "name")
    flat = {"link": R.registry_link, "external_id": R.registry_external_id, "location": R.registry_location, "relationship": R.registry_relationship, "domain": R.registry_domain}
    for name, made in flat.items():
        keep(made(raw), name)
    keep(R.registry_org_type(organization), "org_type", "organization")
    keep(R.registry_enriched(organization, preferred), "org_enriched", "organization", "name_preferred", **R.preferred_metrics())
    counts = {f"{name}_rows": store.metrics[name]["rows"] for name in ("organization", "name", *flat, "org_type", "name_preferred")} | {k: store.metrics["org_enriched"][k] for k in R.preferred_metrics()}
    audit = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))
    K.with_lineage(R.with_preferred_percent(audit), ingested_at=o.at).write.mode("overwrite").parquet(f"{o.out}/audit")
    return store


def resolve(spark: SparkSession, o: argparse.Namespace) -> Store:
    """Curated tables to resolved cities, organizations and role titles, with the tables of every stage and audits."""
    store = Store(spark, o.out, decided_at=o.at)
    paths = {"dim_org_raw": f"{o.source}/dim_org_raw", "fact_affiliation": f"{o.source}/fact_affiliation", "iso": o.iso, "territories": o.territories, "gazetteer": o.gazetteer, "ringgold": o.ringgold, "roles": o.roles} | {t: f"{o.registry}/{t}" for t in ("external_id", "name_preferred", "location")}
    for name, path in paths.items():
        store.source(name, path)
    table = lambda name: spark.read.parquet(paths[name])
    dim_org = table("dim_org_raw")
    iso, terr = readers.read_country_lookups(spark, o.iso, o.territories)
    by_country = writers.by_place("organization_country_iso2", "organization_country_raw")
    cmap = store.keep(country_map(K.weighted_distinct(dim_org, "organization_country"), iso, terr), "country", ("dim_org_raw", "iso", "territories"), by_country, K.normalization_metrics("cnt", "organization_country_iso2"))
    by_city = writers.by_place("organization_country_iso2", "organization_city_norm", "organization_city_raw", "organization_country_raw")
    cities = store.keep(K.city_text(dim_org, cmap), "city_names", ("dim_org_raw", "country"), by_city, K.normalization_metrics("pair_cnt", "organization_city_norm"))
    found = resolve_cities(cities, table("gazetteer"), store.keep)
    by_name = writers.by_place("organization_country_iso2", "organization_name_norm", "organization_name_raw", "organization_city_raw", "organization_country_raw")
    org_text = store.keep(K.org_text(dim_org, cmap, found.cities, dedupe_city=True), "org_text", ("dim_org_raw", "country", "city_text"), by_name, K.normalization_metrics("pair_cnt", "organization_name_norm"))
    ring = readers.read_tsv_lenient(spark, o.ringgold, RINGGOLD)
    orgs = resolve_orgs(org_text, dim_org, cmap, table("external_id"), ring, table("name_preferred"), table("location"), lambda: found.best, keep=store.keep)
    for made in (found.all, found.best, found.left_fuzzy, orgs.candidates, orgs.exact_candidates, orgs.best, orgs.best_by_source, orgs.left_fuzzy):
        made.schema  # noqa: B018  builds the stage
    titles = store.keep(K.role_title_text(table("fact_affiliation")), "role_title_text", ("fact_affiliation",), writers.by_frequency("pair_cnt", "role_title_raw"), K.normalization_metrics("pair_cnt", "role_title_norm"))
    mapped = store.keep(roles.role_title_map(readers.read_tsv_skip(spark, o.roles, ROLE_MAP)), "role_title_map", ("roles",), ["role_title_norm"])
    matched, counts = roles.role_title_metrics(roles.match_role_title(titles, mapped))
    store.keep(matched, "role_title_match", ("role_title_text", "role_title_map"), writers.by_frequency("pair_cnt", "role_title_raw"), counts, hidden=("_first",))
    known = lambda name, columns: spark.createDataFrame([tuple(store.metrics[name][c] for c in columns)], ", ".join(f"{c} long" for c in columns))
    norm = {"country": "country", "city_text": "city_names", "org_text": "org_text", "role_title_text": "role_title_text"}
    audits = {k: K.with_mapped_percent(known(t, K.normalization_metrics("pair_cnt", "x"))) for k, t in norm.items()} | {"role_title": roles.with_matched_percent(known("role_title_match", counts))}
    audits |= {f"city_{k}": v for k, v in found.known_audits(store).items()} | {f"org_{k}": v for k, v in orgs.known_audits(store).items()}
    for name, df in audits.items():
        K.with_lineage(df, decided_at=o.at).write.mode("overwrite").parquet(f"{o.out}/audit/{name}")
    return store


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> Store | None:
    p = argparse.ArgumentParser()
    p.add_argument("job", choices=["pack", "curate", "registry", "resolve"])
    p.add_argument("--in", dest="source", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--at", required=True, help="time of the decision, kept as text")
    p.add_argument("--version", default="")
    p.add_argument("--ndjson", action="store_true")
    p.add_argument("--packed", action="store_true")
    for name in ("iso", "territories", "gazetteer", "registry", "ringgold", "roles"):
        p.add_argument(f"--{name}")
    o = p.parse_args(args)
    return {"pack": pack, "curate": curate, "registry": registry, "resolve": resolve}[o.job](spark or SparkSession.builder.appName(o.job).getOrCreate(), o)


if __name__ == "__main__":
    main()

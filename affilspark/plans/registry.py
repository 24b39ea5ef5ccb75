"""Registered queries over the test tables and their DuckDB oracles."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affilspark.functions.country import country_map
from affilspark.functions.text import first_token, norm_text, partial_date, token_overlap, token_set, year_dir
from affilspark.operators import cities as C
from affilspark.operators import curate as K
from affilspark.operators import orgs as O
from affilspark.operators import registry as R
from affilspark.operators import roles
from affilspark.operators.matching import unmatched
from affilspark.plans.fixtures import view
from affilspark.plans.oracle import ORACLES
from affilspark.plans.workflow import CityResolution, OrgResolution, resolve_cities, resolve_orgs, stage
from affilspark.sources import readers, writers
from affilspark.sources.schemas import RINGGOLD, ROLE_MAP

__all__ = ["ORACLES", "QUERIES"]
SKIPPED = [c.split(" ")[0] for c in ROLE_MAP.split(", ")]


class Inputs:
    """The library's inputs over one folder of test tables; each attribute is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def fact(self) -> DataFrame:
        return K.fact_affiliation(self.aff)

    @property
    def dim_org(self) -> DataFrame:
        return K.dim_org_raw(self.aff)

    @property
    def cmap(self) -> DataFrame:
        return country_map(K.weighted_distinct(self.dim_org, "organization_country"), self.iso, self.terr)

    @property
    def cities(self) -> DataFrame:
        return K.city_text(self.dim_org, self.cmap)

    @property
    def orgs(self) -> DataFrame:
        return K.org_text(self.dim_org, self.cmap, self.cities, dedupe_city=True)

    @property
    def titles(self) -> DataFrame:
        return K.role_title_text(self.aff)

    @property
    def raw_registry(self) -> DataFrame:
        """Nested records as a registry delivers them, from the flat views."""
        names = self.reg_name.groupBy("id").agg(F.collect_list(F.struct("value", "lang", F.array("type").alias("types"))).alias("names"))
        ids = self.reg_ext.groupBy("id").agg(F.collect_list(F.struct("type", F.lit(None).cast("string").alias("preferred"), F.array("value").alias("all"))).alias("external_ids"))
        n = F.col("geonames_id").cast("int")
        host = F.concat(F.lit("n"), "geonames_id", F.lit(".example.org"))
        stamp = lambda date, version: F.struct(date.alias("date"), version.alias("schema_version"))
        none = F.lit(None).cast("string")
        base = self.reg_loc.select(
            "id", F.lit("active").alias("status"), F.when(n % 3 == 0, F.array(F.lit("education"), F.lit("funder"))).otherwise(F.array(F.lit("funder"))).alias("types"), (1900 + n % 100).cast("int").alias("established"),
            F.struct(stamp(F.lit("2020-01-01"), F.lit("1.0")).alias("created"), stamp(F.when(n % 2 == 0, F.lit("2024-02-03")), none).alias("last_modified")).alias("admin"),
            F.array(F.struct(F.lit("website").alias("type"), F.concat(F.lit("https://"), host).alias("value"))).alias("links"),
            F.array(F.struct(n.cast("long").alias("geonames_id"), F.struct("country_code", none.alias("country_subdivision_code"), (n / 100).cast("string").alias("lat"), F.lit("north").alias("lng"), F.col("city_name").alias("name")).alias("geonames_details"))).alias("locations"),
            F.array(F.struct(F.lit("parent").alias("type"), F.col("city_name").alias("label"), none.alias("id"))).alias("relationships"),
            F.array(F.concat(F.lit('"N'), "geonames_id", F.lit('.Example.ORG"'))).alias("domains"),
        )
        return base.join(names, "id", "left").join(ids, "id", "left")

    @cached_property
    def resolved_cities(self) -> CityResolution:
        return resolve_cities(self.cities, self.gaz, stage)

    @cached_property
    def resolved_orgs(self) -> OrgResolution:
        dim_org = stage(self.dim_org)
        cmap = stage(country_map(K.weighted_distinct(dim_org, "organization_country"), self.iso, self.terr))
        cities = stage(K.city_text(dim_org, cmap))
        orgs = K.org_text(dim_org, cmap, cities, dedupe_city=True)
        names = R.preferred_name(self.reg_name)
        return resolve_orgs(orgs, dim_org, cmap, self.reg_ext, self.ring, names, self.reg_loc, lambda: resolve_cities(cities, self.gaz, stage).best, keep=stage)


def _registry_audit(x: Inputs) -> DataFrame:
    raw = stage(x.raw_registry)
    organization, names = R.registry_organization(raw), R.registry_name(raw)
    preferred = R.preferred_name(names)
    tables = {"name": names, "name_preferred": preferred, "org_type": R.registry_org_type(organization), "relationship": R.registry_relationship(raw), "external_id": R.registry_external_id(raw), "domain": R.registry_domain(raw), "location": R.registry_location(raw)}
    return R.registry_audit(organization, R.registry_enriched(organization, preferred), **tables)


def _tokens_documents(x: Inputs) -> DataFrame:
    """Tokens of each document and the benchmark item that shares most of them, among those with its first token."""
    side = lambda name, key: x.table(name).select(key, norm_text("text", empty_to_null=False).alias("t")).select(key, token_set("t").alias("toks"), first_token("t").alias("first_tok"))
    docs, items = side("documents", "doc_id"), side("benchmark", "item_id").withColumnRenamed("toks", "i_toks")
    shared, size, conf = token_overlap(F.col("toks"), F.col("i_toks"))
    pairs = docs.where("first_tok <> ''").join(items, "first_tok").select("doc_id", "item_id", shared.cast("long").alias("n"), conf.alias("conf"))
    best = pairs.groupBy("doc_id").agg(F.count("*").alias("items"), F.min(F.struct((-F.col("n")).alias("n"), "item_id", "conf")).alias("b"))
    best = best.select("doc_id", "items", "b.item_id", (-F.col("b.n")).alias("inter_sz"), F.col("b.conf").alias("confidence"))
    return docs.select("doc_id", F.size("toks").cast("long").alias("n_tokens")).join(best, "doc_id", "left").fillna(0, ["items", "inter_sz", "confidence"])


def _folder(spark: SparkSession) -> str:
    """A new folder in the shared one of spark.checkpoint.dir (a temporary one on one machine)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
    return f"{base}/round-trip-{uuid.uuid4().hex}"


def _person_xml(x: Inputs) -> DataFrame:
    """A record per person, rendered from the affiliations and parsed again."""
    tag = lambda name, c: F.coalesce(F.concat(F.lit(f"<c:{name}>"), c, F.lit(f"</c:{name}>")), F.lit(""))
    text = lambda name, c: tag(name, F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")))
    part = lambda name, c, at, n: tag(name, F.nullif(F.substring(c, at, n), F.lit("0" * n)))
    date = lambda name, c: F.when(F.col(c).isNotNull(), tag(name, F.concat(part("year", c, 1, 4), part("month", c, 6, 2), part("day", c, 9, 2)))).otherwise("")
    known = F.when(F.col("disambiguation_source").isNotNull(), tag("disambiguated-organization", F.concat(text("disambiguated-organization-identifier", "disambiguated_organization_identifier"), text("disambiguation-source", "disambiguation_source")))).otherwise("")
    place = tag("address", F.concat(text("city", "organization_city"), text("country", "organization_country")))
    body = F.concat(text("role-title", "role_title"), text("department-name", "department_name"), date("start-date", "start_date"), date("end-date", "end_date"), tag("organization", F.concat(text("name", "organization_name"), place, known)))
    one = lambda kind: F.array_join(F.collect_list(F.when(F.col("affiliation_type") == kind, F.concat(F.lit(f"<c:affiliation-group><c:{kind}-summary>"), body, F.lit(f"</c:{kind}-summary></c:affiliation-group>")))), "")
    people = x.aff.groupBy("orcid", "given_names", "family_name").agg(one("education").alias("edu"), one("employment").alias("emp"))
    name = tag("person", tag("name", F.concat(text("given-names", "given_names"), text("family-name", "family_name"))))
    record = F.concat(F.lit('<r:record xmlns:r="http://x/r" xmlns:c="http://x/c">'), tag("orcid-identifier", text("path", "orcid")), name, tag("activities-summary", F.concat(tag("educations", F.col("edu")), tag("employments", F.col("emp")))), F.lit("</r:record>"))
    return readers.parse_person_xml(people.select(record.alias("value")))


def _ndjson(x: Inputs) -> DataFrame:
    path = _folder(x.spark)
    writers.write_ndjson(x.aff, path)
    return readers.read_affiliation_ndjson(x.spark, path)


def _by_year(x: Inputs) -> DataFrame:
    path = _folder(x.spark)
    writers.write_by_year(x.fact.select("orcid", "start_date", "start_year"), path)
    got = x.spark.read.schema("orcid string, start_date string, start_year int, year_dir string").parquet(path)
    return got.select("orcid", "start_date", "start_year", "year_dir")


def _ordered(x: Inputs) -> DataFrame:
    """Value frequencies, written in order and read back with their places."""
    path = _folder(x.spark)
    writers.write_ordered(K.value_frequency(x.dim_org, "organization_city"), path, *writers.by_frequency("cnt", "value"), max_records=50)
    return readers.read_ordered(x.spark, path)


def _places(x: Inputs) -> DataFrame:
    """Cities by code (null as ZZ) and text, with their places; raw values break ties."""
    path = _folder(x.spark)
    cities = x.cities.drop("pair_cnt")
    order = writers.by_place("organization_country_iso2", "organization_city_norm", "organization_city_raw", "organization_country_raw")
    writers.write_ordered(cities, path, *order, F.col("organization_city_raw").isNull(), max_records=500)
    return readers.read_ordered(x.spark, path)


def _one_file_each(lines: DataFrame, begin: str, between: str, end: str, path: str) -> None:
    """Texts of lines(bucket, line) to a file for each bucket."""
    whole = lines.groupBy("bucket").agg(F.array_join(F.collect_list("line"), between).alias("all"))
    whole.select(F.concat(F.lit(begin), "all", F.lit(end))).write.option("maxRecordsPerFile", 1).text(path)


def _lenient_tsv(x: Inputs) -> DataFrame:
    """Files with a header of other names, rows that are too short and, to be dropped, too long."""
    path, n = _folder(x.spark), F.col("ringgold").cast("long")
    line = F.concat_ws("\t", "ringgold", "isni", F.when(n % 3 != 0, F.col("name")).when(n % 7 == 0, ""), F.when(n % 7 == 0, F.repeat(F.lit("x\t"), 10)))
    _one_file_each(x.ring.select((n % 4).alias("bucket"), line.alias("line")), "Ringgold ID\tISNI\tName\n", "\n", "", path)
    return readers.read_tsv_lenient(x.spark, path, RINGGOLD).select("ringgold", "isni", "name")


def _registry_json(x: Inputs) -> DataFrame:
    path = _folder(x.spark)
    _one_file_each(x.raw_registry.select(F.pmod(F.xxhash64("id"), F.lit(16)).alias("bucket"), F.to_json(F.struct("*")).alias("line")), "[", ",", "]", path)
    return R.registry_name(readers.read_registry_json(x.spark, path))


def _skipping_tsv(x: Inputs) -> DataFrame:
    """Title maps of at most 500 rows a file, with two lines before the rows; '' is null and rows are numbered in each file."""
    path, at = _folder(x.spark), F.col("src_rownum").cast("long")
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SKIPPED])
    files = x.rolemap.groupBy(F.floor(at / 500).alias("bucket")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at.alias("n"), line.alias("line")))), lambda r: r["line"]), "\n").alias("all"))
    files.select(F.concat(F.lit("titles\nof a file\n"), "all")).write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_tsv_skip(x.spark, path, ROLE_MAP)


def _lookups(x: Inputs) -> DataFrame:
    """Codes and territories as the lookup files hold them, one row for each nation and customer."""
    path, tsv = _folder(x.spark), lambda df, name: df.write.option("sep", "\t").option("header", True).csv(name)
    spaced = F.replace(F.replace(F.lower("c_name"), F.lit("#"), F.lit(" no\u2003 ")), F.lit("c"), F.lit("\uff43"))
    tsv(x.table("nation").select(F.when(F.col("n_nationkey") == 3, "NA").otherwise(F.lower(F.substring("n_name", 1, 2))).alias("alpha2")), f"{path}/iso")
    tsv(x.table("customer").select(spaced.alias("from"), F.lower(F.substring("c_mktsegment", 1, 2)).alias("alpha2")), f"{path}/territories")
    iso, territories = readers.read_country_lookups(x.spark, f"{path}/iso", f"{path}/territories")
    return iso.select(F.lit(None).cast("string").alias("from"), "alpha2").unionByName(territories)


def _without_lists(x: Inputs) -> DataFrame:
    """Identifier stages where the registry's lists do not exist yet: only direct identifiers are left."""
    missing = lambda name, schema: readers.read_if_exists(x.spark, f"{x.sf_dir}/absent/{name}.parquet", schema)
    dim_org = stage(x.dim_org)
    cmap = stage(country_map(K.weighted_distinct(dim_org, "organization_country"), x.iso, x.terr))
    orgs = K.org_text(dim_org, cmap, K.city_text(dim_org, cmap), dedupe_city=True)
    ids, ring = missing("external_id", "id string, type string, value string"), missing("ringgold", RINGGOLD)
    names = missing("name", "id string, preferred_name string")
    return resolve_orgs(orgs, dim_org, cmap, ids, ring, names, x.reg_loc, lambda: None, keep=stage).merged


def _partial_dates(x: Inputs) -> DataFrame:
    part = lambda f, n: F.when((F.col("event_id") % 7 != 0) & (F.col("event_id") % n != 0), f("ts").cast("string"))
    return x.table("events").select("event_id", partial_date(part(F.year, 7), part(F.month, 5), part(F.dayofmonth, 3)).alias("partial"))


def _united(frames) -> DataFrame:
    first, *rest = frames
    for f in rest:
        first = first.unionByName(f)
    return first


def _organization(x: Inputs) -> DataFrame:
    out = R.registry_organization(x.raw_registry)
    return out.withColumn("types", F.array_join("types", "|")).withColumn("geonames_id", F.regexp_extract("id", "([0-9]+)$", 1))


_PLANS: dict[str, Callable[[Inputs], DataFrame]] = {
    "fact_affiliation": lambda x: x.fact,
    "year_layout_counts": lambda x: K.weighted_distinct(x.fact.select(year_dir("start_year").alias("year_dir")), "year_dir"),
    "dim_person": lambda x: K.dim_person(x.fact),
    "dim_org_raw": lambda x: x.dim_org,
    "freq_country": lambda x: K.value_frequency(x.dim_org, "organization_country"),
    "freq_city": lambda x: K.value_frequency(x.dim_org, "organization_city"),
    "freq_org_name": lambda x: K.value_frequency(x.dim_org, "organization_name"),
    "freq_role_title": lambda x: K.value_frequency(x.fact, "role_title"),
    "country_map": lambda x: x.cmap,
    "country_audit": lambda x: K.normalization_audit(x.cmap, "cnt", "organization_country_iso2"),
    "city_text": lambda x: x.cities,
    "city_text_audit": lambda x: K.normalization_audit(x.cities, "pair_cnt", "organization_city_norm"),
    "org_text": lambda x: K.org_text(x.dim_org, x.cmap, x.cities),
    "org_text_audit": lambda x: K.normalization_audit(K.org_text(x.dim_org, x.cmap, x.cities), "pair_cnt", "organization_name_norm"),
    "role_title_text": lambda x: x.titles,
    "role_title_text_audit": lambda x: K.normalization_audit(x.titles, "pair_cnt", "role_title_norm"),
    "city_match_exact": lambda x: C.match_exact(C.city_rows(x.cities), x.gaz),
    "city_unmatched_exact": lambda x: unmatched(C.city_rows(x.cities), C.match_exact(C.city_rows(x.cities), x.gaz), "city_row_id").select(*C.CITY),
    "city_match_alias": lambda x: x.resolved_cities.alias,
    "city_match_fuzzy": lambda x: x.resolved_cities.fuzzy,
    "city_all": lambda x: x.resolved_cities.all,
    "city_best": lambda x: x.resolved_cities.best,
    "city_coverage": lambda x: _united(x.resolved_cities.audits.values()),
    "registry_name": lambda x: R.registry_name(x.raw_registry),
    "registry_external_id": lambda x: R.registry_external_id(x.raw_registry),
    "registry_location": lambda x: R.registry_location(x.raw_registry),
    "registry_domain": lambda x: R.registry_domain(x.raw_registry),
    "registry_link": lambda x: R.registry_link(x.raw_registry),
    "registry_relationship": lambda x: R.registry_relationship(x.raw_registry),
    "registry_organization": _organization,
    "registry_org_type": lambda x: R.registry_org_type(R.registry_organization(x.raw_registry)),
    "registry_preferred_name": lambda x: R.preferred_name(R.registry_name(x.raw_registry)),
    "registry_enriched": lambda x: R.registry_enriched(R.registry_organization(x.raw_registry), R.preferred_name(R.registry_name(x.raw_registry))),
    "registry_audit": _registry_audit,
    "org_match_fundref": lambda x: x.resolved_orgs.fundref,
    "org_match_grid": lambda x: x.resolved_orgs.grid,
    "org_match_direct": lambda x: x.resolved_orgs.ror,
    "org_match_ringgold": lambda x: x.resolved_orgs.ringgold_isni,
    "org_merge_ids": lambda x: x.resolved_orgs.merged,
    "org_unmatched_ids": lambda x: x.resolved_orgs.left_ids.select(*O.ORG),
    "org_match_name_exact": lambda x: x.resolved_orgs.ror_geo_exact,
    "org_match_fuzzy": lambda x: x.resolved_orgs.ror_geo_fuzzy,
    "org_best": lambda x: x.resolved_orgs.best,
    "org_best_by_source": lambda x: x.resolved_orgs.best_by_source,
    "org_coverage": lambda x: _united(v for k, v in x.resolved_orgs.audits.items() if k != "by_source"),
    "org_coverage_by_source": lambda x: x.resolved_orgs.audits["by_source"],
    "role_title_map": lambda x: roles.role_title_map(x.rolemap),
    "role_title_match": lambda x: roles.match_role_title(x.titles, roles.role_title_map(x.rolemap)),
    "role_title_audit": lambda x: roles.role_title_audit(roles.match_role_title(x.titles, roles.role_title_map(x.rolemap))),
    "tokens_documents": _tokens_documents,
    "person_xml": _person_xml,
    "ndjson_round_trip": _ndjson,
    "year_round_trip": _by_year,
    "ordered_round_trip": _ordered,
    "city_places": _places,
    "lenient_tsv": _lenient_tsv,
    "registry_json": _registry_json,
    "skipping_tsv": _skipping_tsv,
    "country_lookups": _lookups,
    "org_merge_without_lists": _without_lists,
    "person_lineage": lambda x: K.with_lineage(K.dim_person(x.fact), source_version="2025_10", ingested_at="2025-11-14T00:00:00Z"),
    "partial_dates": _partial_dates,
}


def _run(plan: Callable[[Inputs], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan(Inputs(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: partial(_run, plan) for name, plan in _PLANS.items()}

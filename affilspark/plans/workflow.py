"""The city and organization waterfalls: each stage sees what earlier ones left unmatched.

Stages are lazy: asking for one builds it and what it needs, once. `keep(df, name, needs, ...)` is applied to
each table: as_is() leaves it a plan, stage() checkpoints those that several stages read, and a Store writes
every one with its manifest and gathers the counts of the audits as it writes.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affilspark.operators import cities as C
from affilspark.operators import orgs as O
from affilspark.operators.matching import covered, covered_by_source, coverage_audit, coverage_by_source, union_matches, unmatched
from affilspark.plans.store import Store
from affilspark.sources.writers import by_candidate, by_place

Keep = Callable[..., DataFrame]
#: Identifier sources whose ids the registry lists, and those reached through another list.
LISTED, CHAINED = ("fundref", "grid", "ror"), ("ringgold_isni",)


def stage(df: DataFrame, name: str = "", needs: tuple = (), *, light: bool = False, hidden: tuple = (), **_) -> DataFrame:
    """df, written to the folder of spark.checkpoint.dir (a temporary one only where that is unset and all runs on one machine)."""
    if light:
        return df.drop(*hidden)
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return df.drop(*hidden).checkpoint()


def as_is(df: DataFrame, name: str = "", needs: tuple = (), *, hidden: tuple = (), **_) -> DataFrame:
    return df.drop(*hidden)


def _weighed() -> dict[str, Column]:
    return {"weight": F.coalesce(F.sum("pair_cnt"), F.lit(0))}


def _by_source(*sources: str) -> dict[str, Column]:
    """Rows and weight of each match source, and of all."""
    own = lambda s: F.col("match_source") == s
    out = {f"{s}_{k}": F.coalesce(F.sum(F.when(own(s), x)), F.lit(0)) for s in sources for k, x in (("rows", F.lit(1)), ("weight", F.col("pair_cnt")))}
    return out | _weighed()


class CityResolution:
    """Exact names, aliases, then shared tokens, of city_text rows against a gazetteer."""

    def __init__(self, cities: DataFrame, gaz: DataFrame, keep: Keep = as_is):
        self.cities, self.gaz = keep(cities, "city_text", ("city_names",), order=by_place("organization_country_iso2", "organization_city_norm", "organization_city_raw", "organization_country_raw"), metrics=_weighed()), gaz
        self._keep = keep

    def keep(self, df: DataFrame, name: str, *needs: str, light: bool = False) -> DataFrame:
        order = [*by_place("organization_country_iso2", "organization_city_norm", "organization_city_raw"), "city_row_id", *(["match_rule", "geoname_id"] if "geoname_id" in df.columns else [])]
        return self._keep(df, name, ("city_text", *needs), order=order, metrics=_weighed(), light=light)

    @cached_property
    def rows(self) -> DataFrame:
        return C.city_rows(self.cities)

    @cached_property
    def exact(self) -> DataFrame:
        return self.keep(C.match_exact(self.rows, self.gaz), "city_exact", "gazetteer")

    @cached_property
    def left_exact(self) -> DataFrame:
        return self.keep(unmatched(self.rows, self.exact, "city_row_id"), "city_left_exact", "city_exact")

    @cached_property
    def alias(self) -> DataFrame:
        return self.keep(C.match_alias(self.left_exact, self.gaz), "city_alias", "city_left_exact", "gazetteer")

    @cached_property
    def left_alias(self) -> DataFrame:
        return self.keep(unmatched(self.left_exact, self.alias, "city_row_id"), "city_left_alias", "city_left_exact", "city_alias")

    @cached_property
    def fuzzy(self) -> DataFrame:
        return self.keep(C.match_tokens_first(self.left_alias, self.gaz), "city_fuzzy", "city_left_alias", "gazetteer")

    @cached_property
    def left_fuzzy(self) -> DataFrame:
        return self.keep(unmatched(self.left_alias, self.fuzzy, "city_row_id"), "city_unmatched", "city_left_alias", "city_fuzzy", light=True)

    @cached_property
    def all(self) -> DataFrame:
        """Every match of every stage, with summed weights."""
        return self.keep(C.attach_weight(union_matches(self.exact, self.alias, self.fuzzy), C.city_weights(self.cities)), "city_all", "city_exact", "city_alias", "city_fuzzy", light=True)

    @cached_property
    def best(self) -> DataFrame:
        """One match per city, with summed weights."""
        return self.keep(C.attach_weight(C.best_city(self.exact, self.alias, self.fuzzy), C.city_weights(self.cities)), "city_best", "city_exact", "city_alias", "city_fuzzy", light=True)

    @cached_property
    def audits(self) -> dict[str, DataFrame]:
        """Coverage after each stage (1 to 3, cumulative) and of the merged table (4)."""
        steps = {"exact": (self.exact,), "alias": (self.exact, self.alias), "fuzzy": (self.exact, self.alias, self.fuzzy), "best": (self.best,)}
        return {k: coverage_audit(self.rows, union_matches(*m), "city_row_id", "pair_cnt", i) for i, (k, m) in enumerate(steps.items(), 1)}

    def known_audits(self, store: Store) -> dict[str, DataFrame]:
        """audits() from what the store counted while it wrote: matched is what was there less what is left."""
        _ = self.left_exact, self.left_alias, self.left_fuzzy, self.best
        m = store.metrics
        total = m["city_text"]["rows"], m["city_text"]["weight"]
        left = {k: m[t] for k, t in (("exact", "city_left_exact"), ("alias", "city_left_alias"), ("fuzzy", "city_unmatched"))}
        got = {k: (total[0] - x["rows"], total[1] - x["weight"]) for k, x in left.items()} | {"best": (m["city_best"]["rows"], m["city_best"]["weight"])}
        return {k: covered(self.cities.sparkSession, (i, *total, *x)) for i, (k, x) in enumerate(got.items(), 1)}


class OrgResolution:
    """Identifiers, chained identifiers, exact names, then tokens within a city.

    orgs should hold distinct rows (org_text with dedupe_city). A stage with nothing pending or nothing
    found gives empty tables of its columns, and earlier results pass through. city_best is a function,
    as the earlier stages do not need it.
    """

    def __init__(self, orgs: DataFrame, dim_org: DataFrame, cmap: DataFrame, external_ids: DataFrame, ringgold: DataFrame, names: DataFrame, locations: DataFrame, city_best: Callable[[], DataFrame], keep: Keep = as_is):
        self._keep = keep
        self.rows = keep(O.org_rows(orgs), "org_rows", ("org_text",), order=[*by_place("organization_country_iso2", "organization_name_norm", "organization_name_raw"), "org_row_id"], metrics=_weighed())
        self.dim_org, self.cmap, self.external_ids, self.ringgold = dim_org, cmap, external_ids, ringgold
        self.names, self.locations, self._city_best = names, locations, city_best

    def keep(self, df: DataFrame, name: str, *needs: str, sources: tuple[str, ...] = (), light: bool = False) -> DataFrame:
        order = by_candidate("org_row_id", *[c for c in ("match_priority", "ror_id", "match_source", "source_value_norm", "city_geoname_id") if c in df.columns])
        return self._keep(df, name, ("org_rows", *needs), order=order, metrics=_by_source(*sources) if sources else _weighed(), light=light)

    @cached_property
    def signals(self) -> DataFrame:
        found = O.org_signals(self.rows, self.dim_org, self.cmap, "fundref", "grid", "ror", "ringgold")
        return self._keep(found, "org_signals", ("org_rows", "dim_org_raw", "country"), order=by_candidate("org_row_id", "source", "source_value_norm"))

    @cached_property
    def candidates(self) -> DataFrame:
        """Every match by an identifier."""
        walks = (O.match_crosswalk(self.signals, self.external_ids, "fundref", 1), O.match_crosswalk(self.signals, self.external_ids, "grid", 2))
        found = union_matches(*walks, O.match_direct(self.signals), O.match_chain(self.signals, self.ringgold, self.external_ids), columns=O.MATCH)
        return self.keep(found, "org_candidates", "org_signals", "external_id", "ringgold", light=True)

    @cached_property
    def by_id(self) -> DataFrame:
        """The best match of each identifier source; one table, as merging, the last union and the audits read it.

        It is not taken from the candidates, whose number grows with that of identifiers times that of ids they lead to.
        """
        raw = O.raw_identifiers(self.dim_org, self.cmap, "fundref", "grid", "ror", "ringgold")
        found = O.match_least_ids(self.rows, raw, self.ringgold, self.external_ids)
        return self.keep(O.best_of_sources(found), "org_by_id", "dim_org_raw", "country", "external_id", "ringgold", sources=(*LISTED, *CHAINED))

    @cached_property
    def fundref(self) -> DataFrame:
        return self.by_id.where("match_source = 'fundref'")

    @cached_property
    def grid(self) -> DataFrame:
        return self.by_id.where("match_source = 'grid'")

    @cached_property
    def ror(self) -> DataFrame:
        return self.by_id.where("match_source = 'ror'")

    @cached_property
    def ringgold_isni(self) -> DataFrame:
        return self.by_id.where("match_source = 'ringgold_isni'")

    @cached_property
    def merged(self) -> DataFrame:
        return self.keep(O.merge_sources(self.by_id), "org_merged", "org_by_id", sources=(*LISTED, *CHAINED))

    @cached_property
    def left_ids(self) -> DataFrame:
        return self.keep(unmatched(self.rows, self.merged, "org_row_id"), "org_left_ids", "org_merged")

    @cached_property
    def exact_candidates(self) -> DataFrame:
        return self.keep(O.match_org_exact(self.left_ids, self.names, self.locations), "org_exact_candidates", "org_left_ids", "name_preferred", "location", light=True)

    @cached_property
    def ror_geo_exact(self) -> DataFrame:
        found = O.match_org_exact(self.left_ids, self.names, self.locations, True)
        return self.keep(O.best_match(found), "org_exact", "org_left_ids", "name_preferred", "location")

    @cached_property
    def left_exact(self) -> DataFrame:
        return self.keep(unmatched(self.left_ids, self.ror_geo_exact, "org_row_id"), "org_left_exact", "org_left_ids", "org_exact")

    @cached_property
    def in_cities(self) -> DataFrame:
        """What is left, with the cities it is in."""
        return self.keep(O.org_city_geo(self.left_exact, self.dim_org, self.cmap, self._city_best()), "org_in_cities", "org_left_exact", "dim_org_raw", "country", "city_best")

    @cached_property
    def ror_geo_fuzzy(self) -> DataFrame:
        return self.keep(O.match_tokens_block(self.in_cities, O.registry_city_names(self.names, self.locations)), "org_fuzzy", "org_in_cities", "name_preferred", "location")

    @cached_property
    def left_fuzzy(self) -> DataFrame:
        return self.keep(unmatched(self.left_exact, self.ror_geo_fuzzy, "org_row_id"), "org_unmatched", "org_left_exact", "org_fuzzy", light=True)

    @cached_property
    def best(self) -> DataFrame:
        """One match per organization over all stages."""
        return self.keep(union_matches(self.merged, self.ror_geo_exact, self.ror_geo_fuzzy, columns=O.MATCH), "org_best", "org_merged", "org_exact", "org_fuzzy", light=True)

    @cached_property
    def best_by_source(self) -> DataFrame:
        return self.keep(O.best_by_source(self.by_id, self.ror_geo_exact, self.ror_geo_fuzzy), "org_best_by_source", "org_by_id", "org_exact", "org_fuzzy", light=True)

    @cached_property
    def audits(self) -> dict[str, DataFrame]:
        """Coverage of stages 1 (direct and listed identifiers) and 2 (chained ones) alone and after stages 3 to 5, and each by source."""
        own = F.col("match_source").isin(*CHAINED)
        two = union_matches(self.merged, self.ror_geo_exact, columns=O.MATCH)
        steps = {"direct_ids": self.by_id.where(~own), "chained_ids": self.by_id.where(own), "ids": self.merged, "exact": two, "fuzzy": self.best}
        out = {k: coverage_audit(self.rows, m, "org_row_id", "pair_cnt", i) for i, (k, m) in enumerate(steps.items(), 1)}
        listed = {1: LISTED, 2: CHAINED}  # stages 1 and 2 also report sources without a match
        named = {i: self.rows.sparkSession.createDataFrame([(x,) for x in names], "match_source string") for i, names in listed.items()}
        tables = [*list(steps.values())[:4], self.best_by_source]
        by_source = [coverage_by_source(t, self.rows, sources=named.get(i), stage=i) for i, t in enumerate(tables, 1)]
        return out | {"by_source": reduce(DataFrame.unionByName, by_source)}

    def known_audits(self, store: Store) -> dict[str, DataFrame]:
        """audits() from what the store counted while it wrote.

        An organization has a listed identifier if its merged match is one, as chained ones come last in the order of sources.
        """
        _ = self.by_id, self.merged, self.ror_geo_exact, self.ror_geo_fuzzy
        spark, m = self.rows.sparkSession, store.metrics
        each, merged, exact, fuzzy = m["org_by_id"], m["org_merged"], m["org_exact"], m["org_fuzzy"]
        total = m["org_rows"]["rows"], m["org_rows"]["weight"]
        of = lambda table, s: (table[f"{s}_rows"], table[f"{s}_weight"])
        added = lambda *x: tuple(map(sum, zip(*x, strict=True)))
        whole = lambda table: (table["rows"], table["weight"])
        steps = {"direct_ids": added(*[of(merged, s) for s in LISTED]), "chained_ids": added(*[of(each, s) for s in CHAINED]), "ids": whole(merged), "exact": added(whole(merged), whole(exact)), "fuzzy": added(whole(merged), whole(exact), whole(fuzzy))}
        out = {k: covered(spark, (i, *total, *x)) for i, (k, x) in enumerate(steps.items(), 1)}
        late = [("ror_geo_exact", whole(exact)), ("ror_geo_fuzzy", whole(fuzzy))]
        ids = [*LISTED, *CHAINED]
        rows = [(1, s, *of(each, s)) for s in LISTED] + [(2, s, *of(each, s)) for s in CHAINED]
        for i, found in ((3, [(s, of(merged, s)) for s in ids]), (4, [*((s, of(merged, s)) for s in ids), late[0]]), (5, [*((s, of(each, s)) for s in ids), *late])):
            rows += [(i, s, *x) for s, x in found if x[0]]
        return out | {"by_source": covered_by_source(spark, total[1], rows)}


def resolve_cities(cities: DataFrame, gaz: DataFrame, keep: Keep = as_is) -> CityResolution:
    return CityResolution(cities, gaz, keep)


def resolve_orgs(*tables, keep: Keep = as_is) -> OrgResolution:
    return OrgResolution(*tables, keep=keep)

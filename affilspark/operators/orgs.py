"""Organization resolution against a registry: identifiers, chained identifiers, exact names, city-blocked tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affilspark.functions.text import norm_isni, norm_text, org_identifier, row_key, token_overlap, token_set, trim
from affilspark.operators.curate import attach_country, is_filled
from affilspark.operators.matching import best_per_key, restrict, union_matches
from affilspark.operators.registry import crosswalk

ORG = ["org_row_id", "organization_name_raw", "organization_name_norm", "organization_country_iso2", "pair_cnt"]
MATCH = [*ORG, "ror_id", "match_source", "source_value_norm", "match_priority", "confidence", "match_rule"]
BY_SOURCE = [*ORG, "ror_id", "inter_sz", "org_len", *MATCH[6:]]
BLOCK = ["organization_country_iso2", "city_geoname_id"]
#: Order of identifier sources when they disagree.
SOURCE_ORDER = ("ror", "fundref", "grid", "ringgold_isni")


def org_rows(orgs: DataFrame) -> DataFrame:
    """org_text with org_row_id, a key of the raw country, city and name."""
    return orgs.withColumn("org_row_id", row_key("organization_country_raw", "organization_city_raw", "organization_name_raw")).select(*ORG)


def raw_identifiers(dim_org: DataFrame, cmap: DataFrame, *sources: str) -> DataFrame:
    """Country code, name, source and comparable identifier of each raw row of those sources."""
    raw = attach_country(dim_org.where(F.lower("disambiguation_source").isin(*sources)), cmap, "organization_country")
    return raw.select(
        "organization_country_iso2", F.col("organization_name").alias("organization_name_raw"), F.lower("disambiguation_source").alias("source"),
        org_identifier("disambiguation_source", F.coalesce("disambiguated_organization_identifier", F.lit(""))).alias("source_value_norm"),
    )


def org_signals(orgs: DataFrame, dim_org: DataFrame, cmap: DataFrame, *sources: str) -> DataFrame:
    """Organizations with the distinct identifiers that raw rows of the same country code and name carry."""
    return orgs.join(raw_identifiers(dim_org, cmap, *sources).distinct(), ["organization_country_iso2", "organization_name_raw"])


def _matched(df: DataFrame, source: str, priority: int, rule: int, confidence: Column | None = None) -> DataFrame:
    return df.withColumns({"match_source": F.lit(source), "match_priority": F.lit(priority), "confidence": F.lit(1.0) if confidence is None else confidence, "match_rule": F.lit(rule)})


def match_crosswalk(signals: DataFrame, external_ids: DataFrame, source: str, priority: int) -> DataFrame:
    """fundref or grid identifiers through the registry's own list of them."""
    walk = crosswalk(external_ids, source).withColumnRenamed("value_norm", "source_value_norm")
    return _matched(signals.where(F.col("source") == source).join(walk, "source_value_norm"), source, priority, 1).select(*MATCH)


def match_direct(signals: DataFrame, drop_empty_ids: bool = False) -> DataFrame:
    """Identifiers that are registry ids; they are not looked up, so an empty one gives an empty id unless dropped."""
    own = signals.where(F.col("source") == "ror").withColumn("ror_id", F.col("source_value_norm"))
    own = own.where("ror_id <> ''") if drop_empty_ids else own
    return _matched(own, "ror", 0, 1).select(*MATCH)


def _hops(ringgold: DataFrame, external_ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ringgold to ISNI, and ISNI to registry id."""
    first = ringgold.where(is_filled("isni")).select(trim(F.col("ringgold").cast("string")).alias("source_value_norm"), norm_isni("isni").alias("isni_norm"))
    return first, external_ids.where((F.lower("type") == "isni") & F.col("value").isNotNull()).select(norm_isni("value").alias("isni_norm"), F.col("id").alias("ror_id"))


def match_chain(signals: DataFrame, ringgold: DataFrame, external_ids: DataFrame) -> DataFrame:
    """ringgold to ISNI to registry id; either hop may fan out."""
    first, second = _hops(ringgold, external_ids)
    hop = first.join(second, "isni_norm").select("source_value_norm", "ror_id").distinct()
    return _matched(signals.where(F.col("source") == "ringgold").join(hop, "source_value_norm"), "ringgold_isni", 3, 1).select(*MATCH)


def match_least_ids(orgs: DataFrame, identifiers: DataFrame, ringgold: DataFrame, external_ids: DataFrame) -> DataFrame:
    """Of match_crosswalk(), match_direct() and match_chain() of the orgs' signals, what best_of_sources() keeps: the least id of each source.

    Organizations of one country code and name share their identifiers, and a source has one priority, so both hops and the
    identifiers of a name are reduced to their least id before organizations are joined: no step has more rows than it
    reads. identifiers: raw_identifiers(), repeats allowed. Of equal ids the one by the least identifier stays.
    """
    first, second = _hops(ringgold, external_ids)
    least = F.min("ror_id").alias("ror_id")
    hop = first.join(second.groupBy("isni_norm").agg(least), "isni_norm").groupBy("source_value_norm").agg(least)
    walks = [crosswalk(external_ids, k).select(F.lit(k).alias("source"), F.col("value_norm").alias("source_value_norm"), "ror_id") for k in ("fundref", "grid")]
    listed = walks[0].unionByName(walks[1]).unionByName(hop.select(F.lit("ringgold").alias("source"), "source_value_norm", "ror_id"))
    own = identifiers.where(F.col("source") == "ror").withColumn("ror_id", F.col("source_value_norm"))
    found = own.unionByName(identifiers.where(F.col("source") != "ror").join(listed, ["source", "source_value_norm"]).select(*own.columns))
    name = ["organization_country_iso2", "organization_name_raw"]
    best = found.groupBy(*name, "source").agg(F.min(F.struct(F.col("ror_id").isNull().alias("no"), "ror_id", "source_value_norm")).alias("b")).select(*name, "source", "b.ror_id", "b.source_value_norm")
    priority = F.when(F.col("source") == "ror", 0).when(F.col("source") == "fundref", 1).when(F.col("source") == "grid", 2).otherwise(3)
    shown = F.when(F.col("source") == "ringgold", "ringgold_isni").otherwise(F.col("source"))
    return orgs.join(best, name).withColumns({"match_source": shown, "match_priority": priority, "confidence": F.lit(1.0), "match_rule": F.lit(1)}).select(*MATCH)


def best_match(matches: DataFrame) -> DataFrame:
    return best_per_key(matches, "org_row_id", F.asc_nulls_last("match_priority"), F.asc_nulls_last("ror_id"))


def best_of_sources(*matches: DataFrame) -> DataFrame:
    """best_match() of each match source, over one shuffle of all of them."""
    return best_per_key(union_matches(*matches, columns=MATCH), ["org_row_id", "match_source"], F.asc_nulls_last("match_priority"), F.asc_nulls_last("ror_id"))


def merge_sources(*bests: DataFrame) -> DataFrame:
    """One match per organization: source order, priority, confidence falling, id."""
    order = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in SOURCE_ORDER]), F.col("match_source")), F.lit(0)), F.lit(9))
    return best_per_key(union_matches(*bests, columns=MATCH), "org_row_id", order, "match_priority", F.desc("confidence"), F.asc_nulls_last("ror_id"))


def match_org_exact(pending: DataFrame, names: DataFrame, locations: DataFrame, least: bool = False) -> DataFrame:
    """Country and preferred registry name; with `least` only the least of the ids that share both, which is what best_match() keeps."""
    name = names.where(is_filled("preferred_name")).select("id", norm_text("preferred_name").alias("organization_name_norm"))
    place = locations.where(is_filled("country_code")).select("id", F.col("country_code").alias("organization_country_iso2")).distinct()
    ref = place.join(name, "id").withColumnRenamed("id", "ror_id").where("organization_name_norm is not null")
    if least:
        ref = ref.groupBy("organization_country_iso2", "organization_name_norm").agg(F.min("ror_id").alias("ror_id"))
    found = pending.join(ref, ["organization_country_iso2", "organization_name_norm"]).withColumn("source_value_norm", F.col("organization_name_norm"))
    return _matched(found, "ror_geo_exact", 4, 2).select(*MATCH)


def org_city_geo(pending: DataFrame, dim_org: DataFrame, cmap: DataFrame, city_best: DataFrame) -> DataFrame:
    """Pending organizations with each resolved city that raw rows of their country code and name have."""
    raw = attach_country(dim_org.where(is_filled("organization_city")), cmap, "organization_country").where("organization_country_iso2 is not null")
    raw = raw.select("organization_country_iso2", F.col("organization_name").alias("organization_name_raw"), F.col("organization_city").alias("organization_city_raw")).distinct()
    city = city_best.where("geoname_id is not null").select("organization_country_iso2", "organization_city_raw", F.col("geoname_id").alias("city_geoname_id")).distinct()
    place = raw.join(city, ["organization_country_iso2", "organization_city_raw"]).select("organization_country_iso2", "organization_name_raw", "city_geoname_id").distinct()
    return pending.where("organization_name_norm is not null").join(place, ["organization_country_iso2", "organization_name_raw"]).select(*ORG, "city_geoname_id").distinct()


def registry_city_names(names: DataFrame, locations: DataFrame) -> DataFrame:
    """Registry ids with country, city and tokens of their preferred name; distinct."""
    place = locations.where("geonames_id is not null and country_code is not null").select("id", F.col("country_code").alias("organization_country_iso2"), F.col("geonames_id").alias("city_geoname_id")).distinct()
    name = names.select("id", token_set(norm_text("preferred_name", trimmed=False, empty_to_null=False)).alias("ror_toks"))
    return place.join(name, "id").withColumnRenamed("id", "ror_id")


def _by_rarity(rows: DataFrame, toks: str, stats: DataFrame, *key: str) -> DataFrame:
    """key, block, and `ts`: the tokens that the block's entries have, rarest first."""
    each = rows.select(*key, *BLOCK, F.explode(toks).alias("tok")).join(stats, [*BLOCK, "tok"])
    return each.groupBy(*key, *BLOCK).agg(F.array_sort(F.collect_list(F.struct("df", "tok", "first_id"))).alias("ts"))


def _prefix_pairs(asked: DataFrame, index: DataFrame) -> DataFrame:
    """Best (more shared tokens, then least id) of the entries that hold one of the asked tokens.

    asked: org, block, m (tokens in ts), tok at place i, need; index: entry, block, tok at place j of r. As both
    sides keep one order, a pair first met at (i, j) shares min(m - i, r - j) tokens at most; it is left out
    where that is under need. A pair met again at a later token was judged at the first.
    """
    met = asked.join(index, [*BLOCK, "tok"]).where(F.least(F.col("m") - F.col("i"), F.col("r") - F.col("j")) >= F.col("need"))
    shared = met.select("org_row_id", "org_len", *BLOCK, "ror_id", F.size(F.array_intersect("mine", "theirs")).alias("inter_sz"))
    best = shared.groupBy("org_row_id", "org_len", *BLOCK).agg(F.min(F.struct((-F.col("inter_sz")).alias("n"), "ror_id")).alias("b"))
    return best.select("org_row_id", "org_len", *BLOCK, (-F.col("b.n")).alias("inter_sz"), "b.ror_id")


def _prefix_best(mine: DataFrame, registry: DataFrame) -> DataFrame:
    """(org, org_len, ror_id, inter_sz): per block the entry that shares most tokens, least id first, by prefixes of the rarest tokens.

    An entry that shares n of an organization's m known tokens has one of its m - n + 1 rarest. So: what shares one token is known
    without a pair, as the least id of each token; entries with the rarest token give a first bound; the tokens up to
    that bound's prefix give the rest. The most frequent token of an organization's block makes no pairs: to share
    two tokens an entry has a rarer one too.
    """
    entries = registry.select("ror_id", *BLOCK, "ror_toks")
    stats = entries.select(*BLOCK, "ror_id", F.explode("ror_toks").alias("tok")).groupBy(*BLOCK, "tok").agg(F.count("*").alias("df"), F.min("ror_id").alias("first_id"))
    names = lambda c: F.transform(c, lambda t: t["tok"])
    ranked = _by_rarity(entries, "ror_toks", stats, "ror_id").select("ror_id", *BLOCK, names("ts").alias("theirs"))
    index = ranked.select("ror_id", *BLOCK, "theirs", F.size("theirs").alias("r"), F.posexplode("theirs").alias("j", "tok"))
    known = _by_rarity(mine.withColumn("org_len", F.size("org_toks").cast("long")), "org_toks", stats, "org_row_id", "org_len")
    one = known.select("org_row_id", "org_len", F.lit(1).alias("inter_sz"), F.array_min(F.transform("ts", lambda t: t["first_id"])).alias("ror_id"))
    several = known.where(F.size("ts") > 1).select("org_row_id", "org_len", *BLOCK, names("ts").alias("mine"), F.size("ts").alias("m"))
    rarest = _prefix_pairs(several.withColumns({"i": F.lit(0), "tok": F.get("mine", F.lit(0)), "need": F.lit(2)}), index)
    bound = several.join(rarest.select("org_row_id", *BLOCK, F.col("inter_sz").alias("b")), ["org_row_id", *BLOCK], "left").withColumn("need", F.greatest(F.coalesce("b", F.lit(2)), F.lit(2)))
    more = bound.select("org_row_id", "org_len", *BLOCK, "mine", "m", "need", F.posexplode(F.slice("mine", F.lit(2), F.greatest(F.col("m") - F.col("need"), F.lit(0)))).alias("k", "tok"))
    rest = _prefix_pairs(more.withColumn("i", F.col("k") + 1).drop("k"), index)
    return one.unionByName(rarest.select(*one.columns)).unionByName(rest.select(*one.columns))


def match_tokens_block(orgs: DataFrame, registry: DataFrame, plan: str = "prefix") -> DataFrame:
    """The registry entry in one of the organization's cities that covers most of its name's tokens.

    plan 'prefix' pairs on an organization's rarest tokens within a city and bounds what later ones can give; 'inverted'
    joins all tokens on (country, city, token) and counts; 'block' pairs all of a city and intersects. All keep
    pairs with a shared token only and give the same result.
    """
    mine = restrict(orgs, registry, *BLOCK).withColumn("org_toks", token_set("organization_name_norm"))
    if plan == "block":
        shared, size, conf = token_overlap(F.col("org_toks"), F.col("ror_toks"))
        pairs = mine.join(registry, BLOCK).select("org_row_id", "ror_id", shared.alias("inter_sz"), size.alias("org_len"), conf.alias("confidence")).where("inter_sz > 0")
    else:
        if plan == "prefix":
            pairs = _prefix_best(mine, registry)
        else:
            left = mine.select("org_row_id", *BLOCK, F.size("org_toks").cast("long").alias("org_len"), F.explode("org_toks").alias("tok"))
            right = registry.select("ror_id", *BLOCK, F.explode("ror_toks").alias("tok"))
            pairs = left.join(right, [*BLOCK, "tok"]).groupBy("org_row_id", "ror_id", "city_geoname_id", "org_len").agg(F.count("*").alias("inter_sz"))
        pairs = pairs.select("org_row_id", "ror_id", "org_len", F.col("inter_sz").cast("long"), (F.col("inter_sz") / F.col("org_len")).alias("confidence"))
    best = pairs.groupBy("org_row_id").agg(F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("inter_sz")).alias("n"), "ror_id", "org_len")).alias("b"))
    best = best.select("org_row_id", "b.ror_id", (-F.col("b.n")).alias("inter_sz"), "b.org_len", (-F.col("b.c")).alias("confidence"))
    found = orgs.select(*ORG).distinct().join(best, "org_row_id").withColumn("source_value_norm", F.lit(""))
    return _matched(found, "ror_geo_fuzzy", 4, 2, F.col("confidence")).select(*BY_SOURCE)


def best_by_source(*bests: DataFrame) -> DataFrame:
    """The best match of each source; an organization occurs once per source. inter_sz and org_len are null where a source has none."""
    return union_matches(*[b if "inter_sz" in b.columns else b.withColumns({"inter_sz": F.lit(None).cast("long"), "org_len": F.lit(None).cast("long")}) for b in bests], columns=BY_SOURCE)

"""Joins over hot keys, null keys and frequent tokens: results as the plain ones, tasks even, no needless pairs."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from affilspark.operators import cities as C
from affilspark.operators import curate as K
from affilspark.operators import orgs as O
from affilspark.operators.skew import left_join_past_nulls, tiled_join
from affilspark.plans.registry import Inputs
from affilspark.plans.workflow import resolve_orgs


@pytest.fixture
def uncoalesced(spark):
    """16 shuffle partitions that stay as they are, and no broadcast."""
    want = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def per_task(df):
    return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_tiled_join_equals_join(spark):
    rng = random.Random(1)
    left = [(rng.choice(["hot", "hot", "hot", "a", "b", None]), 1, i) for i in range(200)] + [("hot", 1, 5)] * 2
    right = [(rng.choice(["hot", "hot", "a", "c", None]), 1, -i) for i in range(60)] + [("one", 1, 1)]
    left, right = spark.createDataFrame([*left, ("one", 1, 9)] + [("wide", 1, i) for i in range(300)], "k string, c int, x int"), spark.createDataFrame([*right, ("wide", 1, 7)], "k string, c int, y int")
    want = rows_of(left.join(right, ["k", "c"]))
    for pairs in (1, 10, 50, 1000, 1 << 20):
        assert rows_of(tiled_join(left, right, ["k", "c"], pairs)) == want
    assert tiled_join(left.limit(0), right, ["k", "c"], 5).count() == 0


def test_tiles_are_even(spark, uncoalesced):
    left = spark.range(4000).selectExpr("if(id % 10 = 0, concat('k', id), 'hot') as k", "id as x")
    right = spark.range(400).selectExpr("if(id % 10 = 0, concat('k', id), 'hot') as k", "id as y")
    plain, tiled = per_task(left.join(right, "k")), per_task(tiled_join(left, right, ["k"], 10_000))
    assert sum(plain) == sum(tiled) and max(plain) > 0.9 * sum(plain)
    assert len(tiled) == 16 and max(tiled) < 2.5 * statistics.median(tiled)


def test_city_tokens_with_a_hot_first_token(spark):
    """One first token for nine tenths of the rows: tiles or not, the same matches."""
    rng = random.Random(2)
    word = lambda: rng.choice(["san", "marco", "juan", "del", "sur", "nuevo"])
    gaz = spark.createDataFrame([(str(i), f"San {word()} {word()}", "Nuevo x", "DE", "a", "b", "UTC") for i in range(80)], C.GAZETTEER)
    rows = [(f"c{i}", f"San {i}", "san " + " ".join(word() for _ in range(rng.randint(0, 4))) if i % 10 else "nuevo " + word(), "DE", 1) for i in range(150)]
    pending = spark.createDataFrame(rows, "city_row_id string, organization_city_raw string, organization_city_norm string, organization_country_iso2 string, pair_cnt long")
    one, many = rows_of(C.match_tokens_first(pending, gaz)), rows_of(C.match_tokens_first(pending, gaz, pairs=200))
    assert one == many and len(one) > 100


def test_null_keys_go_past_the_join(spark, uncoalesced):
    left = spark.range(0, 8000, 1, 8).selectExpr("if(id % 20 = 0, 'DE', null) as code", "if(id % 3 = 0, null, concat('c', id % 50)) as city", "id")
    right = spark.range(50).selectExpr("'DE' as code", "concat('c', id) as city", "id * 2 as norm")
    got = left_join_past_nulls(left, right, ["code", "city"])
    assert got.columns == left.join(right, ["code", "city"], "left").columns
    assert rows_of(got) == rows_of(left.join(right, ["code", "city"], "left"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.startswith("Union") and plan.count("SortMergeJoin") == 1 and plan.count("Exchange") == 2  # the other side of the union has none
    tasks = [n for n in per_task(got) if n > 100]  # the tasks of the union's larger side
    assert max(tasks) <= 2 * statistics.median(tasks)
    plain = per_task(left.join(right, ["code", "city"], "left"))
    assert max(plain) > 5 * statistics.median(plain)


def test_org_text_with_null_codes(spark):
    dim = spark.createDataFrame([("k", n, c, k, None, None) for n in ("Uni", None) for c in ("Bonn", None, "Ulm") for k in ("DE", "??", None)], "raw_org_key string, organization_name string, organization_city string, organization_country string, disambiguation_source string, disambiguated_organization_identifier string")
    cmap = spark.createDataFrame([("DE", "DE"), ("??", None)], "organization_country_raw string, organization_country_iso2 string")
    got = K.org_text(dim, cmap, K.city_text(dim, cmap))
    assert got.count() == 18 and {(r.organization_country_iso2, r.organization_city_raw, r.organization_city_norm) for r in got.collect()} == {("DE", "Bonn", "bonn"), ("DE", "Ulm", "ulm"), ("DE", None, None), (None, "Bonn", None), (None, "Ulm", None), (None, None, None)}


def _orgs(spark, names):
    return spark.createDataFrame([(f"o{i}", n, n, "DE", 1, city) for i, n in enumerate(names) for city in (("1",) if i % 3 else ("1", "2"))], "org_row_id string, organization_name_raw string, organization_name_norm string, organization_country_iso2 string, pair_cnt long, city_geoname_id string")


def _registry(spark, names):
    return spark.createDataFrame([(f"r{i:03d}", "DE", str(1 + i % 2), sorted(set(n.split()))) for i, n in enumerate(names)], "ror_id string, organization_country_iso2 string, city_geoname_id string, ror_toks array<string>")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_prefix_join_equals_all_pairs(spark, seed):
    """Skewed tokens, ties, several cities, names that share nothing."""
    rng = random.Random(seed)
    word = lambda: f"t{min(int(rng.expovariate(0.35)), 25)}"
    name = lambda: " ".join(word() for _ in range(rng.randint(1, 7)))
    orgs, registry = _orgs(spark, [*(name() for _ in range(120)), "", "zz"]), _registry(spark, [name() for _ in range(90)])
    block, prefix, inverted = (rows_of(O.match_tokens_block(orgs, registry, plan)) for plan in ("block", "prefix", "inverted"))
    assert block == prefix == inverted and len(block) > 100


def test_frequent_token_makes_no_pairs(spark, monkeypatch):
    """A token of every entry pairs nobody: those who share it alone are known by its least id."""
    asked_for, plain = [], O._prefix_pairs

    def seen(asked, index):
        asked_for.append((asked, index))
        return plain(asked, index)

    monkeypatch.setattr(O, "_prefix_pairs", seen)
    orgs = _orgs(spark, [f"university x{i} y{i % 7}" for i in range(60)] + ["university"] * 5)
    registry = _registry(spark, [f"university x{i} z{i}" for i in range(80)])
    got = {r.organization_name_norm: (r.ror_id, r.inter_sz) for r in O.match_tokens_block(orgs, registry).collect()}
    assert got["university x4 y4"] == ("r004", 2) and got["university"][1] == 1
    pairs = [a.join(i, [*O.BLOCK, "tok"]).select("tok").collect() for a, i in asked_for]
    assert len(pairs) == 2 and not any(r.tok == "university" for p in pairs for r in p) and 0 < len(pairs[0]) <= 80


def test_least_ids_without_candidates(spark, monkeypatch):
    """Names with many identifiers that lead to many ids: the best of each source as from all candidates, none of which is made."""
    rng = random.Random(4)
    ids = {"ROR": lambda i: f"r{i:03d}", "GRID": lambda i: f"GRID.{i}", "FUNDREF": lambda i: f"x/10.13039/{i}", "Ringgold": lambda i: f"RIN{i}"}
    raw = [("k", f"n{rng.randrange(6)}", c, rng.choice(["DE", "de", "??", None]), s, rng.choice([ids[s](rng.randrange(40)), "", None])) for c in ("Bonn", None) for s in ids for _ in range(120)]
    dim = spark.createDataFrame(raw, "raw_org_key string, organization_name string, organization_city string, organization_country string, disambiguation_source string, disambiguated_organization_identifier string")
    cmap = spark.createDataFrame([("DE", "DE"), ("de", "DE"), ("??", None)], "organization_country_raw string, organization_country_iso2 string")
    ext = spark.createDataFrame([(f"r{rng.randrange(300):03d}", t, v(i)) for i in range(60) for t, v in (("fundref", str), ("GRID", lambda i: f" grid.{i} "), ("isni", lambda i: f"0000 {i % 9}"), ("isni", lambda i: f"0000 {i % 9}"))], "id string, type string, value string")
    ring = spark.createDataFrame([(str(i), f"0000-{i % 9}") for i in range(35)] + [("36", " "), ("37", None)], "ringgold string, isni string")
    orgs = K.org_text(dim, cmap, K.city_text(dim, cmap), dedupe_city=True)
    found = resolve_orgs(orgs, dim, cmap, ext, ring, None, None, lambda: None)
    apart = ["org_row_id", "organization_country_iso2", "pair_cnt", "ror_id", "match_source", "match_priority", "confidence", "match_rule"]  # equal ids by several identifiers are ties
    every, schema = rows_of(found.candidates), found.candidates.schema
    want, wanted = rows_of(O.best_of_sources(found.candidates).select(apart)), rows_of(O.merge_sources(O.best_of_sources(found.candidates)).select(apart))
    for made in ("match_chain", "match_crosswalk", "match_direct", "org_signals"):
        monkeypatch.setattr(O, made, None)
    found = resolve_orgs(orgs, dim, cmap, ext, ring, None, None, lambda: None)
    assert rows_of(found.by_id.select(apart)) == want and rows_of(found.merged.select(apart)) == wanted and {r[4] for r in want} == {"ror", "grid", "fundref", "ringgold_isni"}
    assert set(rows_of(found.by_id)) <= set(every) and len(every) > 3 * len(want)
    assert [(f.name, f.dataType) for f in found.by_id.schema] == [(f.name, f.dataType) for f in schema] and O.match_least_ids(found.rows, O.raw_identifiers(dim, cmap, "ror", "grid", "fundref", "ringgold"), ring, ext).count() == len(want)


def test_exact_names_meet_one_id(spark):
    """An organization meets the least of the ids that share its country and name."""
    names = spark.createDataFrame([(f"r{i:02d}", f" Uni  {i % 2} ") for i in range(30)] + [("r98", None), ("r99", " ")], "id string, preferred_name string")
    places = spark.createDataFrame([(f"r{i:02d}", "DE" if i % 3 else "FR") for i in range(100)], "id string, country_code string")
    pending = spark.createDataFrame([(f"o{i}", "x", f"uni {i % 3}", "DE", 1) for i in range(9)], "org_row_id string, organization_name_raw string, organization_name_norm string, organization_country_iso2 string, pair_cnt long")
    every, least = O.match_org_exact(pending, names, places), O.match_org_exact(pending, names, places, True)
    assert rows_of(O.best_match(every)) == rows_of(O.best_match(least)) == rows_of(least) and least.count() == 6 and every.count() == 60


def test_best_and_coverage_without_candidates(spark, monkeypatch):
    """The last tables and their audits as all candidates of the identifiers give them, none of which is made for them."""
    sf, ids = "/root/testdata/sf0.001", ["ror", "fundref", "grid", "ringgold_isni"]
    made = O.best_of_sources(Inputs(spark, sf).resolved_orgs.candidates)
    pick = ["org_row_id", "ror_id", "match_source", "pair_cnt"]
    each, merged = rows_of(made.select(pick)), rows_of(O.merge_sources(made).select(pick))
    for name in ("match_chain", "match_crosswalk", "match_direct", "org_signals"):
        monkeypatch.setattr(O, name, None)
    found = Inputs(spark, sf).resolved_orgs
    by_id = F.col("match_source").isin(ids)
    assert each and rows_of(found.best_by_source.where(by_id).select(pick)) == each and rows_of(found.best.where(by_id).select(pick)) == merged
    per = lambda rows: {s: (len(own), sum(r[3] for r in own)) for s in ids if (own := [r for r in rows if r[2] == s])}
    audit = found.audits["by_source"].collect()
    counted = lambda *stages: {r.match_source: (r.matched_distinct, r.matched_weighted) for r in audit if r.stage in stages and r.match_source in ids and r.matched_distinct}
    assert counted(1, 2) == counted(5) == per(each) and counted(3) == per(merged)
    ends = found.audits["ids"].first()
    assert (ends.matched_distinct, ends.matched_weighted) == (len(merged), sum(r[3] for r in merged))

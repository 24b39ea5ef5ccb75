"""The command-line jobs end to end on small files: results, audits, resuming."""

import json

import pytest
from pyspark.sql import functions as F

from affilspark.operators import curate as K
from affilspark.operators import orgs as O
from affilspark.operators import registry as R
from affilspark.operators import roles
from affilspark.plans.jobs import main
from affilspark.plans.store import Store
from affilspark.plans.workflow import resolve_cities, resolve_orgs
from affilspark.sources.readers import read_ordered, read_tsv_lenient
from affilspark.sources.schemas import AFFILIATION, RINGGOLD
from affilspark.sources.writers import write_ndjson


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    """All jobs over four affiliations, with the arguments of the last."""
    tmp_path = tmp_path_factory.mktemp("jobs")
    p = str(tmp_path)
    row = lambda i, name, city, source=None, ident=None: (f"P{i}", "A", "B", "education", "Prof", None, "2010-00-00", None, name, city, "DE", source, ident)
    rows = [row(1, "Uni Bonn", "Bonn", "GRID", "grid.1"), row(2, "Uni Bonn", "Bonn"), row(3, "Haus Koeln", "Cologne"), row(4, "Koeln Institut", "Koeln")]
    write_ndjson(spark.createDataFrame(rows, AFFILIATION), f"{p}/raw")
    main(["curate", "--in", f"{p}/raw", "--out", f"{p}/cur", "--at", "t", "--ndjson"], spark)
    place = lambda n, name: [{"geonames_id": n, "geonames_details": {"country_code": "DE", "name": name}}]
    registry = [
        {"id": "r1", "names": [{"value": "Uni Bonn", "types": ["label"]}], "external_ids": [{"type": "grid", "all": ["grid.1"]}], "locations": place(1, "Bonn")},
        {"id": "r2", "names": [{"value": "Haus Koeln", "types": ["label"]}], "locations": place(2, "Koeln")},
        {"id": "r3", "names": [{"value": "Institut zu Koeln", "types": ["label"]}], "locations": place(2, "Koeln")},
    ]
    (tmp_path / "reg.json").write_text(json.dumps(registry))
    main(["registry", "--in", f"{p}/reg.json", "--out", f"{p}/reg", "--at", "t"], spark)
    (tmp_path / "iso.tsv").write_text("alpha2\nDE\n")
    (tmp_path / "terr.tsv").write_text("from\talpha2\nXK\tRS\n")
    (tmp_path / "roles.tsv").write_text("x\nx\nprof\t8\tR4\t\t\t1\n")
    (tmp_path / "ring.tsv").write_text("\t".join(f.split(" ")[0] for f in RINGGOLD.split(", ")) + "\n")
    gaz = "geoname_id string, ascii_name string, alternate_names string, country_code string, admin1_code string, admin2_code string, timezone string"
    spark.createDataFrame([("1", "Bonn", None, "DE", "", "", ""), ("2", "Koeln", "Cologne,Colonia", "DE", "", "", "")], gaz).write.parquet(f"{p}/gaz")
    args = ["resolve", "--in", f"{p}/cur", "--out", f"{p}/out", "--at", "t", "--iso", f"{p}/iso.tsv", "--territories", f"{p}/terr.tsv", "--gazetteer", f"{p}/gaz", "--registry", f"{p}/reg", "--ringgold", f"{p}/ring.tsv", "--roles", f"{p}/roles.tsv"]
    return p, args, main(args, spark)


def test_jobs(spark, done):
    p, _, _ = done
    read = lambda name: spark.read.parquet(f"{p}/out/{name}")
    assert {(r.organization_city_raw, r.geoname_id) for r in read("city_best").collect()} == {("Bonn", "1"), ("Cologne", "2"), ("Koeln", "2")}
    assert {(r.organization_name_raw, r.ror_id, r.match_source) for r in read("org_best").collect()} == {("Uni Bonn", "r1", "grid"), ("Haus Koeln", "r2", "ror_geo_exact"), ("Koeln Institut", "r3", "ror_geo_fuzzy")}
    assert read("audit/org_fuzzy").first().matched_pct_weighted == 100.0 and read("org_unmatched").count() == 0
    assert read("role_title_match").first().career_stage_efrc == "R4" and read("audit/role_title").first().matched_rows == 1


def same(one, two):
    columns = sorted(c for c in one.columns if c not in ("decided_at", "ingested_at"))
    return sorted(map(tuple, one.select(columns).collect()), key=str) == sorted(map(tuple, two.select(columns).collect()), key=str)


def test_audits_are_those_of_the_tables(spark, done):
    """What was counted while tables were written equals the audits that read them."""
    p, args, store = done
    read = lambda name: spark.read.parquet(f"{p}/out/{name}")
    reg = lambda name: spark.read.parquet(f"{p}/reg/{name}")
    cities = resolve_cities(read("city_text").drop("decided_at"), spark.read.parquet(f"{p}/gaz"))
    orgs = resolve_orgs(read("org_text"), spark.read.parquet(f"{p}/cur/dim_org_raw"), read("country"), reg("external_id"), read_tsv_lenient(spark, f"{p}/ring.tsv", RINGGOLD), reg("name_preferred"), reg("location"), lambda: cities.best)
    for k, v in cities.audits.items():
        assert same(read(f"audit/city_{k}"), v)
    for k, v in orgs.audits.items():
        assert same(read(f"audit/org_{k}"), v)
    assert same(read("audit/role_title"), roles.role_title_audit(read("role_title_match")))
    for name, weight, mapped in (("country", "cnt", "organization_country_iso2"), ("city_text", "pair_cnt", "organization_city_norm"), ("org_text", "pair_cnt", "organization_name_norm"), ("role_title_text", "pair_cnt", "role_title_norm")):
        assert same(read(f"audit/{name}"), K.normalization_audit(read(name), weight, mapped))
    tables = {t: reg(t) for t in ("name", "link", "external_id", "location", "relationship", "domain", "org_type", "name_preferred")}
    assert same(reg("audit"), R.registry_audit(reg("organization"), reg("org_enriched"), **tables))
    assert {"city_exact", "city_left_exact", "city_all", "org_signals", "org_candidates", "org_exact_candidates", "org_in_cities", "role_title_map"} <= set(store.made)


def test_tables_are_ordered(spark, done):
    p, _, _ = done
    at = read_ordered(spark, f"{p}/out/org_by_id").orderBy("position").select("org_row_id", "match_priority", "ror_id").collect()
    assert [tuple(r) for r in at] == sorted(tuple(r) for r in at) and len(at) > 0
    cities = [(r[0] or "ZZ", r[1] or "") for r in read_ordered(spark, f"{p}/out/city_text").orderBy("position").select("organization_country_iso2", "organization_city_norm").collect()]
    assert cities == sorted(cities)


def test_resume(spark, done, monkeypatch):
    p, args, _ = done
    assert main(args, spark).made == []  # nothing has changed
    args = [a if a != f"{p}/out" else f"{p}/again" for a in args]

    def cut_off(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(O, "match_org_exact", cut_off)
        with pytest.raises(RuntimeError, match="lost"):
            main(args, spark)
    made = main(args, spark).made
    assert made[0] == "org_exact_candidates" and not {"country", "city_text", "city_best", "org_by_id", "org_merged", "org_left_ids"} & set(made)
    assert same(spark.read.parquet(f"{p}/again/org_best"), spark.read.parquet(f"{p}/out/org_best"))
    with open(f"{p}/ring.tsv", "a") as f:
        f.write("7\t0000 0001\tName\n")
    with open(f"{p}/again/_manifests/country.json", "w") as f:
        f.write('{"finger')  # cut off while a manifest was written
    made = main(args, spark).made
    assert {"country", "org_candidates", "org_by_id", "org_best"} <= set(made) and not {"city_fuzzy", "org_signals", "role_title_map", "org_rows"} & set(made)


def test_store(spark, tmp_path):
    """A table is made again for other constants, needs, schema or source files, and read otherwise."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x")
    df = spark.range(5).selectExpr("id", "cast(id % 2 as string) as k")

    def run(frame=df, needs=("in",), **constants):
        store = Store(spark, str(tmp_path / "out"), **({"at": "1"} | constants))
        store.source("in", str(tmp_path / "in"))
        store.source("none", None)
        got = store.keep(frame, "t/x", needs, ["id"], {"top": F.max("id")}, hidden=("k",))
        return store.made, store.metrics["t/x"], got.columns, spark.read.parquet(str(tmp_path / "out/t/x")).columns

    assert run() == (["t/x"], {"rows": 5, "top": 4}, ["id"], ["id", "at"])
    assert run() == ([], {"rows": 5, "top": 4}, ["id"], ["id", "at"])
    assert run(at="2")[0] and run(at="2", needs=("in", "none"))[0] and run(df.selectExpr("id", "k", "1 as n"))[0] and run()[0] and not run()[0]
    (tmp_path / "in" / "a.txt").write_text("xy")
    assert run()[0] and not run()[0]


def test_empty_stages(spark, done, tmp_path):
    """Without a registry every organization stage is empty, and all tables are there."""
    p, args, _ = done
    for name in ("external_id", "name_preferred", "location"):
        spark.read.parquet(f"{p}/reg/{name}").limit(0).write.parquet(str(tmp_path / "reg" / name))
    swap = {f"{p}/out": str(tmp_path / "out"), f"{p}/reg": str(tmp_path / "reg")}
    main([swap.get(a, a) for a in args], spark)
    read = lambda name: spark.read.parquet(str(tmp_path / "out" / name))
    assert read("org_best").count() == read("org_fuzzy").count() == read("org_exact").count() == 0 and read("org_unmatched").count() == read("org_rows").count()
    assert read("audit/org_fuzzy").first().matched_pct_weighted == 0.0 and read("audit/org_by_source").where("stage = 1").count() == 3

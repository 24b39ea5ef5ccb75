"""Readers and writers on small files."""

import json
from types import SimpleNamespace

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from pyspark.sql import functions as F

from affilspark.sources import json_array, parts
from affilspark.sources import readers as R
from affilspark.sources import writers as W
from affilspark.sources.schemas import AFFILIATION, AFFILIATION_COLUMNS, REGISTRY, RINGGOLD, ROLE_MAP
from affilspark.sources.xml import broken_xml, pack_xml, records_of, xml_files

HEAD = '<r:record xmlns:r="http://x/r" xmlns:c="http://x/c" xmlns:p="http://x/p" xmlns:a="http://x/a" path="/1">'


def person(n, educations="", employments="", name=True):
    names = "<p:person><p:name><p:given-names>Ada</p:given-names></p:name></p:person>" if name else ""
    return f"{HEAD}<c:orcid-identifier><c:path>{n}</c:path></c:orcid-identifier>{names}<a:activities-summary><a:educations>{educations}</a:educations><a:employments>{employments}</a:employments></a:activities-summary></r:record>"


def group(kind, *titles):
    body = "".join(
        f"<x:{kind}-summary xmlns:x='http://x/x'><c:role-title>{t}</c:role-title><c:start-date><c:year>2010</c:year></c:start-date><c:organization><c:name>Uni {t}</c:name><c:address><c:city>Bonn</c:city></c:address></c:organization></x:{kind}-summary>" for t in titles
    )
    return f"<a:affiliation-group>{body}</a:affiliation-group>"


def test_person_xml(spark, tmp_path):
    (tmp_path / "0").mkdir()
    first = person("0-1", group("education", "BSc", "MSc") + group("education", "PhD"), group("employment", "Dr"))
    (tmp_path / "0" / "a.xml").write_text(first)
    (tmp_path / "b.xml").write_text(person("0-2", name=False, employments=group("employment", "Prof")))
    (tmp_path / "c.xml").write_text(person("0-3"))
    (tmp_path / "d.xml").write_text("<other><path>9</path></other>")
    got = R.read_person_xml(spark, str(tmp_path))
    assert got.columns == AFFILIATION_COLUMNS
    rows = sorted((r.orcid, r.given_names, r.family_name, r.affiliation_type, r.role_title, r.start_date, r.end_date, r.organization_city, r.organization_country) for r in got.collect())
    assert rows == [
        ("0-1", "Ada", "", "education", "BSc", "2010-00-00", None, "Bonn", None), ("0-1", "Ada", "", "education", "MSc", "2010-00-00", None, "Bonn", None),
        ("0-1", "Ada", "", "education", "PhD", "2010-00-00", None, "Bonn", None), ("0-1", "Ada", "", "employment", "Dr", "2010-00-00", None, "Bonn", None),
        ("0-2", "", "", "employment", "Prof", "2010-00-00", None, "Bonn", None),
    ]
    packed = R.parse_person_xml(spark.createDataFrame([(first,)], "value string"))
    assert packed.count() == 4


def test_person_xml_text_and_errors(spark, tmp_path):
    """Texts stay as they are; records inside another root count; broken files go to the error table."""
    odd = group("education", "  a b ").replace("<c:city>Bonn</c:city>", "<c:city/><c:country> </c:country>").replace("<c:year>2010</c:year>", "<c:year> 2010\n</c:year>")
    files = {"a": '<?xml version="1.0"?><!-- <record> -->' + person("1", odd), "b": f"<w>{person('2', odd)}</w>", "c": "<other/>", "d": person("3", odd)[:-9], "e": "<open>", "f": " ", "g.txt": person("9", odd)}
    for name, text in files.items():
        (tmp_path / (name if "." in name else f"{name}.xml")).write_text(text)
    rows = sorted(tuple(r)[i] for r in R.read_person_xml(spark, str(tmp_path)).collect() for i in (0, 4, 6, 8, 9, 10))
    assert rows == sorted([x for n in "12" for x in (n, "  a b ", "2010-00-00", "Uni   a b ", "", " ")])
    assert sorted(r.path[-5] for r in broken_xml(xml_files(spark, str(tmp_path))).collect()) == ["d", "e", "f"]


def test_packed_xml(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(1500):
        (tmp_path / "in" / f"{i}.xml").write_text(person(str(i), group("education", "x")))
    pack_xml(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("part*"))) <= 15
    assert R.read_packed_xml(spark, str(tmp_path / "out")).select("orcid").distinct().count() == 1500
    pack_xml(spark, str(tmp_path / "in"), str(tmp_path / "one"), block_bytes=50_000)
    assert len(list((tmp_path / "one").glob("part*"))) > 8


def sizes(folder):
    return [p.stat().st_size for p in sorted(folder.glob("part*"))]


def test_parts_by_bytes(spark, tmp_path):
    """Rows of very unequal length: no part is over the bound by more than a row, none but a task's last is under it."""
    rows = [(str(i), "x" * (2000 if i >= 1000 else i % 7)) for i in range(2000)]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    W.write_ndjson(df, str(tmp_path / "n"), max_bytes=100_000)
    got = sizes(tmp_path / "n")
    assert all(100_000 <= s < 100_000 + 2030 for s in got[:-1]) and len(got) == 21
    assert sorted(map(tuple, spark.read.schema("a string, b string").json(str(tmp_path / "n")).collect())) == sorted(rows)
    assert [json.loads(line)["a"] for p in sorted((tmp_path / "n").glob("part*")) for line in p.open()] == [r[0] for r in rows]
    W.write_ndjson(df.limit(3), str(tmp_path / "n"))  # replaces all
    assert len(sizes(tmp_path / "n")) == 1 and {p.name for p in (tmp_path / "n").iterdir() if not p.name.startswith(("part", "."))} == {"_SUCCESS"}
    W.write_ndjson(df.limit(0), str(tmp_path / "none"))
    assert sizes(tmp_path / "none") == []


@pytest.mark.parametrize(("max_bytes", "max_rows"), [(1, 1 << 62), (50, 1 << 62), (997, 7), (1 << 20, 64), (1 << 20, 1 << 62)])
def test_lines_are_written_by_batch(tmp_path, monkeypatch, max_bytes, max_rows):
    """A write for what a batch has for a part, not for each row; parts end where they do row by row."""
    texts = [None if i % 11 == 0 else "" if i % 7 == 0 else "é\U0001f600\n"[: i % 4] + "x" * (i * 37 % 91) for i in range(3000)]
    whole, wanted, size, rows = pa.array(texts), [b""], 0, 0
    for text in texts:
        if size >= max_bytes or rows >= max_rows:
            wanted, size, rows = [*wanted, b""], 0, 0
        line = (text or "").encode() + b"\n"
        wanted[-1] += line
        size, rows = size + len(line), rows + 1
    batches = [pa.record_batch([whole.slice(a, b - a)], ["value"]) for a, b in ((0, 1), (1, 1), (1, 1500), (1500, 3000))]
    task, store, calls = SimpleNamespace(partitionId=lambda: 0, taskAttemptId=lambda: 0), fs.LocalFileSystem(), []

    def opened(name):
        out = store.open_output_stream(name)
        return SimpleNamespace(write=lambda data: (calls.append(1), out.write(data)), close=out.close)

    monkeypatch.setattr("pyspark.TaskContext.get", lambda: task)
    monkeypatch.setattr(parts, "_opened", lambda uri: (SimpleNamespace(create_dir=store.create_dir, open_output_stream=opened), uri))
    writer = parts.LineWriter(str(tmp_path), ".json", max_bytes, max_rows, True)
    done = writer.write(iter(batches))
    assert [open(name, "rb").read() for name in done.names] == wanted
    assert len(calls) <= len(wanted) + len(batches)


def test_failed_write_leaves_no_part(spark, tmp_path):
    W.write_ndjson(spark.range(5).selectExpr("cast(id as string) as a"), str(tmp_path / "n"))
    before = {p.name: p.read_text() for p in (tmp_path / "n").glob("part*")}
    bad = spark.range(0, 4000, 1, 4).selectExpr("if(id = 3999, raise_error('stop'), cast(id as string)) as a")
    with pytest.raises(Exception, match="stop"):
        W.write_ndjson(bad, str(tmp_path / "n"), max_bytes=100)
    assert {p.name: p.read_text() for p in (tmp_path / "n").glob("part*")} == before and not (tmp_path / "n" / "_temporary").exists()


def test_ndjson_round_trip(spark, tmp_path):
    rows = [tuple(f"{c}{i}" if (i + k) % 3 else None for k, c in enumerate(AFFILIATION_COLUMNS)) for i in range(10)]
    df = spark.createDataFrame(rows, AFFILIATION)
    W.write_ndjson(df.coalesce(1), str(tmp_path / "n"), 4)
    parts = list((tmp_path / "n").glob("part*.json"))
    assert len(parts) == 3 and all(len(json.loads(line)) == 13 for p in parts for line in p.open())
    assert sorted(map(tuple, R.read_affiliation_ndjson(spark, str(tmp_path / "n")).collect()), key=str) == sorted(rows, key=str)


def test_by_year_and_ordered(spark, tmp_path):
    rows = [(f"P{i}", f"{2000 + i % 3}-01-00" if i % 4 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "orcid string, start_date string")
    W.write_by_year(df, str(tmp_path / "y"), max_records=5)
    assert {p.name for p in (tmp_path / "y").iterdir() if p.is_dir()} == {"year_dir=2000", "year_dir=2001", "year_dir=2002", "year_dir=null"}
    assert spark.read.option("basePath", str(tmp_path / "y")).parquet(str(tmp_path / "y")).count() == 60
    W.write_ordered(df, str(tmp_path / "o"), F.desc("orcid"), max_records=7)
    files = sorted((tmp_path / "o").glob("part*"))
    got = [r.orcid for f in files for r in spark.read.parquet(str(f)).collect()]
    assert got == sorted((r[0] for r in rows), reverse=True) and len(files) >= 9


def test_lenient_tsv(spark, tmp_path):
    head = "\t".join(f.split(" ")[0] for f in RINGGOLD.split(", "))
    (tmp_path / "r.tsv").write_text(head + '\n1\t0000 1\t"q\n2\n3' + "\tx" * 12 + "\n")
    got = {r.ringgold: r for r in R.read_tsv_lenient(spark, str(tmp_path / "r.tsv"), RINGGOLD).collect()}
    assert set(got) == {"1", "2"} and got["1"].name == '"q' and got["2"].isni is None
    assert {r.ringgold: r.institution for r in R.read_tsv_lenient(spark, str(tmp_path / "r.tsv"), RINGGOLD, drop_long=False).collect()} == {"1": None, "2": None, "3": "x"}
    (tmp_path / "s.tsv").write_text("Other Name\tNumber\nname\t1\nb\tx\nname\tn\n")
    assert [tuple(r) for r in R.read_tsv_lenient(spark, str(tmp_path / "s.tsv"), "name string, n int").collect()] == [("name", 1), ("b", None), ("name", None)]


def test_skipping_tsv(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("title\nhead\nProf\t8\t\tisco\tfos\t1\nDr\t\n")
    got = [tuple(r) for r in R.read_tsv_skip(spark, str(tmp_path / "m.tsv"), ROLE_MAP).orderBy("src_rownum").collect()]
    assert got == [(1, "Prof", "8", None, "isco", "fos", 1), (2, "Dr", None, None, None, None, None)]


def test_lookups_and_missing(spark, tmp_path):
    (tmp_path / "i.tsv").write_text("alpha2\nna\nNA\nU S\n")
    (tmp_path / "t.tsv").write_text("from\talpha2\nx\u2003 ｋ\trs\n")
    iso, terr = R.read_country_lookups(spark, str(tmp_path / "i.tsv"), str(tmp_path / "t.tsv"))
    assert [r[0] for r in iso.collect()] == ["NA", "NA", "U S"] and [tuple(r) for r in terr.collect()] == [("XK", "RS")]
    assert R.read_if_exists(spark, str(tmp_path / "none"), AFFILIATION).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_array_cutter(data):
    """Any cut of a document in blocks gives its objects and arrays back, whatever is in their strings."""
    text = st.text(st.sampled_from('{}[]",:\\ \n}aé'), max_size=6)
    value = st.recursive(st.one_of(text, st.integers(), st.none()), lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(text, v, max_size=3)), max_leaves=6)
    array = data.draw(st.lists(value, max_size=6))
    document = json.dumps(array, ensure_ascii=False, indent=data.draw(st.sampled_from([None, 1])))
    pieces = document.split("}")
    cuts = sorted(data.draw(st.sets(st.integers(0, len(pieces)), max_size=4)) | {0})
    blocks = [(a, pieces[a:b]) for a, b in zip(cuts, [*cuts[1:], len(pieces)]) if a < b]
    sums = []
    for n, own in blocks:
        turned, a, b = False, 0, 0
        for piece in own:
            turn, outside, inside = json_array.piece_effect(piece + "}")
            turned, a, b = turned ^ turn, a + (inside if turned else outside), b + (outside if turned else inside)
        sums.append(("f", n, turned, a, b))
    starts, got, held = json_array.block_starts(sums), [], None
    for n, own in blocks:
        cutter = json_array.Cutter(*starts["f", n])
        for kind, part in [x for p in own for x in cutter.feed(p + "}")] + [x for x in [cutter.rest()] if x]:
            if kind == "whole":
                got.append(part)
            elif kind == "head":
                held = part
            else:
                held += part
                if kind == "tail":
                    got.append(held)
    assert [json.loads(x) for x in got] == [x for x in array if isinstance(x, dict | list)]


def test_json_array_in_many_tasks(spark, tmp_path):
    odd = ['}{', '"', '\\', '[{"a": 1}]', "\n", "é😀", "]", ""]
    records = [{"id": f"r{i}", "names": [{"value": odd[i % 8] * (i % 5), "types": ["label"]}], "domains": [odd[(i + 3) % 8]]} for i in range(3000)] + [{"id": "long", "domains": ["}x{" * 20_000]}]
    (tmp_path / "r.json").write_text(json.dumps(records, indent=2, ensure_ascii=False))
    (tmp_path / "s.json").write_text("[]")
    (tmp_path / "t.json").write_text(json.dumps([{"id": "one"}, 5, "}", ["{"], {"id": "two"}]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = R.read_registry_json(spark, str(tmp_path))
        assert json_array._pieces(spark, str(tmp_path / "r.json")).rdd.getNumPartitions() > 20
        rows = sorted((r.id, r.names and r.names[0].value, r.domains and r.domains[0]) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == sorted([(r["id"], r["names"][0]["value"] if "names" in r else None, r["domains"][0]) for r in records] + [("one", None, None), ("two", None, None)])
    whole = spark.read.schema(REGISTRY).option("multiLine", True).json(str(tmp_path / "r.json"))
    assert sorted(map(str, R.read_registry_json(spark, str(tmp_path / "r.json")).collect())) == sorted(map(str, whole.collect()))


def test_order_by_names(spark, tmp_path):
    """Files read in order of their names give the order; more files than three digits can number."""
    df = spark.range(0, 1100).selectExpr("(id * 7919) % 1100 as k")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        W.write_ordered(df, str(tmp_path / "o"), "k", max_records=1)
        got = R.read_ordered(spark, str(tmp_path / "o"))
        assert got.where("k <> position").count() == 0 and got.count() == 1100
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    W.write_ordered(df.limit(0), str(tmp_path / "e"), "k")
    assert R.read_ordered(spark, str(tmp_path / "e")).count() == 0


def test_registry_json(spark, tmp_path):
    from affilspark.operators import registry as G

    records = [
        {"id": "r1", "types": ["education"], "names": [{"value": "Uni", "types": ["label", "ror_display"]}, {"value": "No type", "types": []}], "external_ids": [{"type": "grid", "all": ["g1", "g2"]}],
         "locations": [{"geonames_id": 7, "geonames_details": {"country_code": "DE", "lat": 1.5, "lng": "east"}}], "domains": ['"A.org"'], "links": [], "relationships": [{"type": "parent", "label": "L", "id": "r2"}]},
        {"id": "r2", "status": None, "admin": {"created": None}, "names": None},
    ]
    (tmp_path / "r.json").write_text(json.dumps(records))
    raw = R.read_registry_json(spark, str(tmp_path / "r.json"))
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(G.registry_name(raw)) == [("r1", "Uni", "", "label"), ("r1", "Uni", "", "ror_display")]
    assert rows(G.registry_external_id(raw)) == [("r1", "grid", "g1", ""), ("r1", "grid", "g2", "")]
    assert rows(G.registry_location(raw)) == [("r1", "7", "DE", "", 1.5, None, "")]
    assert rows(G.registry_domain(raw)) == [("r1", '"A.org"', "a.org")]
    assert G.registry_link(raw).count() == 0
    assert rows(G.registry_relationship(raw)) == [("r1", "parent", "L", "r2")]
    organization = G.registry_organization(raw)
    assert rows(organization)[1] == ("r2", "", [], None, "", "", "", "")
    assert rows(G.registry_org_type(organization)) == [("r1", "education")]
    enriched = G.registry_enriched(organization, G.preferred_name(G.registry_name(raw)))
    assert G.registry_audit(organization, enriched).first().asDict() == {"organization_rows": 2, "org_total": 2, "org_with_preferred_name": 1, "preferred_name_coverage_pct": 50.0}


def test_xml_is_parsed_once(spark):
    """Conditions and fields of a record take one parse of it, not one each."""
    packed = spark.createDataFrame([("a", "<record><person><name><given-names>Ada</given-names></name></person></record>"), ("b", "<x/>"), ("c", "<record><person></record>"), ("d", None)], "path string, xml string")
    for frame in (records_of(packed), R.affiliations_of(records_of(packed))):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1
    assert [r.person.name["given-names"] for r in records_of(packed).collect()] == ["Ada"]
    assert [r.path for r in broken_xml(packed).collect()] == ["c"]

"""DuckDB SQL of the registered queries: named steps, written apart from the DataFrame code."""

from __future__ import annotations

import re

from affilspark.plans.fixtures import VIEWS, duckdb_view


def _norm(c: str, trim: bool = True, null: bool = True) -> str:
    x = f"coalesce({c},'')"
    x = f"trim({x})" if trim else x
    x = f"lower(regexp_replace({x},'\\s+',' '))"
    return f"nullif({x},'')" if null else x


def _key(*cols: str) -> str:
    return "md5(" + "||'|'||".join(f"coalesce({c},'~null~')" for c in cols) + ")"


def _toks(c: str) -> str:
    return f"list_filter(string_split({c},' '), lambda x: length(trim(x))>0)"


def _pct(part: str, whole: str) -> str:
    return f"round(100.0::DOUBLE*({part})/nullif({whole},0),2)"


_ORG = "org_row_id, organization_name_raw, organization_name_norm, organization_country_iso2, pair_cnt"
_MATCH = f"{_ORG}, ror_id, match_source, source_value_norm, match_priority, confidence, match_rule"
_CITY = "city_row_id, organization_city_raw, organization_city_norm, organization_country_iso2, pair_cnt"
_CMATCH = f"{_CITY}, geoname_id, city_official_name, admin1_code, admin2_code, timezone, confidence, match_rule"
_PLACE = "g.geoname_id, g.ascii_name AS city_official_name, g.admin1_code, g.admin2_code, g.timezone"


def _best(table: str, key: str, order: str) -> str:
    return f"SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rk FROM {table}) WHERE rk=1"


def _freq(col: str, table: str = "dim_org") -> str:
    return f"SELECT {col} AS value, count(*) AS cnt FROM {table} GROUP BY 1"


def _found(rows: str, join: str, value: str, source: str, priority: int, rule: int) -> str:
    cols = ", ".join(f"o.{c}" for c in _ORG.split(", "))
    return f"SELECT {cols}, x.ror_id, '{source}' AS match_source, {value} AS source_value_norm, {priority} AS match_priority, 1.0::DOUBLE AS confidence, {rule} AS match_rule FROM {rows} o {join}"


def _audit(table: str, weight: str, mapped: str) -> str:
    has = f"CASE WHEN {mapped} IS NOT NULL THEN {weight} ELSE 0 END"
    no = f"CASE WHEN {mapped} IS NULL THEN {weight} ELSE 0 END"
    return f"SELECT CAST(sum({weight}) AS BIGINT) AS total_weighted, count(*) AS distinct_rows, CAST(sum({has}) AS BIGINT) AS mapped_weighted, CAST(sum({no}) AS BIGINT) AS unmapped_weighted, {_pct(f'sum({has})', f'sum({weight})')} AS mapped_pct FROM {table}"


def _coverage(total: str, matched: str, key: str, stage: int) -> str:
    return f"""SELECT {stage} AS stage, t.n AS total_pairs_distinct, t.w AS total_pairs_weighted, m.n AS matched_distinct, m.w AS matched_weighted, {_pct('m.w', 't.w')} AS matched_pct_weighted
FROM (SELECT count(*) n, CAST(coalesce(sum(pair_cnt),0) AS BIGINT) w FROM {total}) t, (SELECT count(*) n, CAST(coalesce(sum(pair_cnt),0) AS BIGINT) w FROM (SELECT {key}, max(pair_cnt) AS pair_cnt FROM {matched} GROUP BY 1)) m"""


_FIELDS = "orcid affiliation_type role_title department_name organization_name organization_city organization_country start_date end_date".split()

STEPS: dict[str, str] = {name: duckdb_view(name) for name in VIEWS} | {
    "fact": "SELECT md5(" + "||'|'||".join(f"lower(coalesce({c},''))" for c in _FIELDS) + """) AS aff_id, *,
 CASE WHEN length(start_date)>=4 THEN CAST(substr(start_date,1,4) AS INTEGER) END AS start_year,
 coalesce(affiliation_type='education',false) AS is_edu, coalesce(affiliation_type='employment',false) AS is_emp FROM aff""",
    "dim_org": """SELECT DISTINCT CASE WHEN disambiguation_source IS NOT NULL AND disambiguated_organization_identifier IS NOT NULL
 THEN lower(disambiguation_source)||':'||lower(disambiguated_organization_identifier)
 ELSE md5(lower(coalesce(organization_name,''))||'|'||lower(coalesce(organization_country,''))||'|'||lower(coalesce(organization_city,''))) END AS raw_org_key,
 organization_name, organization_city, organization_country, disambiguation_source, disambiguated_organization_identifier FROM fact""",
    "cmap": """SELECT raw AS organization_country_raw, coalesce(i.alpha2, l.alpha2) AS organization_country_iso2,
 CASE WHEN i.alpha2 IS NOT NULL THEN 'iso2' WHEN l.alpha2 IS NOT NULL THEN 'territorial' ELSE 'fallback' END AS mapping_method, cnt
 FROM (SELECT organization_country AS raw, count(*) AS cnt, upper(regexp_replace(translate(organization_country,'Ｄｅ ','De '),'\\s+','','g')) AS code FROM dim_org GROUP BY 1) c
 LEFT JOIN iso i ON i.alpha2=c.code LEFT JOIN (SELECT t."from" AS name, t.alpha2 FROM terr t JOIN iso ON iso.alpha2=t.alpha2) l ON l.name=c.code""",
    "city_text": f"""SELECT c.organization_country AS organization_country_raw, organization_city AS organization_city_raw, organization_country_iso2,
 {_norm('organization_city')} AS organization_city_norm, pair_cnt
 FROM (SELECT organization_country, organization_city, count(*) AS pair_cnt FROM dim_org GROUP BY 1,2) c LEFT JOIN cmap m ON m.organization_country_raw=c.organization_country""",
    "org_plain": f"""SELECT o.organization_country AS organization_country_raw, o.organization_city AS organization_city_raw, organization_name AS organization_name_raw, organization_country_iso2,
 {_norm('organization_name', null=False)} AS organization_name_norm, pair_cnt
 FROM (SELECT organization_country, organization_city, organization_name, count(*) AS pair_cnt FROM dim_org GROUP BY 1,2,3) o LEFT JOIN cmap m ON m.organization_country_raw=o.organization_country""",
    "org_text": "SELECT o.*, c.organization_city_norm FROM org_plain o LEFT JOIN city_text c ON c.organization_country_iso2=o.organization_country_iso2 AND c.organization_city_raw=o.organization_city_raw",
    "titles": f"SELECT role_title AS role_title_raw, {_norm('role_title')} AS role_title_norm, count(*) AS pair_cnt FROM fact GROUP BY 1,2",
    "city_rows": f"SELECT {_key('organization_country_raw', 'organization_city_raw')} AS city_row_id, organization_city_raw, organization_city_norm, organization_country_iso2, pair_cnt FROM city_text",
    "city_exact": f"SELECT c.*, {_PLACE}, 1.0::DOUBLE AS confidence, 1 AS match_rule FROM city_rows c JOIN gaz g ON g.country_code=c.organization_country_iso2 AND {_norm('g.ascii_name')}=c.organization_city_norm",
    "city_left1": "SELECT * FROM city_rows WHERE city_row_id NOT IN (SELECT city_row_id FROM city_exact)",
    "gaz_alias": "SELECT geoname_id, country_code, alt FROM gaz, unnest(string_split(coalesce(alternate_names,''),',')) AS u(alt) WHERE length(trim(alt))>0",
    "gaz_names": f"SELECT {_norm('ascii_name', trim=False, null=False)} AS name, country_code, geoname_id FROM gaz UNION SELECT {_norm('alt', null=False)}, country_code, geoname_id FROM gaz_alias",
    "city_alias": f"SELECT c.*, {_PLACE}, 1.0::DOUBLE AS confidence, 2 AS match_rule FROM city_left1 c JOIN gaz_names n ON n.country_code=c.organization_country_iso2 AND n.name=c.organization_city_norm JOIN gaz g ON g.geoname_id=n.geoname_id",
    "city_left2": "SELECT * FROM city_left1 WHERE city_row_id NOT IN (SELECT city_row_id FROM city_alias)",
    "gaz_first": f"SELECT DISTINCT geoname_id, country_code, coalesce({_toks(_norm('ascii_name', trim=False, null=False))}[1],'') AS first_tok FROM gaz WHERE ascii_name IS NOT NULL UNION SELECT geoname_id, country_code, coalesce({_toks(_norm('alt', null=False))}[1],'') FROM gaz_alias",
    "city_pairs": f"""SELECT c.city_row_id, g.geoname_id, len(list_intersect(p_toks, list_distinct({_toks(_norm('g.ascii_name', trim=False, null=False))}))) AS inter_sz, len(p_toks) AS p_len
 FROM (SELECT *, list_distinct({_toks("coalesce(organization_city_norm,'')")}) AS p_toks, {_toks("coalesce(organization_city_norm,'')")}[1] AS first_tok FROM city_left2) c
 JOIN gaz_first f ON f.country_code=c.organization_country_iso2 AND f.first_tok=c.first_tok JOIN gaz g ON g.geoname_id=f.geoname_id WHERE c.first_tok<>'' AND g.ascii_name IS NOT NULL""",
    "city_fuzzy": f"SELECT c.*, {_PLACE}, b.inter_sz::DOUBLE/b.p_len AS confidence, 3 AS match_rule FROM ({_best('(SELECT * FROM city_pairs WHERE inter_sz>0)', 'city_row_id', 'inter_sz DESC, geoname_id')}) b JOIN city_left2 c USING (city_row_id) JOIN gaz g ON g.geoname_id=b.geoname_id",
    "city_stages": "SELECT * FROM city_exact UNION ALL SELECT * FROM city_alias UNION ALL SELECT * FROM city_fuzzy",
    "city_weight": "SELECT organization_country_iso2, organization_city_norm, organization_city_raw, CAST(sum(pair_cnt) AS BIGINT) AS w FROM city_text GROUP BY 1,2,3",
    "city_all": f"SELECT {_CMATCH.replace('pair_cnt', 'w AS pair_cnt')} FROM city_stages JOIN city_weight USING (organization_country_iso2, organization_city_norm, organization_city_raw)",
    "city_top": _best("city_stages", "city_row_id", "match_rule, confidence DESC, geoname_id"),
    "city_best": f"SELECT {_CMATCH.replace('pair_cnt', 'w AS pair_cnt')} FROM city_top JOIN city_weight USING (organization_country_iso2, organization_city_norm, organization_city_raw)",
    "name_pref": "SELECT id, value AS preferred_name, lang AS preferred_lang, type AS preferred_type FROM (" + _best("reg_name", "id", "CASE type WHEN 'ror_display' THEN 1 WHEN 'label' THEN 2 WHEN 'alias' THEN 3 WHEN 'acronym' THEN 4 ELSE 9 END, value") + ")",
    "reg_org": """SELECT id, 'active' AS status, CAST(1900+CAST(geonames_id AS INTEGER)%100 AS INTEGER) AS established, '2020-01-01' AS admin_created_date, '1.0' AS admin_created_schema_version,
 CASE WHEN CAST(geonames_id AS INTEGER)%2=0 THEN '2024-02-03' ELSE '' END AS admin_last_modified_date, '' AS admin_last_modified_schema_version FROM reg_loc""",
    "org_rows": f"SELECT {_key('organization_country_raw', 'organization_city_raw', 'organization_name_raw')} AS org_row_id, organization_name_raw, organization_name_norm, organization_country_iso2, pair_cnt FROM org_plain",
    "signals": """SELECT DISTINCT m.organization_country_iso2 AS iso2, organization_name AS name, lower(disambiguation_source) AS source,
 CASE lower(disambiguation_source) WHEN 'fundref' THEN regexp_extract(lower(v),'10\\.13039/([0-9]+)',1) WHEN 'ringgold' THEN regexp_extract(lower(v),'([0-9]+)',1) ELSE lower(v) END AS v
 FROM (SELECT *, coalesce(disambiguated_organization_identifier,'') AS v FROM dim_org) d JOIN cmap m ON m.organization_country_raw=d.organization_country WHERE lower(disambiguation_source) IN ('fundref','grid','ror','ringgold')""",
    "org_sig": "SELECT o.*, s.source, s.v FROM org_rows o JOIN signals s ON s.iso2=o.organization_country_iso2 AND s.name=o.organization_name_raw",
    "walk": "SELECT lower(type) AS type, lower(trim(value)) AS v, min(id) AS ror_id FROM reg_ext GROUP BY 1,2",
    "m_fundref": _found("org_sig", "JOIN walk x ON x.type='fundref' AND o.source='fundref' AND x.v=o.v", "o.v", "fundref", 1, 1),
    "m_grid": _found("org_sig", "JOIN walk x ON x.type='grid' AND o.source='grid' AND x.v=o.v", "o.v", "grid", 2, 1),
    "m_direct": _found("org_sig", "JOIN (SELECT DISTINCT v AS ror_id FROM org_sig WHERE source='ror') x ON o.source='ror' AND x.ror_id=o.v", "o.v", "ror", 0, 1),
    "hop": "SELECT DISTINCT trim(r.ringgold) AS v, e.id AS ror_id FROM ring r JOIN reg_ext e ON lower(e.type)='isni' AND upper(replace(replace(r.isni,' ',''),'-',''))=upper(replace(replace(e.value,' ',''),'-','')) WHERE length(trim(r.isni))>0",
    "m_ring": _found("org_sig", "JOIN hop x ON o.source='ringgold' AND x.v=o.v", "o.v", "ringgold_isni", 3, 1),
    **{f"b_{k}": _best(f"m_{k}", "org_row_id", "match_priority, ror_id") for k in ("fundref", "grid", "direct", "ring")},
    "ids_all": " UNION ALL ".join(f"SELECT {_MATCH} FROM b_{k}" for k in ("fundref", "grid", "direct", "ring")),
    "ids_best": _best("ids_all", "org_row_id", "CASE match_source WHEN 'ror' THEN 0 WHEN 'fundref' THEN 1 WHEN 'grid' THEN 2 WHEN 'ringgold_isni' THEN 3 ELSE 9 END, match_priority, confidence DESC, ror_id"),
    "org_left3": "SELECT * FROM org_rows WHERE org_row_id NOT IN (SELECT org_row_id FROM ids_best)",
    "reg_exact": f"SELECT DISTINCT l.id AS ror_id, l.country_code, {_norm('n.preferred_name')} AS name FROM reg_loc l JOIN name_pref n USING (id) WHERE length(trim(l.country_code))>0 AND length(trim(n.preferred_name))>0",
    "m_exact": _found("org_left3", "JOIN reg_exact x ON x.country_code=o.organization_country_iso2 AND x.name=o.organization_name_norm", "o.organization_name_norm", "ror_geo_exact", 4, 2),
    "b_exact": _best("m_exact", "org_row_id", "match_priority, ror_id"),
    "best4": f"SELECT {_MATCH} FROM ids_best UNION ALL SELECT {_MATCH} FROM b_exact",
    "org_left4": "SELECT * FROM org_rows WHERE org_row_id NOT IN (SELECT org_row_id FROM best4)",
    "org_city": """SELECT DISTINCT o.*, c.geoname_id AS city FROM org_left4 o
 JOIN (SELECT m.organization_country_iso2 AS iso2, d.organization_name, d.organization_city FROM dim_org d JOIN cmap m ON m.organization_country_raw=d.organization_country WHERE length(trim(d.organization_city))>0) d
 ON d.iso2=o.organization_country_iso2 AND d.organization_name=o.organization_name_raw
 JOIN city_best c ON c.organization_country_iso2=d.iso2 AND c.organization_city_raw=d.organization_city""",
    "org_pairs": f"""SELECT o.*, l.id AS ror_id, len(list_intersect(list_distinct({_toks('o.organization_name_norm')}), list_distinct({_toks(_norm('n.preferred_name', trim=False, null=False))}))) AS inter_sz,
 len(list_distinct({_toks('o.organization_name_norm')})) AS org_len
 FROM org_city o JOIN reg_loc l ON l.country_code=o.organization_country_iso2 AND l.geonames_id=o.city JOIN name_pref n USING (id)""",
    "b_fuzzy": "SELECT * REPLACE (CAST(inter_sz AS BIGINT) AS inter_sz, CAST(org_len AS BIGINT) AS org_len) FROM (" + _best("(SELECT *, inter_sz::DOUBLE/org_len AS confidence FROM org_pairs WHERE inter_sz>0)", "org_row_id", "confidence DESC, inter_sz DESC, ror_id") + ")",
    "org_fuzzy": f"SELECT {_ORG}, ror_id, inter_sz, org_len, confidence, 'ror_geo_fuzzy' AS match_source, '' AS source_value_norm, 4 AS match_priority, 2 AS match_rule FROM b_fuzzy",
    "best5": f"SELECT {_MATCH} FROM best4 UNION ALL SELECT {_MATCH} FROM org_fuzzy",
    "by_source": " UNION ALL ".join(f"SELECT {_ORG}, ror_id, CAST(NULL AS BIGINT) AS inter_sz, CAST(NULL AS BIGINT) AS org_len, confidence, match_source, source_value_norm, match_priority, match_rule FROM {t}" for t in ("b_fundref", "b_grid", "b_direct", "b_ring", "b_exact"))
    + f" UNION ALL SELECT {_ORG}, ror_id, inter_sz, org_len, confidence, match_source, source_value_norm, match_priority, match_rule FROM org_fuzzy",
    "role_map": "SELECT * EXCLUDE (src_rownum) FROM (" + _best("(SELECT src_rownum, role_title_raw, lower(trim(role_title_raw)) AS role_title_norm, nullif(trim(edu_level_isced2011),'') AS edu_level_isced2011, nullif(trim(career_stage_efrc),'') AS career_stage_efrc, nullif(trim(occupation_isco08),'') AS occupation_isco08, nullif(trim(field_fos2015),'') AS field_fos2015, coalesce(is_academic=1,false) AS is_academic FROM rolemap WHERE length(trim(role_title_raw))>0)", "role_title_norm", "src_rownum") + ")",
    "role_match": "SELECT t.*, m.edu_level_isced2011, m.career_stage_efrc, m.occupation_isco08, m.field_fos2015, m.is_academic FROM titles t LEFT JOIN role_map m ON m.role_title_norm=t.role_title_norm",
    "doc_toks": f"SELECT doc_id, lang, {_norm('text', null=False)} AS t FROM documents",
    "bench_toks": f"SELECT item_id, {_norm('text', null=False)} AS t FROM benchmark",
}

FINAL: dict[str, str] = {
    "fact_affiliation": "SELECT * FROM fact",
    "year_layout_counts": "SELECT coalesce(lpad(CAST(start_year AS VARCHAR),4,'0'),'null') AS year_dir, count(*) AS cnt FROM fact GROUP BY 1",
    "dim_person": "SELECT orcid AS person_id, min(given_names) AS given_names, min(family_name) AS family_name, count(*) AS records FROM fact GROUP BY 1",
    "dim_org_raw": "SELECT * FROM dim_org",
    "freq_country": _freq("organization_country"),
    "freq_city": _freq("organization_city"),
    "freq_org_name": _freq("organization_name"),
    "freq_role_title": _freq("role_title", "fact"),
    "country_map": "SELECT * FROM cmap",
    "country_audit": _audit("cmap", "cnt", "organization_country_iso2"),
    "city_text": "SELECT * FROM city_text",
    "city_text_audit": _audit("city_text", "pair_cnt", "organization_city_norm"),
    "org_text": "SELECT * FROM org_text",
    "org_text_audit": _audit("org_text", "pair_cnt", "organization_name_norm"),
    "role_title_text": "SELECT * FROM titles",
    "role_title_text_audit": _audit("titles", "pair_cnt", "role_title_norm"),
    "city_match_exact": f"SELECT {_CMATCH} FROM city_exact",
    "city_unmatched_exact": f"SELECT {_CITY} FROM city_left1",
    "city_match_alias": f"SELECT {_CMATCH} FROM city_alias",
    "city_match_fuzzy": f"SELECT {_CMATCH} FROM city_fuzzy",
    "city_all": f"SELECT {_CMATCH} FROM city_all",
    "city_best": f"SELECT {_CMATCH} FROM city_best",
    "city_coverage": " UNION ALL ".join([_coverage("city_rows", t, "city_row_id", i + 1) for i, t in enumerate(("city_exact", "(SELECT * FROM city_exact UNION ALL SELECT * FROM city_alias)", "city_stages", "city_best"))]),
    "registry_name": "SELECT id, value, lang, type FROM reg_name",
    "registry_external_id": "SELECT id, type, value, '' AS preferred FROM reg_ext",
    "registry_location": "SELECT id, geonames_id, country_code, '' AS admin1_code, CAST(geonames_id AS DOUBLE)/100 AS lat, CAST(NULL AS DOUBLE) AS lng, city_name FROM reg_loc",
    "registry_domain": "SELECT id, '\"N'||geonames_id||'.Example.ORG\"' AS value_raw, 'n'||geonames_id||'.example.org' AS value FROM reg_loc",
    "registry_link": "SELECT id, 'website' AS type, 'https://n'||geonames_id||'.example.org' AS value FROM reg_loc",
    "registry_relationship": "SELECT id, 'parent' AS type, city_name AS label, '' AS related_id FROM reg_loc",
    "registry_organization": "SELECT *, CASE WHEN CAST(geonames_id AS INTEGER)%3=0 THEN 'education|funder' ELSE 'funder' END AS types FROM reg_org JOIN (SELECT id, geonames_id FROM reg_loc) USING (id)",
    "registry_org_type": "SELECT id, 'funder' AS type FROM reg_loc UNION ALL SELECT id, 'education' FROM reg_loc WHERE CAST(geonames_id AS INTEGER)%3=0",
    "registry_preferred_name": "SELECT * FROM name_pref",
    "registry_enriched": "SELECT o.*, n.preferred_name, n.preferred_lang, n.preferred_type FROM reg_org o LEFT JOIN name_pref n USING (id)",
    "registry_audit": f"""SELECT (SELECT count(*) FROM reg_org) AS organization_rows, (SELECT count(*) FROM reg_name) AS name_rows, (SELECT count(*) FROM name_pref) AS name_preferred_rows,
 (SELECT count(*) FROM reg_ext) AS external_id_rows, (SELECT count(*) FROM reg_loc) AS location_rows, (SELECT count(*) FROM reg_loc) AS relationship_rows, (SELECT count(*) FROM reg_loc) AS domain_rows,
 (SELECT count(*) + count(*) FILTER (WHERE CAST(geonames_id AS INTEGER)%3=0) FROM reg_loc) AS org_type_rows, c.n AS org_total, c.h AS org_with_preferred_name, {_pct('c.h', 'c.n')} AS preferred_name_coverage_pct
 FROM (SELECT count(*) AS n, count(preferred_name) AS h FROM reg_org LEFT JOIN name_pref USING (id)) c""",
    "org_match_fundref": f"SELECT {_MATCH} FROM b_fundref",
    "org_match_grid": f"SELECT {_MATCH} FROM b_grid",
    "org_match_direct": f"SELECT {_MATCH} FROM b_direct",
    "org_match_ringgold": f"SELECT {_MATCH} FROM b_ring",
    "org_merge_ids": f"SELECT {_MATCH} FROM ids_best",
    "org_unmatched_ids": f"SELECT {_ORG} FROM org_left3",
    "org_match_name_exact": f"SELECT {_MATCH} FROM b_exact",
    "org_match_fuzzy": "SELECT * FROM org_fuzzy",
    "org_best": f"SELECT {_MATCH} FROM best5",
    "org_best_by_source": "SELECT * FROM by_source",
    "org_coverage": " UNION ALL ".join(_coverage("org_rows", t, "org_row_id", s) for t, s in (("(SELECT * FROM ids_all WHERE match_source<>'ringgold_isni')", 1), ("b_ring", 2), ("ids_best", 3), ("best4", 4), ("best5", 5))),
    "org_coverage_by_source": f"""WITH listed AS (SELECT * FROM (VALUES (1,'fundref'),(1,'grid'),(1,'ror'),(2,'ringgold_isni')) v(stage, match_source)),
 each AS (SELECT CASE match_source WHEN 'ringgold_isni' THEN 2 ELSE 1 END AS stage, match_source, org_row_id, pair_cnt FROM ids_all
  UNION ALL SELECT 3, match_source, org_row_id, pair_cnt FROM ids_best UNION ALL SELECT 4, match_source, org_row_id, pair_cnt FROM best4 UNION ALL SELECT 5, match_source, org_row_id, pair_cnt FROM by_source),
 found AS (SELECT stage, match_source, count(DISTINCT org_row_id) AS n, sum(pair_cnt) AS w FROM each GROUP BY 1,2)
 SELECT stage, match_source, coalesce(n,0) AS matched_distinct, CAST(coalesce(w,0) AS BIGINT) AS matched_weighted, {_pct('coalesce(w,0)', '(SELECT sum(pair_cnt) FROM org_rows)')} AS matched_pct_weighted_source FROM listed FULL JOIN found USING (stage, match_source)""",
    "role_title_map": "SELECT * FROM role_map",
    "role_title_match": "SELECT * FROM role_match",
    "role_title_audit": """SELECT count(*) AS total_rows, count(DISTINCT role_title_norm) AS distinct_role_title_norm, count(*) FILTER (WHERE is_academic IS NOT NULL) AS matched_rows,
 count(DISTINCT role_title_norm) FILTER (WHERE is_academic IS NOT NULL) AS matched_role_title_norm, 100.0::DOUBLE*count(*) FILTER (WHERE is_academic IS NOT NULL)/nullif(count(*),0) AS matched_pct_rows FROM role_match""",
    "tokens_documents": f"""WITH d AS (SELECT doc_id, list_distinct({_toks('t')}) AS w, coalesce({_toks('t')}[1],'') AS f FROM doc_toks),
 i AS (SELECT item_id, list_distinct({_toks('t')}) AS w, coalesce({_toks('t')}[1],'') AS f FROM bench_toks),
 p AS (SELECT doc_id, item_id, CAST(len(list_intersect(d.w, i.w)) AS BIGINT) AS n, count(*) OVER (PARTITION BY doc_id) AS m FROM d JOIN i USING (f) WHERE f<>''),
 b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, item_id) AS rk FROM p) WHERE rk=1)
 SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_tokens, coalesce(b.m,0) AS items, b.item_id, coalesce(b.n,0) AS inter_sz, coalesce(b.n::DOUBLE/len(d.w),0.0) AS confidence FROM d LEFT JOIN b ON b.doc_id=d.doc_id""",
    "person_xml": "SELECT * FROM aff",
    "ndjson_round_trip": "SELECT * FROM aff",
    "year_round_trip": "SELECT orcid, start_date, start_year, coalesce(lpad(CAST(start_year AS VARCHAR),4,'0'),'null') AS year_dir FROM fact",
    "ordered_round_trip": f"SELECT value, cnt, row_number() OVER (ORDER BY cnt DESC, value NULLS LAST) - 1 AS position FROM ({_freq('organization_city')})",
    "city_places": """SELECT organization_country_raw, organization_city_raw, organization_country_iso2, organization_city_norm, row_number() OVER (ORDER BY coalesce(organization_country_iso2,'ZZ'),
 coalesce(organization_city_norm,''), coalesce(organization_city_raw,''), coalesce(organization_country_raw,''), organization_city_raw IS NULL) - 1 AS position FROM city_text""",
    "lenient_tsv": "SELECT ringgold, nullif(isni,'') AS isni, CASE WHEN CAST(ringgold AS BIGINT)%3=0 THEN NULL ELSE name END AS name FROM ring WHERE CAST(ringgold AS BIGINT)%7<>0",
    "registry_json": "SELECT id, value, lang, type FROM reg_name",
    "skipping_tsv": """SELECT row_number() OVER (PARTITION BY CAST(src_rownum AS BIGINT)//500 ORDER BY src_rownum) AS src_rownum, nullif(role_title_raw,'') AS role_title_raw,
 nullif(edu_level_isced2011,'') AS edu_level_isced2011, nullif(career_stage_efrc,'') AS career_stage_efrc, nullif(occupation_isco08,'') AS occupation_isco08, nullif(field_fos2015,'') AS field_fos2015, CAST(is_academic AS INTEGER) AS is_academic FROM rolemap""",
    "country_lookups": """SELECT CAST(NULL AS VARCHAR) AS "from", CASE WHEN n_nationkey=3 THEN 'NA' ELSE upper(substr(n_name,1,2)) END AS alpha2 FROM nation
 UNION ALL SELECT upper(replace(c_name,'#','NO')), upper(substr(c_mktsegment,1,2)) FROM customer""",
    "org_merge_without_lists": f"SELECT {_MATCH} FROM b_direct",
    "person_lineage": "SELECT orcid AS person_id, min(given_names) AS given_names, min(family_name) AS family_name, count(*) AS records, '2025_10' AS source_version, '2025-11-14T00:00:00Z' AS ingested_at FROM fact GROUP BY 1",
    "partial_dates": """SELECT event_id, CASE WHEN y IS NULL AND m IS NULL AND d IS NULL THEN NULL ELSE lpad(coalesce(y,'0'),4,'0')||'-'||lpad(coalesce(m,'0'),2,'0')||'-'||lpad(coalesce(d,'0'),2,'0') END AS partial
 FROM (SELECT event_id, CASE WHEN event_id%7=0 THEN NULL ELSE CAST(year(ts) AS VARCHAR) END AS y, CASE WHEN event_id%5=0 OR event_id%7=0 THEN NULL ELSE CAST(month(ts) AS VARCHAR) END AS m, CASE WHEN event_id%3=0 OR event_id%7=0 THEN NULL ELSE CAST(day(ts) AS VARCHAR) END AS d FROM events)""",
}


def _with(select: str) -> str:
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in STEPS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN|from|join)\s+\(?{name}\b", sql):
                visit(STEPS[name])
                needed.append(name)

    visit(select)
    steps = [f"{n} AS MATERIALIZED ({STEPS[n]})" for n in needed]
    if select.startswith("WITH "):
        return "WITH " + ",\n".join([*steps, select.removeprefix("WITH ")])
    return ("WITH " + ",\n".join(steps) + "\n" if steps else "") + select


ORACLES = {name: _with(sql) for name, sql in FINAL.items()}

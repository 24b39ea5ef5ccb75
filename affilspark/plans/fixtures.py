"""Views with the shape of the library's inputs, derived from the TPC-H-like test tables.

The SQL runs unchanged in Spark and DuckDB (tables in braces are DataFrames in Spark). Nulls, case,
spacing, unknown countries and several cities per organization are injected on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_CODE = "substr('ARBRCAEGETFRDEINIDIRIQJPJOKEMAMZPECNROSAVNRUGBUSXK',2*cast({0} as int)+1,2)"
_S = _CODE.format("s_nationkey")
_P = _CODE.format("p_partkey%24")
_NIL = "cast(null as string)"

VIEWS = {
    "aff": f"""
select 'P'||cast(o_custkey as string) as orcid, c_mktsegment as given_names, c_name as family_name,
 case l_returnflag when 'R' then 'education' else 'employment' end as affiliation_type,
 case l_linenumber%4 when 0 then upper(p_name) when 1 then '  '||p_name||' ' when 2 then replace(p_name,' ','   ')||'  x  y' else case when l_partkey%5=0 then {_NIL} else p_name end end as role_title,
 case when l_partkey%4=0 then {_NIL} else p_type end as department_name,
 case when l_partkey%11=0 then {_NIL} when l_partkey%7=0 then substr(cast(cast(o_orderdate as date) as string),1,4)||'-00-00' else cast(cast(o_orderdate as date) as string) end as start_date,
 case when l_linestatus='O' then {_NIL} else cast(cast(l_shipdate as date) as string) end as end_date,
 p_type||' '||p_name||' institute' as organization_name,
 case when s_suppkey%9=0 then {_NIL} when s_suppkey%4=0 then upper(p_name) when s_suppkey%10=1 then 'nowhere' when s_suppkey%10=7 then ' Zürich  '||upper('été ')||p_name||' ' else p_name end as organization_city,
 case when s_suppkey%13=0 then {_NIL} when s_suppkey%17=0 then 'Atlantis' when s_suppkey%10=5 then 'Ｄ ｅ' when s_suppkey%3=0 then lower({_S}) else {_S} end as organization_country,
 case when l_orderkey%5<>0 then {_NIL} else case s_suppkey%6 when 0 then 'ROR' when 1 then 'GRID' when 2 then 'FUNDREF' when 3 then 'RINGGOLD' else {_NIL} end end as disambiguation_source,
 case when l_orderkey%5<>0 then {_NIL} else case s_suppkey%6 when 0 then 'https://reg.example/'||cast(s_suppkey as string) when 1 then 'GRID.'||cast(s_suppkey as string) when 2 then 'http://dx.doi.org/10.13039/'||cast(s_suppkey as string) when 3 then 'RIN'||cast(s_suppkey as string) else {_NIL} end end as disambiguated_organization_identifier
from {{lineitem}} join {{orders}} on l_orderkey=o_orderkey join {{customer}} on o_custkey=c_custkey join {{part}} on l_partkey=p_partkey join {{supplier}} on l_suppkey=s_suppkey""",
    "gaz": f"""
select cast(p_partkey as string) as geoname_id,
 case p_partkey%3 when 0 then p_name when 1 then substr(p_name,1,instr(p_name,' ')-1)||' bay' else 'port '||p_name end as ascii_name,
 case when p_partkey%3=2 then upper(p_name)||', '||p_type||' town,, ' else {_NIL} end as alternate_names,
 {_P} as country_code, cast(p_partkey%10 as string) as admin1_code, cast(p_partkey%100 as string) as admin2_code, 'Etc/UTC' as timezone
from {{part}}""",
    "reg_name": """
select 'https://reg.example/'||cast(p_partkey as string) as id, case t when 'label' then 'the '||p_name when 'alias' then 'a '||p_brand else case when p_partkey%4=0 then p_type||' '||p_name||' institute' else 'university of '||p_name end end as value, 'en' as lang, t as type
from {part} cross join (values ('ror_display'),('label'),('alias')) x(t) where not (t='ror_display' and p_partkey%7=0)""",
    "reg_ext": """
select 'https://reg.example/'||cast(p_partkey as string) as id, t as type, case t when 'fundref' then cast(p_partkey as string) when 'grid' then ' grid.'||cast(p_partkey as string) else '0000 0000 '||lpad(cast(p_partkey as string),4,'0')||' x' end as value
from {part} cross join (values ('fundref'),('grid'),('isni')) x(t) where p_partkey%5<>0""",
    "reg_loc": f"""
select 'https://reg.example/'||cast(p_partkey as string) as id, cast(p_partkey as string) as geonames_id, {_P} as country_code, p_name as city_name from {{part}}""",
    "ring": """
select cast(s_suppkey as string) as ringgold, case when s_suppkey%2=1 then '0000-0000-'||lpad(cast(s_suppkey as string),4,'0')||'-X' else '' end as isni, s_name as name from {supplier}""",
    "rolemap": f"""
select p_partkey as src_rownum, p_name as role_title_raw, case when p_partkey%3=0 then ' ' else p_type end as edu_level_isced2011, p_brand as career_stage_efrc, cast(p_size as string) as occupation_isco08, {_NIL} as field_fos2015, case p_partkey%3 when 0 then 1 when 1 then 0 else cast(null as int) end as is_academic from {{part}}""",
    "iso": f"""
select distinct {_CODE.format("n_nationkey")} as alpha2 from {{nation}} where n_nationkey<24""",
    "terr": """
select 'XK' as `from`, 'RS' as alpha2 from {region} where r_regionkey=0""",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


def duckdb_view(name: str) -> str:
    return VIEWS[name].replace("{", "").replace("}", "").replace("`", '"')

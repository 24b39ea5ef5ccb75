"""Schemas of the inputs; none is inferred. Nested ones are DDL text, which needs no session to write down."""

from __future__ import annotations

from pyspark.sql import types as T

#: The columns of an affiliation, all text.
AFFILIATION_COLUMNS = (
    "orcid given_names family_name affiliation_type role_title department_name start_date end_date "
    "organization_name organization_city organization_country disambiguation_source disambiguated_organization_identifier"
).split()
AFFILIATION = T.StructType([T.StructField(c, T.StringType()) for c in AFFILIATION_COLUMNS])

_DATE = "year: string, month: string, day: string"


def _summary(name: str) -> str:
    organization = "name: string, address: struct<city: string, country: string>, `disambiguated-organization`: struct<`disambiguated-organization-identifier`: string, `disambiguation-source`: string>"
    return f"struct<`{name}`: array<struct<`role-title`: string, `department-name`: string, `start-date`: struct<{_DATE}>, `end-date`: struct<{_DATE}>, organization: struct<{organization}>>>>"


PERSON = (
    "`orcid-identifier` struct<path: string>, "
    "person struct<name: struct<`given-names`: string, `family-name`: string>>, "
    "`activities-summary` struct<"
    f"educations: struct<`affiliation-group`: array<{_summary('education-summary')}>>, "
    f"employments: struct<`affiliation-group`: array<{_summary('employment-summary')}>>>"
)

REGISTRY = (
    "id string, status string, types array<string>, established int, "
    "admin struct<created: struct<date: string, schema_version: string>, last_modified: struct<date: string, schema_version: string>>, "
    "names array<struct<value: string, lang: string, types: array<string>>>, links array<struct<type: string, value: string>>, "
    "external_ids array<struct<type: string, preferred: string, all: array<string>>>, "
    "locations array<struct<geonames_id: bigint, geonames_details: struct<country_code: string, country_subdivision_code: string, lat: string, lng: string, name: string>>>, "
    "relationships array<struct<type: string, label: string, id: string>>, domains array<string>"
)
RINGGOLD = ("ringgold string, isni string, name string, alt_names string, locality string, admin_area_level_1_short string, post_code string, country_code string, urls string, institution string")
ROLE_MAP = ("role_title_raw string, edu_level_isced2011 string, career_stage_efrc string, occupation_isco08 string, field_fos2015 string, is_academic int")

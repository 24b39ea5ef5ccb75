"""Readers: person XML, affiliation NDJSON, registry JSON and lenient TSVs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affilspark.functions.country import nfkc
from affilspark.functions.text import partial_date
from affilspark.sources.json_array import read_json_array
from affilspark.sources.schemas import AFFILIATION, AFFILIATION_COLUMNS, REGISTRY
from affilspark.sources.xml import records_of, xml_files


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def affiliations_of(records: DataFrame) -> DataFrame:
    """One row per education and employment summary of parsed person records.

    A missing id or name part is '', any other missing element null. Records without summaries give
    no rows. Both branches are one array, so the records are read once.
    """
    date = lambda s, k: partial_date(s[k]["year"], s[k]["month"], s[k]["day"])

    def branch(group: str, summary: str, kind: str):
        found = F.flatten(F.transform(F.coalesce(F.col(f"`activities-summary`.{group}.`affiliation-group`"), F.array()), lambda g: F.coalesce(g[summary], F.array())))
        body = lambda s: F.struct(
            F.lit(kind).alias("affiliation_type"),
            s["role-title"].alias("role_title"),
            s["department-name"].alias("department_name"),
            date(s, "start-date").alias("start_date"),
            date(s, "end-date").alias("end_date"),
            s["organization"]["name"].alias("organization_name"),
            s["organization"]["address"]["city"].alias("organization_city"),
            s["organization"]["address"]["country"].alias("organization_country"),
            s["organization"]["disambiguated-organization"]["disambiguation-source"].alias("disambiguation_source"),
            s["organization"]["disambiguated-organization"]["disambiguated-organization-identifier"].alias("disambiguated_organization_identifier"),
        )
        return F.transform(found, body)

    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    both = F.concat(branch("educations", "education-summary", "education"), branch("employments", "employment-summary", "employment"))
    rows = records.select(
        empty("`orcid-identifier`.path").alias("orcid"),
        empty("person.name.`given-names`").alias("given_names"),
        empty("person.name.`family-name`").alias("family_name"),
        F.explode(both).alias("a"),
    )
    return rows.select("orcid", "given_names", "family_name", "a.*").select(*AFFILIATION_COLUMNS)


def read_person_xml(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """Affiliations in a tree of namespaced XML files with a `record` each; other files and broken ones (see broken_xml) give nothing."""
    return affiliations_of(records_of(xml_files(spark, path, pattern)))


def read_packed_xml(spark: SparkSession, path: str) -> DataFrame:
    """Affiliations of the blocks that pack_xml wrote."""
    return affiliations_of(records_of(spark.read.schema("path string, xml string").parquet(path)))


def parse_person_xml(packed: DataFrame, xml_col: str = "value") -> DataFrame:
    """Affiliations of XML texts kept in a column; texts without a `record` give nothing."""
    return affiliations_of(records_of(packed, xml_col))


def read_affiliation_ndjson(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AFFILIATION).json(path)


def read_registry_json(spark: SparkSession, path: str, schema: T.StructType | str = REGISTRY) -> DataFrame:
    """Registry records of JSON array files, each read by as many tasks as it has blocks (see json_array)."""
    return read_json_array(spark, path, schema)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """A table that write_ordered wrote, with each row's place in its order, from 0.

    Files are in order of the numbers in their names; the counts of rows a file come from Parquet's footers, a row
    for each file.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    number = lambda pattern: F.regexp_extract("_file", pattern, 1).cast("long")
    before = Window.orderBy(number(r"^part-(\d+)"), number(r"-c(\d+)\.")).rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_file").agg(F.count("*").alias("_n")).select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(files, "_file").withColumn(position, F.col("_before") + F.col("_row")).drop("_file", "_row", "_before")


def read_tsv_lenient(spark: SparkSession, path: str, schema: T.StructType | str, drop_long: bool = True) -> DataFrame:
    """A TSV without quoting whose files each begin with a header; short rows end in nulls, long rows are dropped (or cut).

    A field that is not of its column's type is null.
    """
    fields = _struct(schema)
    whole = T.StructType([*fields.fields, T.StructField("_line", T.StringType())])  # the line, where its fields are too few, too many or of another type
    reader = spark.read.schema(whole).option("columnNameOfCorruptRecord", "_line").option("sep", "\t").option("header", True).option("quote", "").option("escape", "").option("mode", "PERMISSIVE")
    rows = reader.option("columnPruning", not drop_long).csv(path)
    if drop_long:
        rows = rows.where(F.col("_line").isNull() | (F.size(F.split("_line", "\t", -1)) <= len(fields)))
    return rows.select(*fields.fieldNames())


def read_tsv_skip(spark: SparkSession, path: str, schema: T.StructType | str, skip: int = 2) -> DataFrame:
    """One small TSV file without a header: `skip` lines left out, '' to null, src_rownum the file order from 1."""
    schema = _struct(schema)
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.posexplode(F.split("value", "\r?\n")).alias("i", "line")).where((F.col("i") >= skip) & (F.col("line") != ""))
    fields = F.split("line", "\t", -1)
    return lines.select((F.col("i") - skip + 1).cast("long").alias("src_rownum"), *[F.nullif(F.get(fields, F.lit(i)), F.lit("")).try_cast(x.dataType).alias(x.name) for i, x in enumerate(schema)])


def read_country_lookups(spark: SparkSession, iso_path: str, territory_path: str) -> tuple[DataFrame, DataFrame]:
    """ISO codes (alpha2) and territories (from, alpha2) in upper case, the latter's names in NFKC and without whitespace. `NA` stays a code."""
    tsv = lambda p, s: spark.read.schema(s).option("sep", "\t").option("header", True).option("nullValue", "\u0000").csv(p)
    code = F.upper("alpha2").alias("alpha2")
    name = F.upper(F.regexp_replace(nfkc("from"), r"(?U)\s+", "")).alias("from")
    return tsv(iso_path, "alpha2 string").select(code), tsv(territory_path, "`from` string, alpha2 string").select(name, code)


def read_if_exists(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet table, or no rows of the schema where the path has none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _struct(schema))

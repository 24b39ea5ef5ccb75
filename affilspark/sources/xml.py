"""Person XML: many small files packed into blocks of (path, xml), and their parsing.

Texts are kept as they stand, with surrounding blanks. A file without a `record` gives nothing; one that is not
well-formed, or whose record is not, is a row of the error table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affilspark.sources.schemas import PERSON

_OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}
_ROOT = r"^(?s)\x{FEFF}?(?:\s|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*(?:\[.*?\])?\s*>)*+<(?:[\w.-]+:)?([\w.-]+)"
_RECORD = r"(?s)(<((?:[\w.-]+:)?record)(?=[\s/>]).*</\2\s*>)"


def xml_files(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """(path, xml) of all files below a folder whose name fits the pattern; Spark packs small files into tasks and skips files of no bytes."""
    whole = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True)
    return whole.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("xml"))


def pack_xml(spark: SparkSession, path: str, out: str, block_bytes: int = 64 << 20, pattern: str = "*.xml") -> None:
    """Writes the files below a folder as Parquet rows (path, xml), in tasks of about block_bytes.

    Millions of small files are opened once; later jobs read a few large ones. The first pass sees sizes only.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    files, size = listed.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(-(-size // block_bytes), min(-(-files // 100), 2 * spark.sparkContext.defaultParallelism), 1)
    xml_files(spark, path, pattern).coalesce(int(tasks)).write.mode("overwrite").option("compression", "zstd").parquet(out)


def _record(xml: Column) -> Column:
    """The text of the first `record`: all of it if that is the root, else what is between its tags; null without one."""
    return F.when(F.regexp_extract(xml, _ROOT, 1) == "record", xml).otherwise(F.nullif(F.regexp_extract(xml, _RECORD, 1), F.lit("")))


def _parsed(packed: DataFrame, xml_col: str) -> DataFrame:
    """path, xml, record and r, its fields; as a generated column r is parsed once, however many conditions and fields are taken from it."""
    own = packed.select(*[c for c in ("path",) if c in packed.columns], F.col(xml_col).alias("xml"), _record(F.col(xml_col)).alias("record"))
    return own.select("*", F.explode(F.array(F.from_xml("record", f"{PERSON}, _corrupt_record string", _OPTIONS))).alias("r"))


def records_of(packed: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Parsed records of (path, xml) rows; without those of the error table."""
    return _parsed(packed, xml_col).where("r is not null and r._corrupt_record is null").select("r.*").drop("_corrupt_record")


def broken_xml(packed: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Rows whose record cannot be read, or without a record and not well-formed: path (where there is one) and xml."""
    rest = F.from_xml(F.col("xml"), "_corrupt_record string", _OPTIONS)["_corrupt_record"].isNotNull()
    bad = F.when(F.col("record").isNotNull(), F.col("r._corrupt_record").isNotNull()).otherwise(rest | (F.trim("xml") == ""))
    return _parsed(packed, xml_col).where(bad).drop("r", "record")

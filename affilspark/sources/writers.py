"""Writers: NDJSON parts, year directories, ordered tables. No pass over the rows is made to cut them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affilspark.functions.text import start_year, year_dir
from affilspark.sources.parts import LineParts

ROWS_PER_FILE, PART_BYTES = 16_384, 16 << 20


def write_ndjson(df: DataFrame, path: str, max_records: int | None = None, max_bytes: int = PART_BYTES) -> None:
    """JSON lines in parts that end at max_bytes of text (by less than a row more) or at max_records rows; null fields are written.

    Overwrites; a failed write leaves the folder as it was.
    """
    df.sparkSession.dataSource.register(LineParts)
    lines = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    writer = lines.write.format("line_parts").mode("overwrite").option("max_bytes", max_bytes)
    (writer.option("max_rows", max_records) if max_records else writer).save(path)


def write_by_year(df: DataFrame, path: str, date_col: str = "start_date", key: str = "orcid", max_records: int = ROWS_PER_FILE) -> None:
    """Parquet in a directory per start year, ordered by person within files.

    Rows are range-partitioned by (year, person): a hot year (`null`, recent ones) is spread over many
    tasks and a task writes few directories.
    """
    year = F.col("start_year") if "start_year" in df.columns else start_year(date_col)
    out = df.withColumn("year_dir", year_dir(year)).repartitionByRange("year_dir", key).sortWithinPartitions("year_dir", key)
    out.write.mode("overwrite").partitionBy("year_dir").option("maxRecordsPerFile", max_records).option("compression", "zstd").parquet(path)


def write_ordered(df: DataFrame, path: str, *order: Column | str, max_records: int = ROWS_PER_FILE) -> None:
    """Parquet in a total order: a range shuffle and sorted files, no global row number. Without an order the rows stay as they come."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").option("maxRecordsPerFile", max_records).option("compression", "zstd").parquet(path)


def by_frequency(count: str = "cnt", *values: str) -> list[Column]:
    """Order: frequency falling, then values, nulls last."""
    return [F.desc(count), *[F.asc_nulls_last(v) for v in values]]


def by_place(country: str, *texts: str) -> list[Column]:
    """Order: country (null as ZZ), then texts (null as '')."""
    return [F.coalesce(F.col(country), F.lit("ZZ")), *[F.coalesce(F.col(t), F.lit("")) for t in texts]]


def by_candidate(*columns: str) -> list[Column]:
    """Order of match candidates: by default key, priority, registry id, source; nulls last."""
    return [F.asc_nulls_last(c) for c in columns or ("org_row_id", "match_priority", "ror_id", "match_source")]

"""What the operators of this subpackage share on the Spark side."""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def session(df: DataFrame) -> SparkSession:
    return df.sparkSession


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder of spark.checkpoint.dir.

    Only where that setting is absent and all runs on one machine (tests) a temporary folder is taken.
    """
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint(eager=True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Lowers the session's Arrow batch size, so that a batch of whole texts takes a few MB on either side."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(*cols: str):
    """128 bits that name a row by its content; rows that agree in all of cols share it."""
    texts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in cols]
    return F.unhex(F.md5(F.concat_ws("\u0001", *texts)))


def row_hashes(*cols):
    """Two 64-bit hashes that name a row by its content, k1 and k2; a null is told from an absent value of its neighbour."""
    each = [x for c in (F.col(c) if isinstance(c, str) else c for c in cols) for x in (c.isNull(), c)]
    return [F.xxhash64(F.lit(i), *each).alias(f"k{i}") for i in (1, 2)]


def fold(id_col: str, modulus: int):
    """crc32(id as text) mod modulus; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def small(df: DataFrame, most: int) -> DataFrame:
    """df with a broadcast hint if a count finds at most `most` rows, else df as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


#: Bits of a bitmap (Spark's bitmap_construct_agg), bitmaps that are sent to every task at most (16 MB in all), and bits for each key.
BITMAP, BITMAPS, BITS_A_KEY = 1 << 15, 1 << 12, 16


def with_hint(rows: DataFrame, keys: DataFrame, key: str, name: str, most: int = BITMAPS) -> DataFrame:
    """rows with a boolean `name`, which is true for every row whose `key` occurs in keys, and for few others.

    Hashed keys are bits of bitmaps that are sent to every task, so rows that are surely not in keys need no
    shuffle; a join must decide on the rest. keys is read twice.
    """
    n = min(most, keys.count() * BITS_A_KEY // BITMAP + 1)
    place = F.pmod(F.xxhash64(key, F.lit(0)), F.lit(n * BITMAP))
    number, bit = F.floor(place / BITMAP).cast("int"), (place % BITMAP).cast("int")
    bitmaps = keys.select(number.alias("_number"), bit.cast("long").alias("_bit")).repartition("_number").groupBy("_number").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    met = rows.withColumn("_number", number).join(F.broadcast(bitmaps), "_number", "left")
    return met.withColumn(name, F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False))).drop("_number", "_bits")


def union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, dfs)


def widen(df: DataFrame, **more: str) -> T.StructType:
    """df's schema with more columns, given as name=type."""
    added = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in more.items()))
    return T.StructType([*df.schema.fields, *added.fields])

"""Helpers of all operators: the folder that executors share, stored frames, word expressions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only in local mode, where there is one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: a lost executor loses nothing of it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, jobs hand tasks at most so many rows at once: the default of 10,000 is meant for short rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Bits of a row's place within a stretch of the bitmap in marked(), and most bits of all stretches together.
_STRETCH, _MOST_BITS = 1 << 15, 1 << 28


def marked(rows: DataFrame, keys: DataFrame, columns: list[str], name: str) -> DataFrame:
    """rows with the boolean column name: false only where no row of keys has the same columns.

    A bitmap of hashes, sixteen bits a row of keys, is broadcast (2 bytes a row, 32 MB at most), so one in
    sixteen other rows is marked by chance. It spares what follows from dealing out rows that match nothing.
    """
    bits = _STRETCH
    while bits < min(16 * keys.count(), _MOST_BITS):
        bits *= 2
    place = F.pmod(F.xxhash64(*columns), F.lit(bits))
    stretch, at = F.floor(place / _STRETCH).cast("int"), F.pmod(place, F.lit(_STRETCH))
    held = keys.groupBy(stretch.alias("_stretch")).agg(F.bitmap_construct_agg(at).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_stretch", stretch).join(F.broadcast(held), "_stretch", "left")
    return found.withColumn(name, F.coalesce(F.getbit(byte, F.pmod(at, F.lit(8))) == 1, F.lit(False))).drop("_stretch", "_bits")


def words(text: Column) -> Column:
    """The runs of other characters than space and U+0009..U+000D; none for null."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def squeezed(text: Column) -> Column:
    """The text without any of those space characters; empty for null."""
    return F.coalesce(F.regexp_replace(text, SPACE, ""), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

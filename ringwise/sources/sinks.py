"""Report sinks. Parquet is the store; CSV is for export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Quotes inside fields are doubled, as spreadsheets write them.
CSV_OPTIONS = {"header": True, "nullValue": "", "emptyValue": "", "lineSep": "\n", "escape": '"'}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file listing, so it works for every store Spark can read."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to path has finished: its job's commit leaves ``_SUCCESS`` there. A folder that a killed
    run left behind (part files, ``_temporary``) does not count. Asked of Hadoop's file system, so every store works."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return bool(marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker))


def _mode(spark: SparkSession, path: str, overwrite: bool) -> str | None:
    """overwrite, or None when a finished write is to be left alone; an unfinished one is replaced."""
    return "overwrite" if overwrite or not is_written(spark, path) else None


def write_csv(df: DataFrame, path: str, overwrite: bool = True, files: int | None = None) -> None:
    """CSV with header and nulls as empty text. Without ``overwrite`` a finished export is left alone, and
    one that a killed run left unfinished is written anew.

    ``files`` merges the output of reports known to be small; large ones keep their parallelism.
    """
    mode = _mode(df.sparkSession, path, overwrite)
    if mode is None:
        return
    out = df if files is None else df.coalesce(files)
    out.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), overwrite: bool = True) -> None:
    mode = _mode(df.sparkSession, path, overwrite)
    if mode is None:
        return
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_split_reports(report: DataFrame, path: str, run_date: date, overwrite: bool = True) -> None:
    """One CSV folder per split below the run date, rows in order of ``file_date``.

    The rows of a split go to one task: that is one line per file date, bounded by the calendar.
    """
    out = report.repartition("split").sortWithinPartitions("split", "file_date").drop("file_date")
    target = f"{path.rstrip('/')}/run_date={run_date.isoformat()}"
    mode = _mode(report.sparkSession, target, overwrite)
    if mode is not None:
        out.write.mode(mode).options(**CSV_OPTIONS).partitionBy("split").csv(target)


def with_run_date(df: DataFrame, run_date: date) -> DataFrame:
    return df.withColumn("run_date", F.lit(run_date))


def with_headers(df: DataFrame, headers: Mapping[str, str]) -> DataFrame:
    """Columns under the names readers of the report know."""
    return df.withColumnsRenamed({k: v for k, v in headers.items() if k in df.columns})


def scrubbed_leads_name(day: date) -> str:
    return f"{day:%Y-%m-%d}_original_refill_data_scrubbed.csv"


def scrub_report_name(day: date) -> str:
    return f"{day:%Y-%m-%d}_initial_scrub_file.csv"


def scrub_transfer_name(stamp: datetime, prefix: str = "Scrub-") -> str:
    return f"{prefix}{stamp:%Y%m%d%H}.csv"

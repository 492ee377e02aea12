"""CSV and JSON drops: all-text scans with the date taken from file or folder names.

Dates come from ``_metadata``, so a date filter on the result skips files at listing
time instead of reading them.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import blank_to_null_words, col, normalize_phone_loose, parse_first, to_utc

LATIN_1 = "ISO-8859-1"

# Columns the operators use -> header in the files. Other columns pass through unchanged.
LEAD_DROP = {
    "record_kind": "H",
    "leadid": "leadid",
    "card_id": "RecipientMemberCardId",
    "dependent_code": "RecipientMemberDependentCode",
    "phone": "RecipientPhoneNumber",
    "contract": "MCO_Contract_Number",
    "stars_1": "Stars_Nonstars_1",
    "stars_2": "Stars_Nonstars_2",
    "stars_3": "Stars_Nonstars_3",
}
CASE_REPORT = {
    "interaction_text": "Interaction Date",
    "disposition": "Disposition",
    "result": "Refill Reminder Result",
    "reason": "Denial Reason",
    "submission": "Refill Submission Result",
    "agent": "Completion By Email",
}
REQUEST_REPORT = {
    "completed_text": "Pharmacy Request Completion Date",
    "clerk": "Pharmacy Request Completion By Email",
    "label": "Pharmacy Request Result",
}
CLAIMS = {"document_key": "Document Key"}


@dataclass(frozen=True)
class DatedFiles:
    """File names of one drop: a glob, the part that is the date (group 1), and its format."""

    glob: str
    date_pattern: str
    date_format: str = "yyyy-MM-dd"

    def file_date(self) -> Column:
        return F.to_date(F.regexp_extract("_metadata.file_name", self.date_pattern, 1), self.date_format)


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


RECORD = "_csv_record_"
SURPLUS = ("fail", "split")


def _options(encoding: str) -> dict:
    # enforceSchema=false checks every file's header instead of mapping columns by position; multiLine keeps a
    # quoted line break inside its field (a file is then read by one task); a row whose field count differs
    # from the header's keeps its raw text in RECORD.
    return {"header": True, "enforceSchema": False, "encoding": encoding, "escape": '"', "multiLine": True, "columnNameOfCorruptRecord": RECORD}


def record_fields(record: Column) -> Column:
    """Number of fields of a raw CSV record: commas outside quoted parts, plus one."""
    return F.size(F.split(F.regexp_replace(record, r'"[^"]*(?:""[^"]*)*"', ""), ",", -1))


def _clean(df: DataFrame, names: Sequence[str], na_words: bool) -> DataFrame:
    """Words for "no value" become null, or (without ``na_words``) missing values become empty text."""
    blank = blank_to_null_words if na_words else (lambda c: F.coalesce(c, F.lit("")))
    return df.withColumns({n: blank(col(n)) for n in names})


def listed_files(
    spark: SparkSession, paths: Sequence[str], glob: str | None = None, recursive: bool = False, where: Column | None = None
) -> list[str]:
    """Files below the paths, from the listing alone; ``where`` may use ``_metadata``. Paths that match nothing are left out."""
    found = set()
    for path in paths:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        try:
            listing = reader.load(path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        if where is not None:
            listing = listing.filter(where)
        found |= {row[0] for row in listing.select("path").collect()}
    return sorted(found)


def file_header(spark: SparkSession, path: str, encoding: str = "UTF-8") -> tuple[str, ...]:
    """Column names in a CSV file's first line, empty for an empty file. Compressed files are told by their suffix."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    stream = where.getFileSystem(conf).open(where)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        if codec is not None:
            stream = codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
        line = reader.readLine()
        while line is not None and line.count('"') % 2:  # a quoted name with a line break goes on
            more = reader.readLine()
            if more is None:
                break
            line += "\n" + more
    finally:
        stream.close()
    return tuple(next(csv.reader([(line or "").removeprefix("\ufeff")]), ()))


def _escaped(path: str) -> str:
    """A file name as a pattern that matches only itself."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _scan(
    spark: SparkSession, paths: Sequence[str], header: Sequence[str], encoding: str, na_words: bool, derived: Mapping[str, Column], surplus: str = "fail"
) -> DataFrame:
    """Rows of files with one header. A row with fewer fields has nulls in the rest; one with more fields fails
    the job (surplus="fail") or, with "split", is marked in RECORD (its raw text) and "_csv_file_" for the caller."""
    if surplus not in SURPLUS:
        raise ValueError(f"surplus must be one of {SURPLUS}")
    df = spark.read.options(**_options(encoding)).schema(string_schema(header).add(RECORD, T.StringType())).csv(list(paths))
    extra = F.col(RECORD).isNotNull() & (record_fields(F.col(RECORD)) > len(header))
    if surplus == "fail":
        # the first field in the message also keeps the scan from being one of the raw record alone, which Spark refuses
        message = F.format_string(
            f"a row of %s has more fields than the {len(header)} of its header: %s (first field %s)", F.col("_metadata.file_path"), F.col(RECORD), col(header[0])
        )
        df = df.filter(F.when(extra, F.raise_error(message)).otherwise(F.lit(True)))
        marks = []
    else:
        # an empty piece of the first field joins the record: a scan of the raw record alone is refused by Spark
        kept = F.concat(F.col(RECORD), F.substring(F.coalesce(col(header[0]), F.lit("")), 1, 0))
        marks = [F.when(extra, kept).alias(RECORD), F.when(extra, F.col("_metadata.file_path")).alias("_csv_file_")]
    names = [c for c in df.columns if c != RECORD]
    return _clean(df.select(*names, *[c.alias(n) for n, c in derived.items()], *marks), names, na_words)


def _united(
    spark: SparkSession, headers: Mapping[str, tuple[str, ...]], encoding: str, na_words: bool, derived: Mapping[str, Column], surplus: str = "fail"
) -> DataFrame | None:
    """One scan for each distinct header, united by name; None without a header."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, header in headers.items():
        if header:
            by_header.setdefault(header, []).append(_escaped(path))
    frames = [_scan(spark, paths, header, encoding, na_words, derived, surplus) for header, paths in by_header.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def read_text_table(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str] | None = None,
    glob: str | None = None,
    recursive: bool = False,
    encoding: str = "UTF-8",
    na_words: bool = True,
    derived: Mapping[str, Column] | None = None,
    where: Column | None = None,
    surplus: str = "fail",
) -> DataFrame:
    """CSV files with all columns as text; a file that cannot be read fails the job.

    A quoted line break stays inside its field. A row with fewer fields than its header has nulls in
    the rest, as pandas reads it; a row with more fields fails the job, naming file and row
    (``read_with_rejects`` returns such rows instead).

    Every file is read under its own header: there is one scan for each distinct header,
    and the scans are united by name. Empty files add nothing. With ``columns`` the headers
    are not looked up; all files are one scan and must have just that header. ``derived``
    columns and ``where``, which picks files before one is opened, may use ``_metadata``.
    Paths that match nothing are left out.
    """
    derived = dict(derived or {})
    files = listed_files(spark, paths, glob, recursive, where)
    if columns is not None:
        headers = dict.fromkeys(files, tuple(columns))
    else:
        with ThreadPoolExecutor(8) as pool:
            headers = dict(zip(files, pool.map(lambda f: file_header(spark, f, encoding), files)))
    found = _united(spark, headers, encoding, na_words, derived, surplus)
    if found is None:
        if columns is None:
            raise FileNotFoundError(f"no files with a header under {list(paths)}")
        empty = spark.createDataFrame([], string_schema(columns))
        return empty.withColumns({n: F.lit(None).cast("date") for n in derived})
    return found


def read_with_rejects(spark: SparkSession, paths: Sequence[str], **options) -> tuple[DataFrame, DataFrame]:
    """Like ``read_text_table``, but rows with more fields than their header are returned apart, as
    (``path``, ``record``: the row's raw text), instead of failing the job. Both frames come from one scan
    of each header; store the first result if both are used, or the files are read twice."""
    found = read_text_table(spark, paths, surplus="split", **options)
    if RECORD not in found.columns:
        return found, spark.createDataFrame([], "path string, record string")
    rejected = F.col(RECORD).isNotNull()
    rows = found.filter(~rejected).drop(RECORD, "_csv_file_")
    return rows, found.filter(rejected).select(F.col("_csv_file_").alias("path"), F.col(RECORD).alias("record"))


def read_readable(
    spark: SparkSession,
    paths: Sequence[str],
    glob: str | None = None,
    recursive: bool = False,
    encoding: str = "UTF-8",
    na_words: bool = True,
    derived: Mapping[str, Column] | None = None,
) -> tuple[DataFrame | None, DataFrame]:
    """Like ``read_text_table``, but leaves out files that cannot be read to the end.

    The second frame says which (``path``, ``error``); the first is None if no file is left. Every file
    is read once more for the check, and a file is taken as a whole or not at all.
    """

    def checked(path: str) -> tuple[str, tuple[str, ...], str | None]:
        try:
            header = file_header(spark, path, encoding)
            spark.read.text(_escaped(path)).count()
        except Exception as e:  # whatever the store or the codec raises is the finding
            return path, (), str(e).splitlines()[0][:500]
        return path, header, None

    with ThreadPoolExecutor(8) as pool:
        results = list(pool.map(checked, listed_files(spark, paths, glob, recursive)))
    skipped = [(path, error) for path, _, error in results if error is not None]
    found = _united(spark, {p: h for p, h, e in results if e is None}, encoding, na_words, dict(derived or {}))
    return found, spark.createDataFrame(skipped, "path string, error string")


def renamed(df: DataFrame, layout: Mapping[str, str]) -> DataFrame:
    """Columns of a layout under their short names; ones the files lack are null, others stay."""
    known = [
        (col(source) if source in df.columns else F.lit(None).cast("string")).alias(target)
        for target, source in layout.items()
    ]
    rest = [col(c) for c in df.columns if c not in layout.values()]
    return df.select(*known, *rest)


def read_dated(
    spark: SparkSession,
    roots: Sequence[str],
    files: DatedFiles,
    first: date | None = None,
    last: date | None = None,
    columns: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Files of one drop with ``file_date`` from their names, optionally only those of a date range."""
    day = files.file_date()
    bounds = ([day >= F.lit(first)] if first is not None else []) + ([day <= F.lit(last)] if last is not None else [])
    where = reduce(Column.__and__, bounds) if bounds else None
    return read_text_table(spark, roots, columns, files.glob, derived={"file_date": day}, where=where, **options)


def read_lead_drops(
    spark: SparkSession,
    roots: Sequence[str],
    files: DatedFiles,
    first: date | None = None,
    last: date | None = None,
    trailer: str = "F",
    **options,
) -> DataFrame:
    """Lead rows without trailer rows; rows without a record kind are dropped as well."""
    drops = renamed(read_dated(spark, roots, files, first, last, **options), LEAD_DROP)
    return drops.filter(F.col("record_kind") != trailer)


def day_folders(base: str, first: date, last: date) -> list[str]:
    """The day folders ``yyyy-MM-dd`` of a range; scans leave out the ones that are missing."""
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    return [f"{base.rstrip('/')}/{d.isoformat()}" for d in days]


def folder_name() -> Column:
    """Name of the folder a row's file lies in."""
    return F.regexp_extract("_metadata.file_path", r"/([^/]+)/[^/]+$", 1)


def folder_days(spark: SparkSession, base: str, glob: str = "*") -> DataFrame:
    """Days that have a folder with files, from the listing alone: no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(base)
    day = F.try_to_timestamp(F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1), F.lit("yyyy-MM-dd")).cast("date")
    return files.select(day.alias("file_date")).filter(F.col("file_date").isNotNull()).distinct()


def read_claims(
    spark: SparkSession, paths: Sequence[str], glob: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Processed claims as ``day, document_key``; folders that are no day and files without a key give nulls."""
    day = F.try_to_timestamp(folder_name(), F.lit("yyyy-MM-dd")).cast("date")
    claims = read_text_table(spark, paths, columns, glob, recursive=True, derived={"day": day})
    return renamed(claims, CLAIMS).select("day", "document_key")


def read_case_report(spark: SparkSession, paths: Sequence[str], timestamp_format: str | None = None) -> DataFrame:
    """Case report with typed ``interaction_ts``; text that is no date fails the job."""
    cases = renamed(read_text_table(spark, paths), CASE_REPORT)
    text = F.col("interaction_text")
    ts = F.to_timestamp_ntz(text, F.lit(timestamp_format)) if timestamp_format else text.cast("timestamp_ntz")
    return cases.withColumn("interaction_ts", ts)


def read_request_report(
    spark: SparkSession, paths: Sequence[str], formats: Sequence[str] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy HH:mm", "MM/dd/yyyy")
) -> DataFrame:
    """Request report with ``completed_ts``; text that fits no format becomes null."""
    rows = renamed(read_text_table(spark, paths), REQUEST_REPORT)
    return rows.withColumn("completed_ts", parse_first(F.col("completed_text"), formats).cast("timestamp_ntz"))


def read_past_reports(
    spark: SparkSession, roots: Sequence[str], glob: str = "*.csv", split_pattern: str = r"^\d{4}-\d{2}-\d{2}_(.*)_weekly"
) -> DataFrame:
    """All exported funnel reports below the roots.

    The split is that of the ``split=`` folder as the export writes it, else it is taken from the file name.
    """
    # the folder name is escaped once by the export and once more in the file's address
    folder = F.regexp_extract("_metadata.file_path", r"/split=([^/]+)/", 1)
    for _ in range(2):
        folder = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    split = F.coalesce(F.nullif(folder, F.lit("")), F.regexp_extract("_metadata.file_name", split_pattern, 1))
    return read_text_table(spark, roots, glob=glob, recursive=True, derived={"split": split})


DNC_PAGE = T.StructType(
    [
        T.StructField(
            "dncList",
            T.StructType(
                [
                    T.StructField("totalRecords", T.StringType()),
                    T.StructField(
                        "dncRecords",
                        T.ArrayType(
                            T.StructType(
                                [T.StructField("phoneNumber", T.StringType()), T.StructField("dateCollected", T.StringType())]
                            )
                        ),
                    ),
                ]
            ),
        )
    ]
)


def read_dnc_pages(spark: SparkSession, paths: Sequence[str], cutoff: datetime | None = None) -> DataFrame:
    """Numbers on landed do-not-call pages, one path per group, as of ``cutoff``.

    A page that is no JSON or lacks its list fails the job, and so does a group whose pages hold
    another number of records than they say in ``totalRecords``: a missing page would free numbers
    for calling.
    """
    groups = []
    for path in paths:
        pages = spark.read.schema(DNC_PAGE).options(multiLine=True, mode="FAILFAST").json(path)
        listed = F.col("dncList.dncRecords")
        pages = pages.select(
            F.when(listed.isNotNull(), listed).otherwise(F.raise_error(F.lit(f"a page under {path} has no records"))).alias("records"),
            F.col("dncList.totalRecords").cast("long").alias("stated"),
        )
        whole = pages.agg(F.sum(F.size("records")).alias("held"), F.min("stated").alias("low"), F.max("stated").alias("high"))
        complete = F.expr("held = low AND held = high")
        message = F.format_string(f"%s of %s records on the pages under {path}", F.col("held"), F.col("high"))
        check = whole.select(F.when(complete, F.lit(True)).otherwise(F.raise_error(message)).alias("complete")).scalar()
        groups.append(pages.filter(check).select(F.inline("records")))
    records = reduce(DataFrame.unionAll, groups)
    if cutoff is not None:
        micros = int(to_utc(cutoff).timestamp() * 1_000_000)
        records = records.filter(F.col("dateCollected").cast("timestamp") <= F.timestamp_micros(F.lit(micros)))
    return records.select(normalize_phone_loose(F.col("phoneNumber")).alias("dnc_number"))

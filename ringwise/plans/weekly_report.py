"""Weekly lead funnel from landed files to exported reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import file_date_label, report_week
from ..operators.funnel import FUNNEL_COLUMNS, impute_rates, weekly_funnel, with_attempt_time
from ..operators.leads import Splits, missing_days, with_member_key
from ..sources.files import (
    LEAD_DROP,
    DatedFiles,
    day_folders,
    folder_days,
    read_dated,
    read_lead_drops,
    read_past_reports,
    renamed,
)
from ..sources.sinks import with_headers, write_split_reports
from .headers import FUNNEL


@dataclass(frozen=True)
class WeeklyInputs:
    """Where the three drops land and how their files are named.

    Leads lie in one folder; scrubbed leads and dispositions in day folders.
    """

    leads: str
    scrubbed: str
    dispositions: str
    lead_files: DatedFiles
    scrubbed_files: DatedFiles
    disposition_files: DatedFiles


def weekly_report(
    spark: SparkSession,
    inputs: WeeklyInputs,
    as_of: date,
    ytd: bool = False,
    contract_splits: Sequence[str] | None = None,
    week: tuple[date, date] | None = None,
    scrub_order: Sequence[str | Column] | None = None,
    inf_policy: str = "null",
) -> DataFrame:
    """Funnel rows per split for the report week, or for the year so far.

    ``contract_splits`` are ``group:star`` texts; ``week`` overrides the week that ends on
    the latest Tuesday before ``as_of``.
    """
    first, last = week or report_week(as_of)
    year = (date(as_of.year, 1, 1), date(as_of.year, 12, 31))
    start, end = year if ytd else (max(first, year[0]), min(last, year[1]))

    def folders(base: str) -> list[str]:
        return [f"{base.rstrip('/')}/*"] if ytd else day_folders(base, first, last)

    leads = with_member_key(read_lead_drops(spark, [inputs.leads], inputs.lead_files, start, end))
    scrubbed = renamed(read_dated(spark, folders(inputs.scrubbed), inputs.scrubbed_files), LEAD_DROP)
    calls = with_attempt_time(read_dated(spark, folders(inputs.dispositions), inputs.disposition_files))
    splits = Splits.parse(contract_splits) if contract_splits else Splits()
    return weekly_funnel(leads, scrubbed, calls, splits, inf_policy, scrub_order)


def missing_input_days(spark: SparkSession, base: str, as_of: date, week: tuple[date, date] | None = None) -> DataFrame:
    """Days of the report week without a folder."""
    first, last = week or report_week(as_of)
    return missing_days(spark, folder_days(spark, base), first, last)


def export_weekly_report(report: DataFrame, path: str, run_date: date, overwrite: bool = False) -> None:
    """One CSV folder per split under known headers, contact date as text."""
    contact_date = file_date_label(F.col("file_date")).alias("contact_date")
    dated = report.select("split", "file_date", contact_date, *FUNNEL_COLUMNS[1:])
    write_split_reports(with_headers(dated, FUNNEL), path, run_date, overwrite)


def reread_reports(spark: SparkSession, roots: Sequence[str], glob: str = "*.csv") -> DataFrame:
    """All exported reports again, as they were written, typed, missing rates filled in, in date order."""
    text = read_past_reports(spark, roots, glob)
    short = text.withColumnsRenamed({header: name for name, header in FUNNEL.items()})
    return impute_rates(short.withColumn("file_date", F.to_date("contact_date", "MM/dd/yyyy")).drop("contact_date"))

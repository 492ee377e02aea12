"""Daily scrub run: who must not be called today, and who is left."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import PACIFIC
from ..operators.scrub import MAX_CONTACT_DAYS, scrub_report, validate_scrub, without_scrubbed
from ..sources.call_log import recent_calls
from ..sources.sinks import is_written, scrub_report_name, scrubbed_leads_name, write_csv


def scrub_run(
    leads: DataFrame,
    dnc: DataFrame,
    calls: DataFrame,
    now: datetime,
    skills: Sequence[str],
    first_day: bool = False,
    max_days: int = MAX_CONTACT_DAYS,
) -> tuple[DataFrame, DataFrame]:
    """Scrub report and remaining leads. ``leads`` are those of the run date, ``calls`` the unified log.

    The run date is the Pacific day of ``now``; call days are days of the log's own clock.
    """
    today = now.astimezone(PACIFIC).date()
    log = None if first_day else recent_calls(calls, skills, now)
    report = scrub_report(leads, dnc, log, today, first_day, max_days)
    return report, without_scrubbed(leads, report)


def write_counted(df: DataFrame, path: str, overwrite: bool) -> int | None:
    """Write and return the row count, observed on the way; None if a finished export was there and had to stay."""
    if not overwrite and is_written(df.sparkSession, path):
        return None
    seen = Observation()
    write_csv(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    return seen.get["rows"]


def export_scrub_run(
    leads: DataFrame, report: DataFrame, path: str, run_date: date, overwrite: bool = False
) -> tuple[int | None, int | None]:
    """Write the report, then the remaining leads matched against the written report.

    Reading the report back keeps its joins from running twice and makes both files agree.
    Returns how many rows each got.
    """
    base = f"{path.rstrip('/')}/{run_date.isoformat()}"
    report_path = f"{base}/{scrub_report_name(run_date)}"
    scrubbed = write_counted(report, report_path, overwrite)
    written = leads.sparkSession.read.schema(report.schema).options(header=True, escape='"').csv(report_path)
    remaining = without_scrubbed(leads, validate_scrub(written))
    return scrubbed, write_counted(remaining, f"{base}/{scrubbed_leads_name(run_date)}", overwrite)

"""Request reports: summary, week by week, and clerks of one day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import week_label
from ..operators.requests import clerk_daily, clerk_daily_long, request_summary, request_weekly_summary
from ..sources.sinks import with_headers, write_csv
from .headers import CLERKS, REQUESTS


def request_reports(
    requests: DataFrame,
    run_date: date,
    bot: str,
    start: date,
    day: date | None = None,
    labels: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """The three frames by name; the clerk report is of ``day``, by default the day before the run.

    It has a row per clerk and label, or with ``labels`` a row per clerk and a column per given label.
    """
    day = day or run_date - timedelta(days=1)
    return {
        "summary": request_summary(requests, start, bot),
        "weekly": request_weekly_summary(requests, start, bot),
        "clerks": clerk_daily_long(requests, day, bot) if labels is None else clerk_daily(requests, day, bot, labels),
    }


def export_request_reports(frames: dict[str, DataFrame], path: str, run_date: date, day: date | None = None) -> None:
    day = day or run_date - timedelta(days=1)
    base, today = f"{path.rstrip('/')}/{run_date.isoformat()}", run_date.isoformat()
    weekly = frames["weekly"].withColumn("week", week_label(F.col("week")))
    write_csv(with_headers(frames["summary"], REQUESTS), f"{base}/pharmacy_request_march_summary_{today}.csv")
    write_csv(with_headers(weekly, REQUESTS), f"{base}/pharmacy_request_weekly_ai_vs_agent_{today}.csv")
    write_csv(with_headers(frames["clerks"], CLERKS), f"{base}/pharmacy_request_clerk_{day.isoformat()}.csv")

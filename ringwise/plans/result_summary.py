"""Result summary, agent scoring and their alerts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions import calendar_week, week_label
from ..operators import agents as ag
from ..operators import alerts as al
from ..operators import outcomes as oc
from ..sources.sinks import with_headers, write_csv, write_table
from .headers import AGENTS, DECLINES, RESULT_SUMMARY, SUBMISSIONS


ALERT_RESULTS = (labels.NO_WORKFLOW, labels.OUT_OF_REFILL, labels.SUBMITTED, labels.ON_OWN)


def result_summary(
    cases: DataFrame,
    claims: DataFrame,
    as_of: date,
    period: str = "weekly",
    reasons: Sequence[str] | None = None,
    submissions: Sequence[str] | None = None,
    min_completed: int = ag.MIN_COMPLETED,
    accepted_threshold: float = ag.ACCEPTED_THRESHOLD,
) -> dict[str, DataFrame]:
    """The reports by name; the two by label have a row per label, or with given lists a column per label.

    The metrics hold, as columns, the labels that alerts are about.
    """
    in_period = ag.agent_summary(ag.completed_cases(cases, as_of, period))
    return {
        "result_summary": oc.weekly_result_summary(cases, oc.weekly_distinct_totals(claims)),
        "decline_reasons": oc.decline_reason_long(cases) if reasons is None else oc.decline_reason_pivot(cases, reasons),
        "submission_results": (
            oc.submission_result_long(cases) if submissions is None else oc.submission_result_pivot(cases, submissions)
        ),
        "decline_metrics": oc.decline_reason_pivot(cases, [labels.DOES_NOT_WANT]),
        "submission_metrics": oc.submission_result_pivot(cases, ALERT_RESULTS),
        "agents": ag.performance_flags(in_period, min_completed, accepted_threshold),
        "agent_thresholds": ag.thresholds(in_period, min_completed, accepted_threshold),
    }


def result_alerts(
    reports: dict[str, DataFrame], as_of: date, accepted_threshold: float = ag.ACCEPTED_THRESHOLD
) -> dict[str, DataFrame]:
    """Alerts over the reports, best given as read back from where they were written."""
    accepted, declines = reports["submission_metrics"], reports["decline_metrics"]
    return {
        "week_over_week": al.week_over_week(accepted, as_of),
        "threshold_alerts": al.threshold_alerts(accepted, declines, as_of),
        "completion_summary": al.completion_summary(reports["result_summary"], accepted, as_of),
        "flagged_agents": al.flagged_agents(reports["agents"], accepted_threshold),
    }


def low_completions(cases: DataFrame, as_of: date, min_completed: int = ag.MIN_COMPLETED) -> DataFrame:
    return ag.under_min_completions(cases, as_of, min_completed)


def with_date_range(weekly: DataFrame) -> DataFrame:
    """The week as ``Date Range`` text in front, for export."""
    rest = [F.col(f"`{c}`") for c in weekly.columns if c != "week"]
    return weekly.select(week_label(F.col("week")).alias("Date Range"), *rest)


def export_result_summary(
    reports: dict[str, DataFrame], path: str, run_date: date, as_of: date, period: str = "weekly"
) -> dict[str, DataFrame]:
    """Store reports and alerts as tables, export the reports as CSV under known headers.

    Alerts and exports read the stored tables, so every report is computed once.
    """
    base, today = f"{path.rstrip('/')}/{run_date.isoformat()}", run_date.isoformat()
    stored = {}
    for key, report in reports.items():
        write_table(report, f"{base}/tables/{key}")
        stored[key] = report.sparkSession.read.parquet(f"{base}/tables/{key}")
    for key, alert in result_alerts(stored, as_of).items():
        write_table(alert, f"{base}/alerts/{key}")

    weekly = {
        f"ytd_refill_result_summary_{today}": ("result_summary", RESULT_SUMMARY),
        f"ytd_decline_reason_counts_{today}": ("decline_reasons", DECLINES),
        f"ytd_refill_submission_result_counts_{today}": ("submission_results", SUBMISSIONS),
    }
    for name, (key, headers) in weekly.items():
        by = ["week", "label"] if "label" in stored[key].columns else ["week"]
        report = with_date_range(stored[key].orderBy(*by))
        write_csv(with_headers(report, headers), f"{base}/{name}.csv", files=1)
    agents = stored["agents"].drop("avg_submitted", "avg_does_not_want")
    agents = agents.orderBy(F.asc_nulls_last("pct_submitted_of_accepted"), "agent")
    write_csv(with_headers(agents, AGENTS), f"{base}/{period}_agent_refill_submission_rate_{as_of.isoformat()}.csv")
    return stored


def export_low_completions(report: DataFrame, path: str, run_date: date, as_of: date) -> None:
    start, _ = calendar_week(as_of)
    name = f"under_100_completions_week_{start.isoformat()}.csv"
    write_csv(with_headers(report, AGENTS), f"{path.rstrip('/')}/{run_date.isoformat()}/{name}")

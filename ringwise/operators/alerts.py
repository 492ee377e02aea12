"""Alerts as rows. Sending them anywhere is left to whoever reads the table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import labels
from ..functions import calendar_week, col, either
from .outcomes import RATIO

DEFAULT_LABEL_LIMIT = 10
DECLINE_SHARE_LIMIT = 25.0


@dataclass(frozen=True)
class Metric:
    column: str
    label: str
    higher_is_better: bool


WEEKLY_METRICS = (
    Metric(f"% {labels.SUBMITTED}", "Refill Submitted Rate", True),
    Metric(f"% {labels.ON_OWN}", "Reminded - Refilled on Own Rate", False),
    Metric(RATIO, "Refilled on Own + No Post Completion : Refill Submitted + Out of Refill", True),
)

CHANGE_SCHEMA = (
    "metric string, previous_week date, current_week date, previous double, current double, "
    "change double, improved boolean, direction string"
)
ALERT_SCHEMA = "alert string, week date, value double, threshold double"

# FIXED VALUES: meaning of each performance flag and what to do about it.
FLAG_MEANINGS = {
    "a": (
        "High Accepted Rate + Low Refill Submissions",
        "Acceptance is good but refill conversion during calls is low. "
        "Inform agent to improve refill submission rate during calls.",
    ),
    "b": (
        "Low Accepted Rate + Low Refill Submissions",
        "Low acceptance and conversion effectiveness. "
        "Highlight for performance improvement / training.",
    ),
    "c": (
        "Low Accepted Rate + High 'Member Does Not Want Refill'",
        "Higher declines observed during calls. "
        "Inform agent to improve objection handling & member communication.",
    ),
}


def week_row(weekly: DataFrame, as_of: date, *columns: Column) -> Column:
    """Aggregate that picks the week around ``as_of``, or the last week there is."""
    monday, _ = calendar_week(as_of)
    return F.max_by(F.struct("week", *columns), F.struct(F.col("week") == F.lit(monday), F.col("week")))


def _weeks(weekly: DataFrame, as_of: date, metrics: list[Metric]) -> DataFrame:
    """One row with the previous and the current week; none if there are fewer than two weeks."""
    values = F.array(*[col(m.column).cast("double") for m in metrics]).alias("values")
    extra = [col(labels.NO_WORKFLOW)] if labels.NO_WORKFLOW in weekly.columns else []
    return weekly.agg(
        F.count(F.lit(1)).alias("weeks"),
        week_row(weekly, as_of - timedelta(weeks=1), values, *extra).alias("prev"),
        week_row(weekly, as_of, values, *extra).alias("curr"),
    ).filter(F.col("weeks") >= 2)


def week_over_week(submissions: DataFrame, as_of: date, metrics: tuple[Metric, ...] = WEEKLY_METRICS) -> DataFrame:
    """Change of each metric from the previous to the current week.

    No change reads "decreased" and not improved. Metrics whose column is missing are
    left out. If the current week has no row, the last week stands in for it, so a week
    can end up compared with itself.
    """
    present = [m for m in metrics if m.column in submissions.columns]
    if not present:
        return submissions.sparkSession.createDataFrame([], CHANGE_SCHEMA)
    weeks = _weeks(submissions, as_of, present)
    entries = F.array(
        *[
            F.struct(
                F.lit(m.label).alias("metric"),
                F.lit(m.higher_is_better).alias("higher_is_better"),
                F.col("prev.values")[i].alias("previous"),
                F.col("curr.values")[i].alias("current"),
            )
            for i, m in enumerate(present)
        ]
    )
    change = F.col("current") - F.col("previous")
    return (
        weeks.select(
            F.col("prev.week").alias("previous_week"), F.col("curr.week").alias("current_week"), F.inline(entries)
        )
        .select(
            "metric",
            "previous_week",
            "current_week",
            "previous",
            "current",
            change.alias("change"),
            either(F.when(F.col("higher_is_better"), change > 0).otherwise(change < 0)).alias("improved"),
            F.when(change > 0, F.lit("increased")).otherwise(F.lit("decreased")).alias("direction"),
        )
    )


def threshold_alerts(
    submissions: DataFrame,
    declines: DataFrame,
    as_of: date,
    label_limit: int = DEFAULT_LABEL_LIMIT,
    share_limit: float = DECLINE_SHARE_LIMIT,
    metrics: tuple[Metric, ...] = WEEKLY_METRICS,
) -> DataFrame:
    """A row per passed threshold: too many cases without a result, too many members who do not want it.

    Nothing is raised before there are two weeks and one metric to compare.
    """
    alerts = []
    present = [m for m in metrics if m.column in submissions.columns]
    if present and labels.NO_WORKFLOW in submissions.columns:
        count = F.col(f"curr.`{labels.NO_WORKFLOW}`")
        alerts.append(
            _weeks(submissions, as_of, present)
            .filter(count > label_limit)
            .select(
                F.lit(labels.NO_WORKFLOW).alias("alert"),
                F.col("curr.week").alias("week"),
                count.cast("double").alias("value"),
                F.lit(float(label_limit)).alias("threshold"),
            )
        )
    share = f"% {labels.DOES_NOT_WANT}"
    if present and share in declines.columns:
        two_weeks = submissions.agg(F.count(F.lit(1)) >= 2).scalar()
        current = declines.agg(week_row(declines, as_of, col(share).alias("share")).alias("curr"))
        alerts.append(
            current.filter((F.col("curr.share") > share_limit) & two_weeks).select(
                F.lit(share).alias("alert"),
                F.col("curr.week").alias("week"),
                F.col("curr.share").alias("value"),
                F.lit(float(share_limit)).alias("threshold"),
            )
        )
    if not alerts:
        return submissions.sparkSession.createDataFrame([], ALERT_SCHEMA)
    return reduce(DataFrame.unionByName, alerts)


def completion_summary(
    results: DataFrame, submissions: DataFrame, as_of: date, metrics: tuple[Metric, ...] = WEEKLY_METRICS
) -> DataFrame:
    """Total and completion shares of the current week.

    Like the other alerts, only once there are two weeks and one metric to compare.
    """
    current = results.agg(week_row(results, as_of, "total", "pct_completed", "pct_not_completed").alias("curr"))
    comparable = F.lit(False)
    if any(m.column in submissions.columns for m in metrics):
        comparable = submissions.agg(F.count(F.lit(1)) >= 2).scalar()
    return current.filter(F.col("curr").isNotNull() & comparable).select("curr.*")


def flag_frame(spark: SparkSession) -> DataFrame:
    rows = [(flag, title, advice) for flag, (title, advice) in FLAG_MEANINGS.items()]
    return labels.literal_frame(spark, rows, "flag string, title string, recommendation string")


def flagged_agents(report: DataFrame, accepted_threshold: float = 84.0) -> DataFrame:
    """One row per agent and flag, with the flag's meaning and the values it was decided on."""
    flagged = report.filter(F.col("performance_flag") != "").withColumn(
        "flag", F.explode(F.split("performance_flag", ", "))
    )
    # Three rows, fixed in code; every agent row has one of three keys, so nothing is shuffled by them.
    return (
        flagged.join(F.broadcast(flag_frame(report.sparkSession)), "flag")
        .select(
            "flag",
            "title",
            "recommendation",
            "agent",
            "total_completed",
            "pct_accepted",
            "pct_submitted_of_accepted",
            "pct_on_own_of_accepted",
            "pct_does_not_want",
            F.lit(accepted_threshold).alias("accepted_rate"),
            "avg_submitted",
            "avg_does_not_want",
        )
        .orderBy("flag", F.asc_nulls_last("pct_submitted_of_accepted"), "agent")
    )

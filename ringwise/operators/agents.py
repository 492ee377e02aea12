"""Agent scoring over completed cases."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions import calendar_week, day_range, either, percent, period_bounds, week_label
from .outcomes import ACCEPTED, DECLINED

COMPLETED = "Completed"
MIN_COMPLETED = 100
ACCEPTED_THRESHOLD = 84.0

# Rates of ``agent_summary``, each in a column ``pct_<name>``.
RATES = (
    "accepted",
    "declined",
    "does_not_want",
    "on_own_of_total",
    "on_own_of_accepted",
    "submitted_of_accepted",
)


def completed_cases(cases: DataFrame, as_of: date | None = None, period: str = "weekly") -> DataFrame:
    """Completed cases, of the day, week or month around ``as_of`` if one is given."""
    completed = cases.filter(F.col("disposition") == COMPLETED)
    if as_of is None:
        return completed
    return completed.filter(day_range(F.col("interaction_ts"), *period_bounds(as_of, period)))


def agent_summary(cases: DataFrame) -> DataFrame:
    """Counts and rates per agent; a rate without a base is null, rows without an agent are dropped."""
    yes, no = F.col("result") == ACCEPTED, F.col("result") == DECLINED
    counts = (
        cases.filter(F.col("agent").isNotNull())
        .groupBy("agent")
        .agg(
            F.count(F.lit(1)).alias("total_completed"),
            F.count_if(yes).alias("accepted"),
            F.count_if(no).alias("declined"),
            F.count_if(no & (F.col("reason") == labels.DOES_NOT_WANT)).alias("does_not_want"),
            F.count_if(yes & (F.col("submission") == labels.ON_OWN)).alias("on_own"),
            F.count_if(yes & (F.col("submission") == labels.SUBMITTED)).alias("submitted"),
        )
    )

    def share(part: str, whole: str) -> Column:
        return percent(F.col(part), F.col(whole))

    return counts.select(
        "agent",
        "total_completed",
        "accepted",
        share("accepted", "total_completed").alias("pct_accepted"),
        "declined",
        share("declined", "total_completed").alias("pct_declined"),
        "does_not_want",
        share("does_not_want", "total_completed").alias("pct_does_not_want"),
        "on_own",
        share("on_own", "total_completed").alias("pct_on_own_of_total"),
        share("on_own", "accepted").alias("pct_on_own_of_accepted"),
        share("submitted", "accepted").alias("pct_submitted_of_accepted"),
    )


def _mean_tenths(rate: str) -> Column:
    """Mean of a one-decimal rate, summed in whole tenths so that row order cannot change it."""
    tenths = F.rint(F.col(rate) * 10).cast("long")
    return F.try_divide(F.sum(tenths), F.count(tenths)) / 10


def performance_stats(agents: DataFrame) -> DataFrame:
    """One row: 75th percentile of own refills and the mean of every rate, nulls skipped.

    Rates have one decimal, so the exact percentile keeps about a thousand distinct
    values at most, however many agents there are. Taking all rates, not just the two
    that decide flags, gives this aggregate the same input as the agent rows, and Spark
    then shuffles the cases once for both.
    """
    return agents.agg(
        F.percentile("pct_on_own_of_accepted", F.lit(0.75)).alias("p75_on_own"),
        *[_mean_tenths(f"pct_{rate}").alias(f"avg_{rate}") for rate in RATES],
    )


def performance_flags(
    agents: DataFrame, min_completed: int = MIN_COMPLETED, accepted_threshold: float = ACCEPTED_THRESHOLD
) -> DataFrame:
    """Agents with enough cases, compared with each other.

    Flag a: accepted well, submitted below average. b: accepted too little and submitted
    below average. c: accepted too little and more "does not want" than average. A null
    rate compares false everywhere. ``avg_submitted`` and ``avg_does_not_want`` ride
    along as columns; ``thresholds`` gives them as one row.
    """
    kept = agents.filter(F.col("total_completed") >= min_completed)
    # The comparison values come in as one-row scalar subqueries, no join involved.
    stats = performance_stats(kept).select(F.struct("*")).scalar()
    compared = kept.withColumn("_stats", stats)
    low_accepted = either(F.col("pct_accepted") < accepted_threshold)
    low_submitted = either(F.col("pct_submitted_of_accepted") < F.col("_stats.avg_submitted_of_accepted"))
    many_unwilling = either(F.col("pct_does_not_want") > F.col("_stats.avg_does_not_want"))
    flag = F.concat_ws(
        ", ",
        F.when(~low_accepted & low_submitted, F.lit("a")),
        F.when(low_accepted & low_submitted, F.lit("b")),
        F.when(low_accepted & many_unwilling, F.lit("c")),
    )
    return compared.select(
        *agents.columns,
        either(F.col("pct_on_own_of_accepted") > F.col("_stats.p75_on_own")).alias("above_75th_percentile"),
        flag.alias("performance_flag"),
        F.col("_stats.avg_submitted_of_accepted").alias("avg_submitted"),
        F.col("_stats.avg_does_not_want").alias("avg_does_not_want"),
    ).orderBy(F.asc_nulls_last("pct_submitted_of_accepted"), "agent")


def thresholds(
    agents: DataFrame, min_completed: int = MIN_COMPLETED, accepted_threshold: float = ACCEPTED_THRESHOLD
) -> DataFrame:
    """The values the flags were decided on, as one row."""
    kept = agents.filter(F.col("total_completed") >= min_completed)
    return performance_stats(kept).select(
        F.lit(min_completed).alias("min_completed"),
        F.lit(accepted_threshold).alias("accepted_rate"),
        F.col("avg_submitted_of_accepted").alias("avg_submitted"),
        "avg_does_not_want",
    )


def agent_report(
    cases: DataFrame,
    as_of: date,
    period: str = "weekly",
    min_completed: int = MIN_COMPLETED,
    accepted_threshold: float = ACCEPTED_THRESHOLD,
) -> DataFrame:
    agents = agent_summary(completed_cases(cases, as_of, period))
    return performance_flags(agents, min_completed, accepted_threshold)


def under_min_completions(cases: DataFrame, as_of: date, min_completed: int = MIN_COMPLETED) -> DataFrame:
    """Agents of the calendar week with fewer than the minimum of completed cases, fewest first."""
    start, _ = calendar_week(as_of)
    agents = agent_summary(completed_cases(cases, as_of, "weekly")).filter(F.col("total_completed") < min_completed)
    rest = [c for c in agents.columns if c != "agent"]
    return agents.select("agent", week_label(F.lit(start)).alias("week"), *rest).orderBy("total_completed", "agent")

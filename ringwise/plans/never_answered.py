"""Numbers that never pick up, and whether they called back."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import UTC, normalize_phone
from ..operators.calls import (
    CallRules,
    Window,
    attach_callbacks,
    inbound_callbacks,
    outbound_both_periods,
    outbound_stats_by_number,
    with_clean_number,
)


def year_windows(
    as_of: date, current_skills: Sequence[str] | None = None, prior_skills: Sequence[str] | None = None
) -> tuple[Window, Window]:
    """The year of ``as_of`` up to the end of that day, and the whole year before, both in UTC."""
    end = datetime.combine(as_of, time(23, 59, 59), UTC)
    prior_year = as_of.year - 1
    return (
        Window(datetime(as_of.year, 1, 1, tzinfo=UTC), end, current_skills),
        Window(datetime(prior_year, 1, 1, tzinfo=UTC), datetime(prior_year, 12, 31, 23, 59, 59, tzinfo=UTC), prior_skills),
    )


def never_answered_report(
    current: DataFrame,
    current_out: Window,
    current_in: Window,
    prior: DataFrame | None = None,
    prior_out: Window | None = None,
    prior_in: Window | None = None,
    min_attempts: int = 3,
    never_answered_only: bool = False,
    clean_first: bool = False,
    rules: CallRules = CallRules(),
    period_labels: tuple[str, str] = ("2026", "2025"),
) -> DataFrame:
    """Attempts, pickups and callbacks per number, over one period or (with ``prior``) two.

    By default numbers are cleaned after counting and callbacks are matched on the
    number as the inbound log writes it; two spellings of one number stay two rows.
    ``clean_first`` cleans all number columns before anything is counted.
    """
    now_label, before_label = period_labels
    if clean_first:
        current, prior = _cleaned(current), None if prior is None else _cleaned(prior)

    if prior is None:
        stats = outbound_stats_by_number(current, current_out, min_attempts, never_answered_only, rules).select(
            "member_phone",
            F.col("total_calls").alias(f"attempts_{now_label}"),
            F.col("attempt_days").alias(f"attempt_days_{now_label}"),
            F.col("answered_calls").alias(f"pickups_{now_label}"),
            F.col("pickup_rate").alias(f"pickup_rate_{now_label}"),
        )
        volume, combined = f"attempts_{now_label}", []
        inbound = [(now_label, current, current_in)]
    else:
        stats = outbound_both_periods(
            current, prior, current_out, prior_out, min_attempts, never_answered_only, rules, period_labels
        ).withColumn("total_attempts_combined", F.col(f"attempts_{now_label}") + F.col(f"attempts_{before_label}"))
        volume, combined = "total_attempts_combined", ["total_attempts_combined"]
        inbound = [(now_label, current, current_in), (before_label, prior, prior_in)]

    periods = [label for label, _, _ in inbound]
    stats = with_clean_number(stats)
    callbacks = [(label, inbound_callbacks(calls, window, stats)) for label, calls, window in inbound]
    result = attach_callbacks(stats, callbacks)
    measures = [f"{m}_{p}" for p in periods for m in ("attempts", "attempt_days", "pickups", "pickup_rate")]
    return result.select(
        "member_phone", *measures, *combined, *[f"inbound_callbacks_{p}" for p in periods], "ever_called_back"
    ).orderBy("ever_called_back", F.desc(volume), "member_phone")


def _cleaned(calls: DataFrame) -> DataFrame:
    columns = ("outbound_number", "inbound_number")
    return calls.withColumns({c: normalize_phone(F.col(c)) for c in columns})

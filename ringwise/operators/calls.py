"""Call-log metrics: skill KPIs, pickup rates, never-answered numbers and callbacks.

Input is the unified call log of ``sources.call_log``: ``ts, disposition, skill,
abandoned, outbound_number, destination, inbound_number``. Everything is aggregated by
number before it is joined, so joins only ever see one row per number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions import normalize_phone, percent, round_np, time_range, utc_literal


@dataclass(frozen=True)
class CallRules:
    """Which dispositions mean what. Defaults are the system label lists."""

    not_dialed: Sequence[str] = field(default_factory=labels.not_dialed_labels)
    answered: Sequence[str] = field(default_factory=lambda: list(labels.ANSWERED))
    converted: Sequence[str] = field(default_factory=lambda: list(labels.CONVERTED))
    completed: str = "Completed"
    abandoned: str = "Abandon"
    unresolved: str = "UNKNOWN"

    def is_dialed(self) -> Column:
        """Null dispositions are neither dialed nor suppressed, so they count nowhere."""
        return ~F.col("disposition").isin(list(self.not_dialed))

    def is_answered(self) -> Column:
        return F.col("disposition").isin(list(self.answered))

    def is_converted(self) -> Column:
        return F.col("disposition").isin(list(self.converted))

    def is_resolved(self) -> Column:
        return ~((F.col("disposition") == self.unresolved) & (F.col("abandoned") == F.lit(False)))


@dataclass(frozen=True)
class Window:
    """Inclusive time bounds (timezone-aware) and the skills in scope; no skills means all."""

    start: datetime
    end: datetime
    skills: Sequence[str] | None = None


def calls_in_scope(calls: DataFrame, window: Window, rules: CallRules, drop_unresolved: bool = True) -> DataFrame:
    scoped = calls.filter(time_range(calls, "ts", window.start, window.end))
    if window.skills is not None:
        scoped = scoped.filter(F.col("skill").isin(list(window.skills)))
    return scoped.filter(rules.is_resolved()) if drop_unresolved else scoped


def pickup_rate(answered: Column, total: Column) -> Column:
    """Percent with two decimals, 0 where nothing was dialed."""
    return F.when(total > 0, percent(answered, total, 2)).otherwise(F.lit(0.0))


def skill_metrics(calls: DataFrame, window: Window, rules: CallRules = CallRules()) -> DataFrame:
    """One row of counts and unrounded rates; conversion is over answered calls, the rest over dialed ones."""
    counts = calls_in_scope(calls, window, rules).agg(
        F.count_if(rules.is_dialed()).alias("total_calls"),
        F.count_if(rules.is_answered()).alias("answered_calls"),
        F.count_if(rules.is_converted()).alias("converted_calls"),
        F.count_if(F.col("disposition") == rules.completed).alias("completed_calls"),
        F.count_if(F.col("disposition") == rules.abandoned).alias("abandoned_calls"),
    )

    def rate(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, percent(F.col(part), F.col(whole), None)).otherwise(F.lit(0.0))

    return counts.select(
        F.array(*[F.lit(s) for s in window.skills or []]).cast("array<string>").alias("skill"),
        utc_literal(calls, "ts", window.start).alias("start_datetime"),
        utc_literal(calls, "ts", window.end).alias("end_datetime"),
        "total_calls",
        "answered_calls",
        "converted_calls",
        "abandoned_calls",
        rate("answered_calls", "total_calls").alias("pickup_rate"),
        rate("converted_calls", "answered_calls").alias("conversion_rate"),
        rate("completed_calls", "total_calls").alias("completion_rate"),
        rate("abandoned_calls", "total_calls").alias("abandon_rate"),
    )


def pickup_rate_by_destination(calls: DataFrame, window: Window, rules: CallRules = CallRules()) -> DataFrame:
    """Dialed and answered calls per destination, best pickup rate first."""
    return (
        calls_in_scope(calls, window, rules)
        .groupBy("destination")
        .agg(
            F.count_if(rules.is_dialed()).alias("total_calls"),
            F.count_if(rules.is_answered()).alias("answered_calls"),
        )
        .withColumn("pickup_rate", pickup_rate(F.col("answered_calls"), F.col("total_calls")))
        .orderBy(F.desc_nulls_last("pickup_rate"), F.asc_nulls_last("destination"))
    )


def calls_per_number(calls: DataFrame, rules: CallRules) -> DataFrame:
    """Attempts, distinct attempt days and pickups per outbound number.

    The distinct day is folded in before the number-wise shuffle, so a number with
    any share of the log arrives as one row per day at most.
    """
    dialed = rules.is_dialed()
    return calls.groupBy(F.col("outbound_number").alias("member_phone")).agg(
        F.count_if(dialed).alias("total_calls"),
        F.count_distinct(F.when(dialed, F.to_date("ts"))).alias("attempt_days"),
        F.count_if(rules.is_answered()).alias("answered_calls"),
    )


def outbound_stats_by_number(
    calls: DataFrame,
    window: Window,
    min_attempts: int = 1,
    never_answered_only: bool = False,
    rules: CallRules = CallRules(),
) -> DataFrame:
    """Numbers dialed on at least ``min_attempts`` days, optionally only those that never picked up."""
    stats = calls_per_number(calls_in_scope(calls, window, rules), rules).filter(
        F.col("attempt_days") >= min_attempts
    )
    if never_answered_only:
        stats = stats.filter(F.col("answered_calls") == 0)
    return stats.withColumn("pickup_rate", pickup_rate(F.col("answered_calls"), F.col("total_calls")))


def _labelled(stats: DataFrame, label: str) -> DataFrame:
    return stats.select(
        "member_phone",
        F.col("total_calls").alias(f"attempts_{label}"),
        F.col("attempt_days").alias(f"attempt_days_{label}"),
        F.col("answered_calls").alias(f"pickups_{label}"),
        pickup_rate(F.col("answered_calls"), F.col("total_calls")).alias(f"pickup_rate_{label}"),
    )


def outbound_both_periods(
    current: DataFrame,
    prior: DataFrame,
    current_window: Window,
    prior_window: Window,
    min_attempts: int = 3,
    never_answered_only: bool = False,
    rules: CallRules = CallRules(),
    period_labels: tuple[str, str] = ("2026", "2025"),
) -> DataFrame:
    """Numbers dialed in both periods; the thresholds bind the current one only.

    Unresolved calls are dropped from the prior period but kept in the current one.
    """
    now = calls_per_number(calls_in_scope(current, current_window, rules, drop_unresolved=False), rules).filter(
        (F.col("total_calls") >= min_attempts) & (F.col("attempt_days") >= min_attempts)
    )
    if never_answered_only:
        now = now.filter(F.col("answered_calls") == 0)
    before = calls_per_number(calls_in_scope(prior, prior_window, rules), rules)
    now_label, before_label = period_labels
    joined = _labelled(now, now_label).join(_labelled(before, before_label), "member_phone")
    measures = [f"{m}_{p}" for p in period_labels for m in ("attempts", "attempt_days", "pickups")]
    rates = [f"pickup_rate_{p}" for p in period_labels]
    return joined.select("member_phone", *measures, *rates)


def inbound_callbacks(
    calls: DataFrame,
    window: Window,
    numbers: DataFrame | Sequence[str] | None = None,
    rules: CallRules = CallRules(),
) -> DataFrame:
    """Inbound calls per number, optionally only for given numbers.

    ``numbers`` is a frame with ``member_phone`` or a short list; None or an empty list
    keeps all. Calls are counted per number first, which every task folds before the shuffle,
    so a number on a third of all calls arrives as one row a task; the semi join then meets one
    row per number on each side, and no raw call is shuffled by number.
    """
    scoped = calls_in_scope(calls, window, rules, drop_unresolved=False).withColumn(
        "member_phone", F.col("inbound_number")
    )
    if numbers is not None and not isinstance(numbers, DataFrame):
        if numbers:
            scoped = scoped.filter(F.col("member_phone").isin(list(numbers)))
        numbers = None
    counted = scoped.groupBy("member_phone").agg(F.count(F.lit(1)).alias("inbound_calls"))
    if numbers is not None:
        counted = counted.join(numbers.select("member_phone"), "member_phone", "left_semi")
    return counted


def never_answered_destinations(calls: DataFrame, numbers: DataFrame, rules: CallRules = CallRules()) -> DataFrame:
    """Those of the given ``destination`` numbers that no call in the log ever reached.

    Calls are counted per destination before the semi join (folded in every task), so a hot
    destination is one row a task and the join meets one row per number.
    """
    counted = calls.groupBy("destination").agg(
        F.count_if(rules.is_dialed()).alias("total_calls"),
        F.count_if(rules.is_answered()).alias("answered_calls"),
    )
    return counted.filter(F.col("answered_calls") == 0).join(numbers.select("destination"), "destination", "left_semi")


def with_clean_number(df: DataFrame, column: str = "member_phone") -> DataFrame:
    """Normalise a number column and drop rows whose number is unusable."""
    return df.withColumn(column, normalize_phone(F.col(column))).filter(F.col(column).isNotNull())


def attach_callbacks(stats: DataFrame, callbacks: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Left-join callback counts, one ``(period label, frame)`` each, and say whether anyone called back."""
    result = stats
    for label, frame in callbacks:
        column = f"inbound_callbacks_{label}"
        counted = frame.select("member_phone", F.col("inbound_calls").alias(column))
        result = result.join(counted, "member_phone", "left").withColumn(column, F.coalesce(column, F.lit(0)))
    total = sum((F.col(f"inbound_callbacks_{label}") for label, _ in callbacks), F.lit(0))
    return result.withColumn("ever_called_back", total > 0)

"""Weekly outcome reports: totals, decline reasons and submission results.

Input is the case report with typed ``interaction_ts`` plus ``result``, ``reason`` and
``submission``. Frames are keyed by the Monday of the week; labels are for output.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions import blank_to_default, col, percent, round_np, safe_ratio, week_start

ACCEPTED, DECLINED = "Yes", "No"
RATIO = "follow_up_ratio"


def with_week(cases: DataFrame, ts: str = "interaction_ts") -> DataFrame:
    return cases.withColumn("week", week_start(F.col(ts)))


def weekly_distinct_totals(claims: DataFrame, day: str = "day", key: str = "document_key") -> DataFrame:
    """Distinct document keys per day, summed per week; a key on two days counts twice.

    Keys are folded per (day, key) first, so a day with any share of the rows spreads out.
    """
    per_day = claims.filter(F.col(day).isNotNull()).groupBy(day).agg(F.count_distinct(key).alias("keys"))
    return per_day.groupBy(week_start(F.col(day)).alias("week")).agg(F.sum("keys").alias("total"))


def weekly_result_summary(cases: DataFrame, week_totals: DataFrame, inf_policy: str = "null") -> DataFrame:
    """Accepted, declined and not-completed counts and shares of the week's total."""
    counts = (
        with_week(cases)
        .filter(F.col("week").isNotNull())
        .groupBy("week")
        .agg(
            F.count_if(F.col("result") == ACCEPTED).alias("accepted"),
            F.count_if(F.col("result") == DECLINED).alias("declined"),
        )
    )
    total = F.col("total")
    rest = F.greatest(total - F.col("accepted") - F.col("declined"), F.lit(0))
    return (
        counts.join(week_totals, "week", "left")
        .withColumn("total", F.coalesce("total", F.lit(0)).cast("long"))
        .withColumn("not_completed", rest)
        .withColumns(
            {
                f"pct_{name}": percent(F.col(name), total, 1, None, inf_policy)
                for name in ("accepted", "declined", "not_completed")
            }
        )
        .withColumn("pct_completed", round_np(F.col("pct_accepted") + F.col("pct_declined"), 1))
        .orderBy("week")
    )


def label_counts(rows: DataFrame, label: str, keys: Sequence[str] = ("week",)) -> DataFrame:
    """Long form: rows per key and label, unknown labels dropped."""
    return (
        rows.filter(F.col(label).isNotNull())
        .groupBy(*keys, F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def label_shares(rows: DataFrame, label: str, total: str, key: str = "week") -> DataFrame:
    """Long form with the total of all labelled rows per key and each label's share of it.

    The total is summed from the counts per label, so the rows are shuffled once.
    """
    counts = label_counts(rows, label, (key,))
    totals = counts.groupBy(key).agg(F.sum("rows").alias(total))
    return counts.join(totals, key).withColumn("share", percent(F.col("rows"), F.col(total))).orderBy(key, "label")


def pivot_counts(rows: DataFrame, label: str, values: Sequence[str], total: str) -> DataFrame:
    """Weekly counts, one column per label, zero-filled, and the total over all labels.

    One conditional aggregate instead of a pivot keeps it at a single shuffle. The
    total counts every labelled row, also those whose label is not among ``values``.
    """
    counts = [F.count_if(F.col(label) == v).alias(v) for v in values]
    return (
        rows.filter(F.col(label).isNotNull())
        .groupBy("week")
        .agg(*counts, F.count(F.lit(1)).alias(total))
    )


def with_shares(wide: DataFrame, values: Sequence[str], total: str) -> DataFrame:
    """``% <label>`` of the total for each label column."""
    return wide.withColumns({f"% {v}": percent(col(v), F.col(total)) for v in values})


def add_total_and_shares(wide: DataFrame, skip: Sequence[str] = (), total: str = "total") -> DataFrame:
    """Row sum and shares over whatever count columns a frame has; non-numbers count as nothing."""
    counts = [c for c in wide.columns if c not in skip]
    numbers = {c: col(c).try_cast("double") for c in counts}
    row_sum = reduce(Column.__add__, [F.coalesce(x, F.lit(0.0)) for x in numbers.values()], F.lit(0.0))
    return wide.withColumn(total, row_sum).withColumns(
        {f"% {c}": percent(x, F.col(total)) for c, x in numbers.items()}
    )


def _declined(cases: DataFrame) -> DataFrame:
    return with_week(cases).filter(F.col("result") == DECLINED)


def _accepted(cases: DataFrame, default: str) -> DataFrame:
    accepted = with_week(cases).filter(F.col("result") == ACCEPTED)
    return accepted.withColumn("submission", blank_to_default(F.col("submission"), default))


def decline_reason_long(cases: DataFrame) -> DataFrame:
    """Declined cases per week and reason, with the week's total and the share; any number of reasons."""
    return label_shares(_declined(cases), "reason", "total_declined")


def decline_reason_pivot(cases: DataFrame, values: Sequence[str]) -> DataFrame:
    """Declined cases per week, a column per given reason, with total and shares."""
    wide = pivot_counts(_declined(cases), "reason", list(values), "total_declined")
    return with_shares(wide, values, "total_declined").orderBy("week")


def submission_result_long(cases: DataFrame, default: str = labels.NO_WORKFLOW) -> DataFrame:
    """Accepted cases per week and submission result, with the week's total and the share; any number of results."""
    return label_shares(_accepted(cases, default), "submission", "total_accepted")


def submission_result_pivot(cases: DataFrame, values: Sequence[str], default: str = labels.NO_WORKFLOW) -> DataFrame:
    """Accepted cases per week, a column per given submission result, with total, shares and follow-up ratio.

    The ratio sets cases that still need follow-up (refilled on own, or no result at
    all) against the ones settled in the call; null while nothing was settled.
    """
    wide = pivot_counts(_accepted(cases, default), "submission", list(values), "total_accepted")

    def count(name: str) -> Column:
        return col(name) if name in values else F.lit(0)

    pending = count(labels.ON_OWN) + count(default)
    settled = count(labels.SUBMITTED) + count(labels.OUT_OF_REFILL)
    ratio = round_np(safe_ratio(pending, F.when(settled > 0, settled)), 2)
    return with_shares(wide.withColumn(RATIO, ratio), values, "total_accepted").orderBy("week")

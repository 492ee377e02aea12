"""Weekly lead funnel, all splits in one job.

Lead drops ``L``, scrubbed leads ``E`` and disposition rows ``D`` are each reduced to
counts before anything is joined:

* ``L`` gives, per member key, the splits it belongs to, and per lead its contact date
  in every split; both have one row per key and one column per split.
* ``E`` and ``D`` are grouped by what the joins need (dates, member, lead), which folds
  repeated leads and filler keys inside the input tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import labels
from ..functions import any_of, attempt_timestamp, count_text, either, percent, rate_text
from .leads import STATUS_COLUMNS, Splits, cols, contract_star_splits, dedup_leads
from .skew import ROWS_PER_SLICE, spread_join

FUNNEL_COLUMNS = [
    "file_date",
    "leads_received",
    "leads_available",
    "attempted_leads",
    "attempt_rate",
    "available_for_second",
    "second_attempts",
    "second_attempt_rate",
    "reached_leads",
    "reach_rate",
    "submitted",
    "on_own",
    "refill_of_reached_rate",
    "submitted_of_reached_rate",
    "refill_request",
    "scrub_rate",
    "refill_of_attempted_rate",
    "submitted_of_attempted_rate",
]


def status_flags(statuses: Sequence[str] = STATUS_COLUMNS) -> dict[str, Column]:
    """Row flags over the parallel status columns: reached, and each outcome counted on its own."""
    status = cols(statuses)
    return {
        "reached": any_of(status, labels.REACHED),
        "submitted": any_of(status, [labels.SUBMITTED]),
        "refill_request": any_of(status, [labels.OUT_OF_REFILL]),
        "on_own": any_of(status, [labels.ON_OWN]),
    }


def with_attempt_time(dispositions: DataFrame, text: str = "contact_attempt_date_time") -> DataFrame:
    return dispositions.withColumn("attempt_ts", attempt_timestamp(F.col(text)))


def member_splits(leads: DataFrame, splits: Splits) -> DataFrame:
    """Per member key: ``in_<i>``, whether any of its leads is in split ``i``."""
    flags = [F.bool_or(c).alias(f"in_{i}") for i, c in enumerate(splits.conditions())]
    return leads.groupBy("idcard_mbr_id").agg(*flags)


def lead_index_dates(leads: DataFrame, splits: Splits) -> DataFrame:
    """Per lead: ``index_<i>``, its last file date among the leads of split ``i``."""
    dates = [F.max(F.when(c, F.col("file_date"))).alias(f"index_{i}") for i, c in enumerate(splits.conditions())]
    return leads.filter(F.col("leadid").isNotNull()).groupBy("leadid").agg(*dates)


def received_counts(leads: DataFrame, splits: Splits) -> DataFrame:
    in_splits = contract_star_splits(leads, splits)
    return in_splits.groupBy("split", "file_date").agg(F.count(F.lit(1)).alias("leads_received"))


def available_counts(
    scrubbed: DataFrame, members: DataFrame, splits: Splits, order: Sequence[str | Column] | None = None
) -> DataFrame:
    """Deduplicated scrubbed leads per split and date, matched on member key and star."""
    stars = [c.alias(f"star_{i}") for i, c in enumerate(splits.star_conditions())]
    star_names = [f"star_{i}" for i in range(len(stars))]
    grouped = (
        dedup_leads(scrubbed, order)
        .select("file_date", "idcard_mbr_id", *stars)
        .groupBy("file_date", "idcard_mbr_id", *star_names)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    matched = grouped.alias("e").join(
        members.alias("m"), F.col("e.idcard_mbr_id").eqNullSafe(F.col("m.idcard_mbr_id"))
    )
    conditions = [F.col(f"in_{i}") & F.col(f"star_{i}") for i in range(len(stars))]
    return (
        matched.select("file_date", "rows", F.explode(splits.entries(conditions)).alias("split"))
        .filter(F.col("split").isNotNull())
        .groupBy("split", "file_date")
        .agg(F.sum("rows").alias("leads_available"))
    )


def split_calls(dated: DataFrame, splits: Splits, measures: Sequence[str]) -> DataFrame:
    """Folded calls once per split of their member; those on another day than the lead's carry no lead."""
    n = len(splits.names)
    on_day = [either(F.col("attempt_date") == F.col(f"index_{i}")) for i in range(n)]
    entries = splits.entries([F.col(f"in_{i}") for i in range(n)], right_day=on_day)
    return (
        dated.select("file_date", "leadid", *measures, F.explode(entries).alias("s"))
        .filter(F.col("s").isNotNull())
        .select("file_date", F.when(F.col("s.right_day"), F.col("leadid")).alias("leadid"), *measures, "s.split", "s.right_day")
    )


def contact_counts(
    dispositions: DataFrame,
    members: DataFrame,
    index_dates: DataFrame,
    splits: Splits,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Attempt, second-attempt, reached and outcome counts per split and report date.

    Attempts need the call to fall on the lead's contact date; reached and outcome
    counts take every row. A lead's first call decides whether a second one is allowed;
    of calls at the very same time a final one counts as first, as in ``first_disposition``,
    which lets time of day and flag travel as one sortable long. Only right-day calls are
    kept apart by lead; all others meet in one group per split and date, without a lead,
    inside the input tasks, since their outcome counts are sums over leads anyway. Hot keys of both joins are
    counted on the folded rows, whose shuffle is read again for it.
    """
    flags = status_flags()
    attempt = F.col("attempt_ts")
    millis = (
        (F.hour(attempt) * 60 + F.minute(attempt)) * 60000 + F.extract(F.lit("SECOND"), attempt) * 1000
    ).cast("long")
    retryable = F.when(any_of(cols(STATUS_COLUMNS), labels.RETRYABLE), 1).otherwise(0)
    rows = dispositions.select(
        "file_date",
        "idcard_mbr_id",
        "leadid",
        F.to_date(attempt).alias("attempt_date"),
        (millis * 2 + retryable).alias("first_call"),
        *[flag.alias(name) for name, flag in flags.items()],
    )
    folded = rows.groupBy("file_date", "idcard_mbr_id", "leadid", "attempt_date").agg(
        F.count(F.lit(1)).alias("calls"),
        F.min("first_call").alias("first_call"),
        *[F.count_if(F.col(name)).alias(name) for name in flags],
    )
    in_member = spread_join(
        folded,
        members,
        ["idcard_mbr_id"],
        "inner",
        null_safe=True,
        counted=folded.select("idcard_mbr_id"),
        rows_per_slice=rows_per_slice,
    )
    dated = spread_join(
        in_member, index_dates, ["leadid"], "left", counted=folded.select("leadid"), rows_per_slice=rows_per_slice
    )

    measures = ["calls", "first_call", *flags]
    per_split = split_calls(dated, splits, measures)
    per_lead = per_split.groupBy("split", "file_date", "leadid").agg(
        F.sum(F.when(F.col("right_day"), F.col("calls"))).alias("day_calls"),
        F.min(F.when(F.col("right_day"), F.col("first_call"))).alias("day_first"),
        *[F.sum(name).alias(name) for name in flags],
    )
    known = F.col("leadid").isNotNull()
    return per_lead.groupBy("split", "file_date").agg(
        F.count_if(known & (F.col("day_calls") >= 1)).alias("attempted_leads"),
        F.count_if(known & (F.col("day_calls") >= 2)).alias("second_attempts"),
        F.count_if(known & (F.col("day_first") % 2 == 1)).alias("available_for_second"),
        F.sum("reached").alias("reached_leads"),
        *[F.sum(name).alias(name) for name in ("submitted", "refill_request", "on_own")],
    )


def funnel_rates(counts: DataFrame, inf_policy: str = "null", keys: Sequence[str] = ("split",)) -> DataFrame:
    """The eight percentages, one decimal, and the final column order."""
    c = F.col

    def rate(num: Column, den: Column, fill: float | None) -> Column:
        return percent(num, den, 1, fill, inf_policy)

    refilled = c("submitted") + c("on_own")
    # Dates without scrubbed leads and attempts keep null reach rates; the two rates over
    # attempted leads are 0 there.
    counted = c("attempted_leads").isNotNull()
    return counts.withColumns(
        {
            "attempt_rate": rate(c("attempted_leads"), c("leads_available"), None),
            "second_attempt_rate": rate(c("second_attempts"), c("leads_available"), None),
            "reach_rate": F.when(counted, rate(c("reached_leads"), c("attempted_leads"), 0.0)),
            "refill_of_reached_rate": F.when(counted, rate(refilled, c("reached_leads"), 0.0)),
            "submitted_of_reached_rate": F.when(counted, rate(c("submitted"), c("reached_leads"), 0.0)),
            "scrub_rate": rate(c("leads_received") - c("leads_available"), c("leads_received"), None),
            "refill_of_attempted_rate": rate(refilled, c("attempted_leads"), 0.0),
            "submitted_of_attempted_rate": rate(c("submitted"), c("attempted_leads"), 0.0),
        }
    ).select(*keys, *FUNNEL_COLUMNS)


def weekly_funnel(
    leads: DataFrame,
    scrubbed: DataFrame,
    dispositions: DataFrame,
    splits: Splits | None = None,
    inf_policy: str = "null",
    scrub_order: Sequence[str | Column] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """One row per split and lead file date.

    Splits without a lead or without an available scrubbed lead give no rows. A date
    has counts only if the split has scrubbed leads or right-day attempts on it; the
    others keep null counts, as in the outer join of the two.
    """
    splits = splits or Splits()
    keys = ["split", "file_date"]
    members = member_splits(leads, splits)
    received = received_counts(leads, splits)
    available = available_counts(scrubbed, members, splits, scrub_order)
    contacts = contact_counts(dispositions, members, lead_index_dates(leads, splits), splits, rows_per_slice)

    counts = ["attempted_leads", "second_attempts", "available_for_second"]
    outcomes = ["reached_leads", "submitted", "refill_request", "on_own"]
    # Available dates without received leads still make their split count as reported.
    reported = F.count("leads_available").over(Window.partitionBy("split")) > 0
    dates = received.join(available, keys, "full_outer").withColumn("reported", reported)
    joined = dates.filter(F.col("reported") & F.col("leads_received").isNotNull()).join(contacts, keys, "left")
    has_counts = F.col("leads_available").isNotNull() | (F.col("attempted_leads") > 0)
    filled = joined.withColumns(
        {name: F.when(has_counts, F.coalesce(name, F.lit(0))) for name in [*counts, *outcomes]}
    )
    return funnel_rates(filled, inf_policy)


def impute_rates(reports: DataFrame) -> DataFrame:
    """Re-read report rows: typed counts, and the three rates filled in where they are missing."""
    c = F.col
    counts = ["leads_available", "submitted", "on_own", "attempted_leads", "reached_leads"]
    rates = ["scrub_rate", "refill_of_attempted_rate", "submitted_of_attempted_rate"]
    typed = reports.withColumns(
        {
            "leads_received": c("leads_received").cast("long"),
            **{name: count_text(c(name)) for name in counts},
            **{name: rate_text(c(name)) for name in rates},
        }
    )
    refilled = c("submitted") + c("on_own")
    return typed.withColumns(
        {
            "scrub_rate": F.coalesce(
                "scrub_rate", percent(c("leads_received") - c("leads_available"), c("leads_received"))
            ),
            "refill_of_attempted_rate": F.coalesce("refill_of_attempted_rate", percent(refilled, c("attempted_leads"))),
            "submitted_of_attempted_rate": F.coalesce(
                "submitted_of_attempted_rate", percent(c("submitted"), c("attempted_leads"))
            ),
        }
    ).orderBy("file_date")


def reports_of_year(reports: DataFrame, year: int, column: str = "file_date") -> DataFrame:
    """Rows of one calendar year, as a date range that can prune."""
    return reports.filter(F.col(column).between(F.lit(date(year, 1, 1)), F.lit(date(year, 12, 31))))

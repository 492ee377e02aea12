"""Lead scrubbing: do-not-call, called yesterday, call fatigue, and what remains.

Leads carry ``leadid, phone, card_id, dependent_code``; the call log ``number, ts``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions import day_range, member_key
from .leads import keep_first
from .skew import ROWS_PER_SLICE, distinct_keys, spread_join

SCRUB_COLUMNS = ["leadid", "scrub_reason", "idcard_mbr_id", "scrub_date"]
MAX_CONTACT_DAYS = 4

# Which rule wins when a lead is hit by several.
_RULES = ((1, labels.DO_NOT_CALL), (2, labels.MAX_ATTEMPTS), (3, labels.MAX_ATTEMPTS))


class InvalidScrubFormat(ValueError):
    """The scrub table lacks a column, has one too many, or gives an unknown reason."""


def scrub_rows(leads: DataFrame, reason: str | Column, today: date) -> DataFrame:
    """Leads in the layout of the scrub table."""
    return leads.select(
        "leadid",
        (F.lit(reason) if isinstance(reason, str) else reason).alias("scrub_reason"),
        member_key(F.col("card_id"), F.col("dependent_code")).alias("idcard_mbr_id"),
        F.lit(today.isoformat()).alias("scrub_date"),
    )


def dnc_numbers(dnc: DataFrame, column: str = "dnc_number") -> DataFrame:
    return dnc.select(F.col(column).alias("phone"))


def numbers_called_on(log: DataFrame, day: date) -> DataFrame:
    return log.filter(day_range(F.col("ts"), day, day)).select(F.col("number").alias("phone"))


def fatigued_numbers(log: DataFrame, today: date, max_days: int = MAX_CONTACT_DAYS) -> DataFrame:
    """Numbers called on at least ``max_days`` different days before today; unknown numbers never are."""
    before = log.filter((F.col("ts") < F.lit(today)) & F.col("number").isNotNull())
    days = before.groupBy(F.col("number").alias("phone")).agg(F.count_distinct(F.to_date("ts")).alias("days"))
    return days.filter(F.col("days") >= max_days).select("phone")


def numbers_past_call_limit(dialer: DataFrame, limit: int = 2) -> DataFrame:
    """Numbers with at least ``limit`` different contact dates, an unknown date counting as one."""
    days = (
        dialer.filter(F.col("phone").isNotNull())
        .groupBy("phone")
        .agg((F.count_distinct("contact_date") + F.max(F.col("contact_date").isNull().cast("int"))).alias("days"))
    )
    return days.filter(F.col("days") >= limit).select("phone")


def _leads_with(leads: DataFrame, numbers: DataFrame, rows_per_slice: int) -> DataFrame:
    numbers = distinct_keys(numbers, ["phone"])
    return spread_join(leads, numbers, ["phone"], "left_semi", null_safe=True, rows_per_slice=rows_per_slice)


def members_on_dnc_list(
    leads: DataFrame, dnc: DataFrame, column: str = "dnc_number", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Leads whose phone is on the list; a missing phone matches a missing number."""
    return _leads_with(leads, dnc_numbers(dnc, column), rows_per_slice)


def members_called_yesterday(
    leads: DataFrame, log: DataFrame, today: date, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    hit = _leads_with(leads, numbers_called_on(log, today - timedelta(days=1)), rows_per_slice)
    return scrub_rows(hit, labels.MAX_ATTEMPTS, today)


def fatigued_members(
    leads: DataFrame,
    log: DataFrame,
    today: date,
    max_days: int = MAX_CONTACT_DAYS,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    hit = _leads_with(leads, fatigued_numbers(log, today, max_days), rows_per_slice)
    return scrub_rows(hit, labels.MAX_ATTEMPTS, today)


def members_past_call_limit(
    leads: DataFrame, dialer: DataFrame, limit: int = 2, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    return _leads_with(leads, numbers_past_call_limit(dialer, limit), rows_per_slice)


def scrub_report(
    leads: DataFrame,
    dnc: DataFrame,
    log: DataFrame | None,
    today: date,
    first_day: bool = False,
    max_days: int = MAX_CONTACT_DAYS,
    dnc_column: str = "dnc_number",
    order: Sequence[str | Column] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Each lead to drop, once, with the first rule that hits it.

    The number lists of all rules are folded into one list with the best rule per
    number, so the leads are matched once and not once per rule. A lead with several
    rows keeps the one under the best rule, then the first in ``order``.
    """
    lists = [dnc_numbers(dnc, dnc_column)]
    if not first_day:
        lists += [numbers_called_on(log, today - timedelta(days=1)), fatigued_numbers(log, today, max_days)]
    ruled = [numbers.withColumn("rule", F.lit(rule)) for numbers, (rule, _) in zip(lists, _RULES)]
    blocked = ruled[0]
    for numbers in ruled[1:]:
        blocked = blocked.unionByName(numbers)
    blocked = blocked.groupBy("phone").agg(F.min("rule").alias("rule"))

    columns = ["leadid", "phone", "card_id", "dependent_code"]
    ordered = leads.select(*columns) if order is None else leads
    hit = spread_join(ordered, blocked, ["phone"], "inner", null_safe=True, rows_per_slice=rows_per_slice)
    first = keep_first(hit, ["leadid"], ["rule", *(order or columns)])
    reason = F.when(F.col("rule") == 1, F.lit(labels.DO_NOT_CALL)).otherwise(F.lit(labels.MAX_ATTEMPTS))
    return scrub_rows(first, reason, today)


def without_scrubbed(leads: DataFrame, scrub: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Leads whose member key is not in the scrub table; a missing key matches a missing key."""
    keyed = leads.withColumn("idcard_mbr_id", member_key(F.col("card_id"), F.col("dependent_code")))
    keys = distinct_keys(scrub, ["idcard_mbr_id"])
    return spread_join(keyed, keys, ["idcard_mbr_id"], "left_anti", null_safe=True, rows_per_slice=rows_per_slice)


def check_scrub_columns(scrub: DataFrame) -> None:
    missing, extra = set(SCRUB_COLUMNS) - set(scrub.columns), set(scrub.columns) - set(SCRUB_COLUMNS)
    if missing or extra:
        raise InvalidScrubFormat(f"missing scrub columns: {sorted(missing)}, extra ones: {sorted(extra)}")


def scrub_violations(scrub: DataFrame, allowed: Sequence[str] = tuple(labels.SCRUB_REASONS)) -> DataFrame:
    """Rows per reason that is unknown or missing."""
    reason = F.col("scrub_reason")
    bad = scrub.filter(reason.isNull() | ~reason.isin(list(allowed)))
    return bad.groupBy("scrub_reason").agg(F.count(F.lit(1)).alias("rows"))


def validate_scrub(scrub: DataFrame) -> DataFrame:
    """The frame itself, or an error. Looks for one bad row only."""
    check_scrub_columns(scrub)
    bad = scrub_violations(scrub).select("scrub_reason").limit(5).collect()
    if bad:
        raise InvalidScrubFormat(f"unknown scrub reasons, among them: {[row[0] for row in bad]}")
    return scrub

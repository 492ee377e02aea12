"""Request reports: bot account against people, and clerks per day.

Input is the request report with typed ``completed_ts`` (null if unreadable), ``clerk``
(mail) and ``label``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import labels
from ..functions import col, day_range, null_to_blank, percent, percent_text, same_account, show_blank, week_start
from .outcomes import label_counts

GRAND_TOTAL = "Grand Total"
BLANK = "(Blank)"
COMBINED = "combined_refills"

_COUNTS = ("requests", "bot", "human")
_SHARES = (("share", "requests"), ("bot_share", "bot"), ("human_share", "human"))


def _requests_since(requests: DataFrame, start: date, bot: str) -> DataFrame:
    """Rows from ``start`` on; rows without a clerk belong to neither bot nor people, only to the total."""
    return requests.filter(F.col("completed_ts") >= F.lit(start)).select(
        "completed_ts", null_to_blank(F.col("label")).alias("label"), same_account(F.col("clerk"), bot).alias("is_bot")
    )


def _population_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("is_bot")).alias("bot"),
        F.count_if(~F.col("is_bot")).alias("human"),
    ]


def _share_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shares as text next to the counts; total rows have empty shares."""
    shares = [
        F.when(F.col("is_total"), F.lit("")).otherwise(percent_text(F.col(part), F.col(f"all_{part}"))).alias(share)
        for share, part in _SHARES
    ]
    row_label = F.when(F.col("is_total"), F.lit(GRAND_TOTAL)).otherwise(show_blank(F.col("label"), BLANK))
    return rows.orderBy(*keys, "is_total", "label").select(
        *keys, row_label.alias("row_label"), "requests", shares[0], "bot", shares[1], "human", shares[2]
    )


def request_summary(requests: DataFrame, start: date, bot: str) -> DataFrame:
    """Per label: counts and shares of all, bot and human requests, then a grand total."""
    by_label = _requests_since(requests, start, bot).groupBy("label").agg(*_population_counts())
    # Totals are made from the label counts, not from the rows again.
    totals = by_label.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in _COUNTS])
    scalar = totals.select(F.struct(*_COUNTS)).scalar()
    detail = (
        by_label.withColumn("_all", scalar)
        .withColumns({f"all_{c}": F.col(f"_all.{c}") for c in _COUNTS})
        .withColumn("is_total", F.lit(False))
        .drop("_all")
    )
    grand = totals.withColumns({f"all_{c}": F.col(c) for c in _COUNTS}).withColumns(
        {"is_total": F.lit(True), "label": F.lit("")}
    )
    return _share_rows(detail.unionByName(grand), [])


def request_weekly_summary(requests: DataFrame, start: date, bot: str) -> DataFrame:
    """The same per week. Every label of the whole span appears in every week, with zeros if need be.

    Both parts of the grid come from the counts per week and label. A label keeps its
    counts as a map over weeks, and is laid out over the array of weeks with their
    totals; the calendar bounds the length of both.
    """
    scoped = _requests_since(requests, start, bot).withColumn("week", week_start(F.col("completed_ts")))
    cells = scoped.groupBy("week", "label").agg(*_population_counts())
    totals = cells.groupBy("week").agg(*[F.sum(c).alias(f"all_{c}") for c in _COUNTS])
    weeks = totals.agg(F.collect_list(F.struct("week", *[f"all_{c}" for c in _COUNTS]))).scalar()
    by_label = cells.groupBy("label").agg(
        F.map_from_entries(F.collect_list(F.struct("week", F.struct(*_COUNTS)))).alias("counts")
    )
    detail = (
        by_label.withColumn("_week", F.explode(weeks))
        .select("label", "_week.*", F.try_element_at("counts", F.col("_week.week")).alias("_cell"))
        .withColumns({c: F.coalesce(F.col(f"_cell.{c}"), F.lit(0)) for c in _COUNTS})
        .withColumn("is_total", F.lit(False))
        .drop("_cell")
    )
    grand = totals.withColumns({c: F.col(f"all_{c}") for c in _COUNTS}).withColumns(
        {"is_total": F.lit(True), "label": F.lit("")}
    )
    return _share_rows(detail.unionByName(grand), ["week"])


def _clerk_rows(requests: DataFrame, day: date, bot: str) -> DataFrame:
    """People's requests of one day. Only the bot comparison ignores case and spaces of the mail."""
    people = requests.filter(day_range(F.col("completed_ts"), day, day) & ~same_account(F.col("clerk"), bot))
    return people.select("clerk", null_to_blank(F.col("label")).alias("label"))


def clerk_daily_long(requests: DataFrame, day: date, bot: str) -> DataFrame:
    """Requests of one day per clerk and label, with the clerk's total, share and refills combined; any number of labels."""
    counts = label_counts(_clerk_rows(requests, day, bot), "label", ("clerk",))
    combined = F.when(F.col("label").isin(labels.SUBMITTED, labels.OUT_OF_REFILL), F.col("rows")).otherwise(0)
    totals = counts.groupBy("clerk").agg(F.sum("rows").alias("total_completed"), F.sum(combined).alias(COMBINED))
    return (
        counts.join(totals, "clerk")
        .withColumn("share", percent(F.col("rows"), F.col("total_completed")))
        .withColumn("label", show_blank(F.col("label"), BLANK))
        .orderBy(F.desc(COMBINED), "clerk", "label")
    )


def clerk_daily(requests: DataFrame, day: date, bot: str, values: Sequence[str]) -> DataFrame:
    """The same with a column per given label: total, count and share per label, refills combined."""
    counts = _clerk_rows(requests, day, bot).groupBy("clerk").agg(
        F.count(F.lit(1)).alias("total_completed"),
        *[F.count_if(F.col("label") == v).alias(v or BLANK) for v in values],
        F.count_if(F.col("label").isin(labels.SUBMITTED, labels.OUT_OF_REFILL)).alias(COMBINED),
    )
    per_label = [
        c for v in values for c in (col(v or BLANK), percent(col(v or BLANK), F.col("total_completed")).alias(f"% {v or BLANK}"))
    ]
    return counts.select("clerk", "total_completed", *per_label, COMBINED).orderBy(F.desc(COMBINED), "clerk")

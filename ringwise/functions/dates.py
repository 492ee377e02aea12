"""Calendar expressions and run-date arithmetic.

Weeks start on Monday and are keyed by that date; labels are made only for output.
The driver-side helpers take the run date as an argument: nothing here reads a clock
unless the caller leaves ``now`` out.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACIFIC = ZoneInfo("America/Los_Angeles")
UTC = ZoneInfo("UTC")
PERIODS = ("daily", "weekly", "monthly")

# FIXED VALUE: shape of an attempt time; microseconds and offset after it are cut off.
ATTEMPT_TIME_PATTERN = r"\d{4}-\d{2}-\d{2}\s\d{2}:\d{2}:\d{2}.\d{3}"


def week_start(d: Column) -> Column:
    return F.trunc(d.cast("date"), "week")


def week_label(week: Column) -> Column:
    """``MM/dd/yyyy - MM/dd/yyyy`` of the week that starts on ``week``."""
    return F.concat(
        F.date_format(week, "MM/dd/yyyy"), F.lit(" - "), F.date_format(F.date_add(week, 6), "MM/dd/yyyy")
    )


def attempt_timestamp(text: Column) -> Column:
    """Attempt text to a zone-free timestamp with milliseconds; null if it has none."""
    cut = F.regexp_extract(text, ATTEMPT_TIME_PATTERN, 0)
    return F.nullif(cut, F.lit("")).try_cast("timestamp_ntz")


def parse_first(text: Column, formats: list[str]) -> Column:
    """First format that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def report_end_day(d: Column) -> Column:
    """Latest Tuesday strictly before ``d``."""
    return F.date_sub(d, (F.weekday(d) + 5) % 7 + 1)


def report_end(d: Column) -> Column:
    """Last second of the latest Tuesday strictly before ``d``."""
    return report_end_day(d).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(23), F.lit(59), F.lit(59)
    )


def day_range(c: Column, first: date, last: date) -> Column:
    """Whole days ``first..last``, written as bounds on the raw column so that scans can prune."""
    return (c >= F.lit(first)) & (c < F.lit(last + timedelta(days=1)))


def last_tuesday_before(run: date) -> date:
    return run - timedelta(days=(run.weekday() + 5) % 7 + 1)


def report_end_datetime(run: datetime) -> datetime:
    return datetime.combine(last_tuesday_before(run.date()), time(23, 59, 59), run.tzinfo)


def report_week(as_of: date) -> tuple[date, date]:
    """Seven days that end on the latest Tuesday strictly before ``as_of``."""
    end = last_tuesday_before(as_of)
    return end - timedelta(days=6), end


def calendar_week(as_of: date) -> tuple[date, date]:
    start = as_of - timedelta(days=as_of.weekday())
    return start, start + timedelta(days=6)


def period_bounds(as_of: date, period: str) -> tuple[date, date]:
    """First and last day of the day, week or month around ``as_of``."""
    if period == "daily":
        return as_of, as_of
    if period == "weekly":
        return calendar_week(as_of)
    if period == "monthly":
        next_month = (as_of.replace(day=28) + timedelta(days=4)).replace(day=1)
        return as_of.replace(day=1), next_month - timedelta(days=1)
    raise ValueError(f"period must be one of {PERIODS}, got {period!r}")


def to_utc(moment: datetime) -> datetime:
    """Aware datetime to UTC; naive input is refused because its zone would be a guess."""
    if moment.tzinfo is None:
        raise ValueError("datetimes must be timezone-aware")
    return moment.astimezone(UTC)


def pacific_bounds(
    start: datetime | None = None, end: datetime | None = None, now: datetime | None = None
) -> tuple[datetime, datetime]:
    """Bounds in Pacific time: naive values are taken as Pacific, missing ones mean today so far."""
    now = (now or datetime.now(tz=PACIFIC)).astimezone(PACIFIC)

    def localize(moment: datetime) -> datetime:
        return moment.replace(tzinfo=PACIFIC) if moment.tzinfo is None else moment.astimezone(PACIFIC)

    lower = localize(start) if start else now.replace(hour=0, minute=0, second=0, microsecond=0)
    return lower, localize(end) if end else now


def utc_literal(df: DataFrame, column: str, moment: datetime) -> Column:
    """``moment`` as a literal of the column's own timestamp type, so that the comparison stays a pushed filter."""
    utc = to_utc(moment)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.lit(utc.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    micros = (utc - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def time_range(df: DataFrame, column: str, start: datetime, end: datetime) -> Column:
    """Inclusive on both ends."""
    return F.col(column).between(utc_literal(df, column, start), utc_literal(df, column, end))


def file_date_label(d: Column) -> Column:
    return F.date_format(d, "MM/dd/yyyy")

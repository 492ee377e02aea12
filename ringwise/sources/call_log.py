"""The call log: one schema over the current and the prior table layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize_phone_loose, utc_literal

# Unified column -> column of the layout.
CURRENT_LAYOUT = {
    "ts": "timestamp",
    "disposition": "dialer_disposition",
    "skill": "skill_name",
    "abandoned": "abandoned",
    "outbound_number": "destination",
    "destination": "destination",
    "inbound_number": "source",
}
PRIOR_LAYOUT = {
    "ts": "timestamp",
    "disposition": "disposition",
    "skill": "skill",
    "abandoned": "abandoned",
    "outbound_number": "dnis",
    "destination": "destination",
    "inbound_number": "ani",
}


def with_layout(table: DataFrame, layout: Mapping[str, str], log_year: int | None = None) -> DataFrame:
    """Rename one table to the unified columns. A pure projection: filters still reach the scan."""
    unified = table.select(*[F.col(source).alias(target) for target, source in layout.items()])
    return unified if log_year is None else unified.withColumn("log_year", F.lit(log_year))


def unify_call_logs(current: DataFrame, prior: DataFrame, years: tuple[int, int] = (2026, 2025)) -> DataFrame:
    """Both tables as one, told apart by ``log_year``; a filter on it drops the other branch from the plan."""
    return with_layout(current, CURRENT_LAYOUT, years[0]).unionByName(with_layout(prior, PRIOR_LAYOUT, years[1]))


def read_call_log_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    first: datetime,
    last: datetime,
    partitions: int,
    column: str = "timestamp",
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parallel range reads of a database table; ``first`` and ``last`` only shape the ranges."""
    bounds = {
        "partitionColumn": column,
        "lowerBound": first.strftime("%Y-%m-%d %H:%M:%S"),
        "upperBound": last.strftime("%Y-%m-%d %H:%M:%S"),
        "numPartitions": str(partitions),
    }
    return spark.read.format("jdbc").options(url=url, dbtable=table, **bounds, **(properties or {})).load()


def recent_calls(calls: DataFrame, skills: Sequence[str], now: datetime, days: int = 7) -> DataFrame:
    """``number, ts`` of outbound calls of the last days, numbers stripped of their prefix."""
    since = utc_literal(calls, "ts", now - timedelta(days=days))
    return calls.filter(F.col("skill").isin(list(skills)) & (F.col("ts") >= since)).select(
        normalize_phone_loose(F.col("destination")).alias("number"), "ts"
    )

"""Skill KPIs over Pacific time bounds."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from ..functions import pacific_bounds
from ..operators.calls import CallRules, Window, skill_metrics


def skill_kpis(
    calls: DataFrame,
    skills: Sequence[str],
    start: datetime | None = None,
    end: datetime | None = None,
    rules: CallRules = CallRules(),
    now: datetime | None = None,
) -> DataFrame:
    """Pickup, conversion, completion and abandon rate; by default of today so far."""
    return skill_metrics(calls, Window(*pacific_bounds(start, end, now), skills), rules)

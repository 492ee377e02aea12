"""Ratios and rounding.

Rates come from report code that works on float64 arrays, so two rules differ from
plain Spark SQL: rounding is half-to-even on the scaled value, and a zero
denominator yields null (or the fill value for 0/0) instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF_POLICIES = ("null", "inf")


def round_np(x: Column, digits: int) -> Column:
    """Half-even rounding of ``x * 10**digits``, scaled back."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def safe_ratio(num: Column, den: Column, fill: float | None = None, inf_policy: str = "null") -> Column:
    """``num / den`` as double, never NaN and never an ANSI error.

    ``fill`` replaces 0/0 and null operands. A non-zero numerator over zero is null,
    or signed infinity with ``inf_policy='inf'``.
    """
    if inf_policy not in INF_POLICIES:
        raise ValueError(f"inf_policy must be one of {INF_POLICIES}, got {inf_policy!r}")
    num, den = num.cast("double"), den.cast("double")
    ratio = F.try_divide(num, den)
    if fill is None and inf_policy == "null":
        return ratio
    if fill is not None:
        ratio = F.coalesce(ratio, F.lit(float(fill)))
    over_zero = (den == 0) & (num != 0)
    if inf_policy == "inf":
        unbounded = F.when(num > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    else:
        unbounded = F.lit(None).cast("double")
    return F.when(over_zero, unbounded).otherwise(ratio)


def percent(
    num: Column,
    den: Column,
    digits: int | None = 1,
    fill: float | None = None,
    inf_policy: str = "null",
) -> Column:
    """``num / den * 100``, rounded unless ``digits`` is None."""
    rate = safe_ratio(num, den, fill, inf_policy) * 100
    return rate if digits is None else round_np(rate, digits)


def percent_text(num: Column, den: Column, digits: int = 1) -> Column:
    """Percent as text, e.g. ``'33.3%'``; ``'0%'`` when there is nothing to divide by."""
    return F.when(den > 0, F.concat(percent(num, den, digits).cast("string"), F.lit("%"))).otherwise(F.lit("0%"))


def rate_text(x: Column) -> Column:
    """Number text to double; blank means missing, anything else must be a number."""
    return F.nullif(F.trim(x), F.lit("")).cast("double")


def count_text(x: Column) -> Column:
    """Count text such as ``'12.0'`` to a long; blank and null mean 0."""
    return F.coalesce(rate_text(x), F.lit(0.0)).cast("long")

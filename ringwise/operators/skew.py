"""Joins that survive hot keys.

A filler phone number or card id can sit on a third of all rows. ``spread_join`` looks
such keys up exactly (one narrow, pre-aggregated count), gives each of them as many
salts as it needs, and copies only the matching rows of the other side. Cold keys are
joined as usual, and the result is the same for every choice of hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_SLICE = 1_000_000

_HASH, _FAN, _SALT = "_key_hash", "_key_fan", "_key_salt"


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Hash and number of slices of every key with more than ``rows_per_slice`` rows.

    There are fewer than ``rows / rows_per_slice`` such keys, which bounds the broadcast
    of this frame: 16 bytes per million input rows by default. Counts are exact, so that
    both sides of the join see the same set however often it is computed.
    """
    counts = df.groupBy(F.xxhash64(*keys).alias(_HASH)).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > rows_per_slice).select(
        _HASH, F.ceil(F.col("_rows") / rows_per_slice).cast("int").alias(_FAN)
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    null_safe: bool = False,
    counted: DataFrame | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Join ``left`` to ``right``, which has at most one row per key, on equally named ``keys``.

    ``how`` is left_semi, left_anti, left or inner. With ``null_safe`` null equals null.
    ``counted`` is the frame to count keys on, when that is cheaper than ``left`` itself;
    it must not hold fewer rows per key than ``left``.
    """
    keys = list(keys)
    for k in keys:
        if left.schema[k].dataType != right.schema[k].dataType:
            raise ValueError(f"key {k!r} has different types on the two sides; cast first")
    hot = F.broadcast(hot_keys(left if counted is None else counted, keys, rows_per_slice))

    # The salt depends on row content and input partition only: a re-run task gives the
    # same salts, and copies of one row still spread out.
    row_hash = F.xxhash64(*left.columns) + F.spark_partition_id()
    salted_left = (
        left.withColumn(_HASH, F.xxhash64(*keys))
        .join(hot, _HASH, "left")
        .withColumn(_SALT, F.coalesce(F.pmod(row_hash, F.col(_FAN)), F.lit(0)).cast("int"))
        .drop(_HASH, _FAN)
    )
    salted_right = (
        right.withColumn(_HASH, F.xxhash64(*keys))
        .join(hot, _HASH, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_FAN) - 1, F.lit(0)))))
        .drop(_HASH, _FAN)
    )

    def equal(name: str, safe: bool) -> Column:
        a, b = F.col(f"l.`{name}`"), F.col(f"r.`{name}`")
        return a.eqNullSafe(b) if safe else a == b

    condition = reduce(Column.__and__, [equal(k, null_safe) for k in keys], equal(_SALT, False))
    joined = salted_left.alias("l").join(salted_right.alias("r"), condition, how)
    if how in ("left_semi", "left_anti"):
        return joined.drop(_SALT)
    extra = [F.col(f"r.`{c}`") for c in right.columns if c not in keys]
    return joined.select(*[F.col(f"l.`{c}`") for c in left.columns], *extra)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()

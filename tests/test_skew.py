"""Salted joins give the same rows as plain ones, wherever the hot keys are."""

import random

import pytest
from pyspark.sql import functions as F

from ringwise.operators.leads import keep_first
from ringwise.operators.skew import hot_keys, spread_join


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(3)
    keys = ["hot"] * 300 + [None] * 120 + [f"k{rng.randrange(60)}" for _ in range(300)]
    # A third of the rows are copies of one single row.
    left = [(k, 1 if k == "hot" else rng.randrange(1000)) for k in keys]
    right = [("hot", "h"), (None, "n")] + [(f"k{i}", f"v{i}") for i in range(0, 80, 2)]
    return spark.createDataFrame(left, "k string, x int"), spark.createDataFrame(right, "k string, v string")


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("how", ["left_semi", "left_anti", "left", "inner"])
@pytest.mark.parametrize("rows_per_slice", [7, 1_000_000])
def test_spread_join_equals_plain_join(sides, rows, how, null_safe, rows_per_slice):
    left, right = sides
    got = spread_join(left, right, ["k"], how, null_safe, rows_per_slice=rows_per_slice)
    r = right.withColumnRenamed("k", "rk")
    condition = left.k.eqNullSafe(r.rk) if null_safe else left.k == r.rk
    want = left.join(r, condition, how).drop("rk")
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_hot_keys_are_few_and_sliced_by_size(sides):
    left, _ = sides
    found = {r[1] for r in hot_keys(left, ["k"], 100).collect()}
    assert found == {3, 2}  # 300 rows -> 3 slices, 120 null rows -> 2


def test_hot_rows_spread_over_all_slices(spark):
    copies = spark.range(4000, numPartitions=40).select(F.lit("hot").alias("k"), F.lit(1).alias("x"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    joined = spread_join(copies, right, ["k"], "inner", rows_per_slice=500)
    assert joined.count() == 4000
    # Identical rows differ by the partition they come from, so no slice holds them all.
    salts = copies.select(F.pmod(F.xxhash64("k", "x") + F.spark_partition_id(), F.lit(8)).alias("s"))
    assert max(r[1] for r in salts.groupBy("s").count().collect()) == 500


def test_key_types_must_agree(spark):
    a, b = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(1,)], "k long")
    with pytest.raises(ValueError, match="different types"):
        spread_join(a, b, ["k"], "inner")


def test_keep_first_drops_repeats_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    first = keep_first(df, ["k"], ["id"])
    assert sorted(r.id for r in first.collect()) == [0, 1, 2]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")

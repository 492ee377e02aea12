"""Null, rounding and parsing rules, each with the value written out."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from ringwise import functions as fx


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    data = [tuple(v for _, v in values.values()) or (1,)]
    return spark.createDataFrame(data, schema).select(column.alias("v")).first()[0]


D = "double"


@pytest.mark.parametrize(
    "num, den, fill, policy, want",
    [
        (1.0, 4.0, None, "null", 0.25),
        (0.0, 0.0, None, "null", None),
        (0.0, 0.0, 0.0, "null", 0.0),
        (3.0, 0.0, 0.0, "null", None),
        (3.0, 0.0, None, "null", None),
        (3.0, 0.0, 0.0, "inf", float("inf")),
        (-3.0, 0.0, 0.0, "inf", float("-inf")),
        (0.0, 0.0, 0.0, "inf", 0.0),
        (0.0, 0.0, None, "inf", None),
        (None, 2.0, 0.0, "null", 0.0),
        (None, 2.0, None, "null", None),
        (2.0, None, 0.0, "null", 0.0),
    ],
)
def test_safe_ratio(spark, num, den, fill, policy, want):
    assert one(spark, fx.safe_ratio(F.col("a"), F.col("b"), fill, policy), a=(D, num), b=(D, den)) == want


def test_safe_ratio_rejects_unknown_policy(spark):
    with pytest.raises(ValueError):
        fx.safe_ratio(F.lit(1), F.lit(1), inf_policy="zero")


@pytest.mark.parametrize("x, n, want", [(0.25, 1, 0.2), (0.35, 1, 0.4), (0.75, 1, 0.8), (2.675, 2, 2.68), (-0.25, 1, -0.2), (None, 1, None)])
def test_round_np_is_half_even_on_the_scaled_value(spark, x, n, want):
    assert one(spark, fx.round_np(F.col("x"), n), x=(D, x)) == want


def test_round_np_equals_numpy(spark):
    import numpy as np

    values = np.random.default_rng(7).random(5000) * 100
    got = spark.createDataFrame([(float(v),) for v in values], "x double").select(fx.round_np(F.col("x"), 1)).collect()
    assert [r[0] for r in got] == np.round(values, 1).tolist()


@pytest.mark.parametrize("a, b, want", [(1, 3, "33.3%"), (3, 3, "100.0%"), (0, 3, "0.0%"), (0, 0, "0%")])
def test_percent_text(spark, a, b, want):
    assert one(spark, fx.percent_text(F.col("a"), F.col("b")), a=("long", a), b=("long", b)) == want


@pytest.mark.parametrize("text, want", [("12.0", 12), ("", 0), (None, 0), (" ", 0), ("7", 7)])
def test_count_text(spark, text, want):
    assert one(spark, fx.count_text(F.col("x")), x=("string", text)) == want


def test_count_text_fails_on_garbage(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, fx.count_text(F.col("x")), x=("string", "many"))


@pytest.mark.parametrize(
    "raw, want",
    [
        ("+15551234567", "5551234567"),
        ("15551234567", "5551234567"),
        (" 5551234567 ", "5551234567"),
        ("+5551234567", "5551234567"),
        ("1555123456", "1555123456"),
        ("555123456", None),
        ("25551234567", None),
        ("++15551234567", "5551234567"),
        ("abcdefghij", "abcdefghij"),
        ("", None),
        (None, None),
    ],
)
def test_normalize_phone(spark, raw, want):
    assert one(spark, fx.normalize_phone(F.col("x")), x=("string", raw)) == want


@pytest.mark.parametrize("raw, want", [("+11123456789", "23456789"), ("+15551234567", "5551234567"), ("111", ""), (None, None)])
def test_normalize_phone_loose(spark, raw, want):
    assert one(spark, fx.normalize_phone_loose(F.col("x")), x=("string", raw)) == want


@pytest.mark.parametrize("x, want", [(None, "d"), ("", "d"), ("  ", "d"), (" a ", " a ")])
def test_blank_to_default(spark, x, want):
    assert one(spark, fx.blank_to_default(F.col("x"), "d"), x=("string", x)) == want


@pytest.mark.parametrize(
    "text, want",
    [
        ("2026-03-02 10:11:12.345678-05:00", datetime(2026, 3, 2, 10, 11, 12, 345000)),
        ("2026-03-02 10:11:12.345", datetime(2026, 3, 2, 10, 11, 12, 345000)),
        ("2026-03-02 10:11:12", None),
        ("no time", None),
        (None, None),
    ],
)
def test_attempt_timestamp(spark, text, want):
    assert one(spark, fx.attempt_timestamp(F.col("x")), x=("string", text)) == want


@pytest.mark.parametrize("values, want", [(("a", None, "b"), True), ((None, None, None), False), (("x", "y", None), False)])
def test_any_of_never_gives_null(spark, values, want):
    cols = {k: ("string", v) for k, v in zip("abc", values)}
    assert one(spark, fx.any_of([F.col(c) for c in "abc"], ["b"]), **cols) is want


@pytest.mark.parametrize(
    "mail, want", [(" Bot@Example.com ", True), ("someone@example.com", False), (None, None)]
)
def test_same_account(spark, mail, want):
    assert one(spark, fx.same_account(F.col("x"), "bot@example.com"), x=("string", mail)) is want


def test_filter_and_its_negation_both_drop_unknown(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    assert df.filter(F.col("x") == "a").count() == 1
    assert df.filter(~(F.col("x") == "a")).count() == 1


@pytest.mark.parametrize(
    "word, want", [("", None), ("NA", None), ("N/A", None), ("null", None), ("None", None), ("nan", None), ("Nada", "Nada"), (None, None)]
)
def test_na_words(spark, word, want):
    assert one(spark, fx.blank_to_null_words(F.col("x")), x=("string", word)) == want


def test_member_key_needs_both_parts(spark):
    key = fx.member_key(F.col("a"), F.col("b"))
    assert one(spark, key, a=("string", "M1"), b=("string", "02")) == "M102"
    assert one(spark, key, a=("string", "M1"), b=("string", None)) is None


@pytest.mark.parametrize(
    "day, monday, label",
    [
        (date(2026, 3, 1), date(2026, 2, 23), "02/23/2026 - 03/01/2026"),
        (date(2026, 3, 2), date(2026, 3, 2), "03/02/2026 - 03/08/2026"),
        (date(2025, 12, 31), date(2025, 12, 29), "12/29/2025 - 01/04/2026"),
    ],
)
def test_weeks_start_on_monday(spark, day, monday, label):
    assert one(spark, fx.week_start(F.col("x")), x=("date", day)) == monday
    assert one(spark, fx.week_label(fx.week_start(F.col("x"))), x=("date", day)) == label


@pytest.mark.parametrize(
    "day, want",
    [
        (date(2026, 3, 3), date(2026, 2, 24)),  # Tuesday -> the Tuesday before
        (date(2026, 3, 4), date(2026, 3, 3)),  # Wednesday -> yesterday
        (date(2026, 3, 2), date(2026, 2, 24)),
        (date(2026, 3, 8), date(2026, 3, 3)),
    ],
)
def test_report_end_is_a_tuesday_strictly_before(spark, day, want):
    assert fx.last_tuesday_before(day) == want
    assert one(spark, fx.report_end_day(F.col("x")), x=("date", day)) == want
    end = datetime(want.year, want.month, want.day, 23, 59, 59)
    assert one(spark, fx.report_end(F.col("x")), x=("date", day)) == end
    assert fx.report_end_datetime(datetime(day.year, day.month, day.day, 8)) == end


def test_period_bounds():
    as_of = date(2024, 2, 14)
    assert fx.period_bounds(as_of, "daily") == (as_of, as_of)
    assert fx.period_bounds(as_of, "weekly") == (date(2024, 2, 12), date(2024, 2, 18))
    assert fx.period_bounds(as_of, "monthly") == (date(2024, 2, 1), date(2024, 2, 29))
    assert fx.period_bounds(date(2024, 12, 5), "monthly") == (date(2024, 12, 1), date(2024, 12, 31))
    with pytest.raises(ValueError):
        fx.period_bounds(as_of, "yearly")


def test_pacific_bounds():
    now = datetime(2026, 3, 2, 18, 0, tzinfo=timezone.utc)
    start, end = fx.pacific_bounds(now=now)
    assert (start.hour, start.day, end) == (0, 2, now)
    start, _ = fx.pacific_bounds(datetime(2026, 3, 1), now=now)
    assert fx.to_utc(start) == datetime(2026, 3, 1, 8, tzinfo=timezone.utc)
    with pytest.raises(ValueError):
        fx.to_utc(datetime(2026, 3, 1))


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_time_range_includes_both_bounds(spark, kind):
    texts = ["2026-01-01 00:00:00", "2025-12-31 23:59:59", "2026-01-31 23:59:59", "2026-01-31 23:59:59.5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t"), F.col("t").cast(kind).alias("ts"))
    utc = timezone.utc
    inside = df.filter(fx.time_range(df, "ts", datetime(2026, 1, 1, tzinfo=utc), datetime(2026, 1, 31, 23, 59, 59, tzinfo=utc)))
    assert sorted(r.t for r in inside.collect()) == ["2026-01-01 00:00:00", "2026-01-31 23:59:59"]


def test_parse_first_takes_the_first_format_that_fits(spark):
    parsed = fx.parse_first(F.col("x"), ["yyyy-MM-dd", "MM/dd/yyyy"]).cast("date")
    assert one(spark, parsed, x=("string", "03/05/2026")) == date(2026, 3, 5)
    assert one(spark, parsed, x=("string", "2026-03-05")) == date(2026, 3, 5)
    assert one(spark, parsed, x=("string", "soon")) is None

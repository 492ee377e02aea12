from datetime import date, datetime, timezone

import pytest

from ringwise import labels
from ringwise.operators import calls as c
from ringwise.plans.never_answered import never_answered_report, year_windows
from ringwise.plans.skill_kpis import skill_kpis
from ringwise.sources.call_log import recent_calls, unify_call_logs

SCHEMA = (
    "ts timestamp_ntz, disposition string, skill string, abandoned boolean, outbound_number string, "
    "destination string, inbound_number string"
)


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


JAN = c.Window(utc(2026, 1, 1), utc(2026, 1, 31, 23, 59, 59), ["out"])


def log(spark, *calls):
    """(day, disposition, abandoned, number[, skill]) in January 2026."""
    data = []
    for day, disposition, abandoned, number, *skill in calls:
        ts = day if isinstance(day, datetime) else datetime(2026, 1, day, 9)
        data.append((ts, disposition, (skill or ["out"])[0], abandoned, number, number, number))
    return spark.createDataFrame(data, SCHEMA)


def test_unresolved_calls(spark):
    df = log(
        spark,
        (1, "UNKNOWN", True, "keep"),
        (1, "UNKNOWN", False, "drop"),
        (1, "UNKNOWN", None, "drop"),
        (1, None, False, "drop"),
        (1, None, True, "keep"),
        (1, "Busy", False, "keep"),
    )
    kept = c.calls_in_scope(df, JAN, c.CallRules())
    assert {r.outbound_number for r in kept.collect()} == {"keep"} and kept.count() == 3
    assert c.calls_in_scope(df, JAN, c.CallRules(), drop_unresolved=False).count() == 6


def test_not_dialed_labels_are_errors_and_suppressions():
    found = labels.not_dialed_labels()
    assert len(found) == 30 and "Network Busy" in found and "IVR Suppression" in found and "Busy" not in found


def test_skill_metrics(spark):
    df = log(
        spark,
        (1, "Completed", False, "a"),
        (1, "Declined", False, "a"),
        (2, "No Answer", False, "a"),
        (2, "Abandon", True, "a"),
        (2, "Error", False, "a"),
        (2, None, True, "a"),
        (2, "Completed", False, "a", "other"),
        (datetime(2026, 1, 31, 23, 59, 59), "Completed", False, "a"),
        (datetime(2026, 1, 31, 23, 59, 59, 500000), "Completed", False, "a"),
    )
    row = c.skill_metrics(df, JAN).first()
    assert (row.skill, row.start_datetime) == (["out"], datetime(2026, 1, 1))
    assert (row.total_calls, row.answered_calls, row.converted_calls, row.abandoned_calls) == (5, 3, 2, 1)
    assert row.pickup_rate == 3 / 5 * 100 and row.conversion_rate == 2 / 3 * 100
    assert row.completion_rate == 2 / 5 * 100 and row.abandon_rate == 1 / 5 * 100


def test_skill_metrics_of_nothing_are_zero(spark):
    row = c.skill_metrics(log(spark, (1, "Busy", False, "a", "other")), JAN).first()
    assert row.total_calls == 0 and row.pickup_rate == 0.0 and row.conversion_rate == 0.0


def test_skill_kpis_default_to_pacific_today(spark):
    now = utc(2026, 1, 5, 20)
    df = log(
        spark,
        (datetime(2026, 1, 5, 7, 59), "Completed", False, "a"),
        (datetime(2026, 1, 5, 8, 0), "Completed", False, "a"),
        (datetime(2026, 1, 5, 20, 1), "Completed", False, "a"),
    )
    assert skill_kpis(df, ["out"], now=now).first().total_calls == 1


def test_naive_bounds_are_refused(spark):
    with pytest.raises(ValueError):
        c.skill_metrics(log(spark, (1, "Busy", False, "a")), c.Window(datetime(2026, 1, 1), utc(2026, 2, 1), ["out"])).first()


def test_attempts_days_and_thresholds(spark, rows):
    df = log(
        spark,
        *[(d, "No Answer", False, "three-on-two") for d in (1, 1, 2)],
        *[(d, "No Answer", False, "three-on-three") for d in (1, 2, 3)],
        *[(d, "Completed", False, "picks-up") for d in (1, 2, 3)],
        (1, "Error", False, "never-dialed"),
    )
    got = rows(c.outbound_stats_by_number(df, JAN, min_attempts=3), "member_phone", "total_calls", "attempt_days", "pickup_rate")
    assert got == [("picks-up", 3, 3, 100.0), ("three-on-three", 3, 3, 0.0)]
    only = c.outbound_stats_by_number(df, JAN, min_attempts=3, never_answered_only=True)
    assert rows(only, "member_phone") == [("three-on-three",)]
    everyone = c.outbound_stats_by_number(df, JAN, min_attempts=0)
    assert ("never-dialed", 0, 0, 0.0) in rows(everyone, "member_phone", "total_calls", "attempt_days", "pickup_rate")


def test_pickup_rates_sorted_with_ties_by_number(spark, rows):
    df = log(spark, (1, "Completed", False, "b"), (1, "Completed", False, "a"), (1, "Busy", False, "c"))
    got = rows(c.pickup_rate_by_destination(df, c.Window(JAN.start, JAN.end)), "destination", "pickup_rate", ordered=True)
    assert got == [("a", 100.0), ("b", 100.0), ("c", 0.0)]


def test_both_periods_keep_unresolved_only_in_the_current_one(spark, rows):
    current = log(spark, *[(d, "UNKNOWN", False, "x") for d in (1, 2, 3)], *[(d, "Busy", False, "only-now") for d in (1, 2, 3)])
    prior = log(spark, (5, "UNKNOWN", False, "x"), (6, "Completed", False, "x"), (6, "Error", False, "x"))
    got = c.outbound_both_periods(current, prior, JAN, JAN, min_attempts=3)
    assert got.columns == [
        "member_phone", "attempts_2026", "attempt_days_2026", "pickups_2026",
        "attempts_2025", "attempt_days_2025", "pickups_2025", "pickup_rate_2026", "pickup_rate_2025",
    ]
    assert rows(got) == [("x", 3, 3, 0, 1, 1, 1, 0.0, 100.0)]


def test_callbacks_for_given_numbers(spark, rows):
    df = log(spark, (1, "Busy", False, "a"), (2, "Busy", False, "a"), (1, "Busy", False, "b"))
    assert rows(c.inbound_callbacks(df, JAN, ["a"])) == [("a", 2)]
    assert rows(c.inbound_callbacks(df, JAN, [])) == [("a", 2), ("b", 1)]
    numbers = spark.createDataFrame([("b",), ("z",)], "member_phone string")
    assert rows(c.inbound_callbacks(df, JAN, numbers)) == [("b", 1)]


def test_never_answered_destinations(spark, rows):
    df = log(spark, (1, "Busy", False, "a"), (1, "Completed", False, "b"), (1, "Busy", False, "c"))
    numbers = spark.createDataFrame([("a",), ("b",)], "destination string")
    assert rows(c.never_answered_destinations(df, numbers)) == [("a", 1, 0)]


def test_never_answered_report_with_two_spellings_of_a_number(spark, rows):
    ten = "5550000001"
    current = log(
        spark,
        *[(d, "Busy", False, "+1" + ten) for d in (1, 2, 3)],
        *[(d, "Busy", False, ten) for d in (1, 2, 3, 4)],
        *[(d, "Busy", False, "12345") for d in (1, 2, 3)],
        (9, "Busy", False, ten, "in"),
        (9, "Busy", False, "+1" + ten, "in"),
    )
    inbound = c.Window(JAN.start, JAN.end, ["in"])
    report = never_answered_report(current, JAN, inbound)
    assert rows(report, ordered=True) == [(ten, 4, 4, 0, 0.0, 1, True), (ten, 3, 3, 0, 0.0, 1, True)]
    merged = never_answered_report(current, JAN, inbound, clean_first=True)
    assert rows(merged) == [(ten, 7, 4, 0, 0.0, 2, True)]

    prior = log(spark, (1, "Busy", False, ten), (2, "Busy", False, ten, "in"))
    two = never_answered_report(current, JAN, inbound, prior, JAN, inbound)
    assert rows(two) == [(ten, 4, 4, 0, 0.0, 1, 1, 0, 0.0, 5, 1, 1, True)]


def test_layouts_are_unified_by_name(spark, rows):
    now = spark.createDataFrame(
        [(datetime(2026, 1, 1), "Busy", "s", True, "dest", "src")],
        "timestamp timestamp_ntz, dialer_disposition string, skill_name string, abandoned boolean, destination string, source string",
    )
    before = spark.createDataFrame(
        [(datetime(2025, 1, 1), "Busy", "s", True, "dest", "dnis", "ani")],
        "timestamp timestamp_ntz, disposition string, skill string, abandoned boolean, destination string, dnis string, ani string",
    )
    both = unify_call_logs(now, before)
    assert rows(both, "outbound_number", "destination", "inbound_number", "log_year") == [
        ("dest", "dest", "src", 2026), ("dnis", "dest", "ani", 2025),
    ]
    plan = both.filter("log_year = 2026")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_recent_calls(spark, rows):
    df = log(spark, (1, "Busy", False, "+15550000001"), (9, "Busy", False, "+115550000002"), (9, "Busy", False, "x", "in"))
    got = recent_calls(df, ["out"], utc(2026, 1, 10))
    assert rows(got) == [("5550000002", datetime(2026, 1, 9, 9))]


def test_year_windows():
    now, before = year_windows(date(2026, 3, 4), ["out"], ["old"])
    assert (now.start, now.end, now.skills) == (utc(2026, 1, 1), utc(2026, 3, 4, 23, 59, 59), ["out"])
    assert (before.start, before.end, before.skills) == (utc(2025, 1, 1), utc(2025, 12, 31, 23, 59, 59), ["old"])


def test_hot_number_is_folded_before_the_semi_join(spark, rows):
    """A number on a third of all calls: the largest task of the join stage reads one row per number and input task."""
    calls = [(1 + d % 28, "Busy", False, "hot") for d in range(3000)] + [(1 + d % 28, "Busy", False, f"n{d}") for d in range(6000)]
    df = log(spark, *calls).repartition(12)
    numbers = spark.createDataFrame([("hot",), ("n1",), ("z",)], "member_phone string")
    joined = c.inbound_callbacks(df, JAN, numbers)
    assert rows(joined) == [("hot", 3000), ("n1", 1)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("partial_count"), plan  # the join sits above the folded count
    dest = log(spark, *[(1, "Busy", False, "hot")] * 2000, (1, "Completed", False, "b"), (2, "Busy", False, "c")).repartition(7)
    wanted = spark.createDataFrame([("hot",), ("b",)], "destination string")
    found = c.never_answered_destinations(dest, wanted)
    assert rows(found) == [("hot", 2000, 0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("partial_count"), plan

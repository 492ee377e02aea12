from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ringwise import labels
from ringwise.operators import agents as ag
from ringwise.operators import alerts as al
from ringwise.operators import outcomes as oc
from ringwise.operators.dispositions import disposition_rollup
from ringwise.plans.result_summary import export_result_summary, result_summary

W1, W2 = date(2026, 3, 2), date(2026, 3, 9)
SCHEMA = "interaction_ts timestamp_ntz, disposition string, result string, reason string, submission string, agent string"


def case(day, result, reason=None, submission=None, agent="x@example.com", disposition="Completed"):
    return (datetime(day.year, day.month, day.day, 12), disposition, result, reason, submission, agent)


def cases(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_week_totals_count_a_key_per_day(spark, rows):
    claims = spark.createDataFrame(
        [(W1, "a"), (W1, "a"), (W1, "b"), (W1 + timedelta(1), "a"), (W2, "a"), (None, "z"), (W2, None)],
        "day date, document_key string",
    )
    assert rows(oc.weekly_distinct_totals(claims)) == [(W1, 3), (W2, 1)]


def test_result_summary(spark, rows):
    df = cases(
        spark,
        case(W1, "Yes"), case(W1, "Yes"), case(W1 + timedelta(6), "No"), case(W1, "Later"), case(W1, None),
        case(W2, "Yes"),
    )
    totals = spark.createDataFrame([(W1, 8), (date(2026, 1, 5), 4)], "week date, total long")
    got = oc.weekly_result_summary(df, totals)
    assert got.columns == [
        "week", "accepted", "declined", "total", "not_completed", "pct_accepted", "pct_declined", "pct_not_completed", "pct_completed",
    ]
    # 2/8 = 25.0, 1/8 = 12.5, 5/8 = 62.5; a week without claims has no shares and no negative rest
    assert rows(got, ordered=True) == [(W1, 2, 1, 8, 5, 25.0, 12.5, 62.5, 37.5), (W2, 1, 0, 0, 0, None, None, None, None)]
    assert oc.weekly_result_summary(df, totals, "inf").collect()[1].pct_accepted == float("inf")


def test_decline_pivot_drops_null_reasons_and_keeps_all_in_the_total(spark, rows):
    df = cases(
        spark, case(W1, "No", "a"), case(W1, "No", "a"), case(W1, "No", "b.c"), case(W1, "No"), case(W1, "Yes", "a"), case(W2, "No")
    )
    got = oc.decline_reason_pivot(df, ["a", "b.c"])
    assert got.columns == ["week", "a", "b.c", "total_declined", "% a", "% b.c"]
    assert [tuple(r) for r in got.collect()] == [(W1, 2, 1, 3, 66.7, 33.3)]
    assert [tuple(r) for r in oc.decline_reason_pivot(df, ["a"]).collect()] == [(W1, 2, 3, 66.7)]


def test_submission_pivot(spark):
    def sub(day, label):
        return case(day, "Yes", submission=label)

    df = cases(
        spark,
        sub(W1, None), sub(W1, " "), sub(W1, labels.ON_OWN), sub(W1, labels.SUBMITTED), sub(W1, labels.OUT_OF_REFILL),
        sub(W1, labels.SUBMITTED), sub(W2, labels.ON_OWN), case(W2, "No", submission=labels.SUBMITTED),
    )
    first, second = oc.submission_result_pivot(df, [labels.NO_WORKFLOW, labels.OUT_OF_REFILL, labels.SUBMITTED, labels.ON_OWN]).collect()
    assert first[labels.NO_WORKFLOW] == 2 and first.total_accepted == 6 and first[oc.RATIO] == 1.0
    assert first[f"% {labels.SUBMITTED}"] == 33.3
    assert second[oc.RATIO] is None and second[labels.SUBMITTED] == 0 and second[f"% {labels.ON_OWN}"] == 100.0


def test_long_reports_take_any_number_of_labels(spark, rows):
    many = [case(W1, "No", f"r{i}") for i in range(1200)]
    long = oc.decline_reason_long(cases(spark, *many, case(W1, "No", "r0"), case(W1, "No"), case(W2, "No", "x"), case(W2, "Yes", "y")))
    assert long.count() == 1201
    got = rows(long.filter("label IN ('r0', 'r1', 'x')"))
    assert got == [(W1, "r0", 2, 1201, 0.2), (W1, "r1", 1, 1201, 0.1), (W2, "x", 1, 1, 100.0)]
    accepted = oc.submission_result_long(cases(spark, case(W1, "Yes"), case(W1, "Yes", submission=" "), case(W1, "Yes", submission="z")))
    assert rows(accepted) == [(W1, labels.NO_WORKFLOW, 2, 3, 66.7), (W1, "z", 1, 3, 33.3)]


def test_completion_summary_waits_for_a_second_week(spark, rows):
    results = spark.createDataFrame([(W1, 5, 60.0, 40.0), (W2, 6, 50.0, 50.0)], "week date, total long, pct_completed double, pct_not_completed double")
    two = weekly(spark, (W1, 1.0, 1.0, 1.0, 1), (W2, 1.0, 1.0, 1.0, 1))
    assert rows(al.completion_summary(results, two, W2)) == [(W2, 6, 50.0, 50.0)]
    assert al.completion_summary(results, two.filter(F.col("week") == W1), W2).count() == 0
    assert al.completion_summary(results, two.select("week"), W2).count() == 0


def test_long_form_and_generic_totals(spark, rows):
    df = oc.with_week(cases(spark, case(W1, "No", "a"), case(W1, "No", "a"), case(W1, "No", "b"), case(W1, "No")))
    assert rows(oc.label_counts(df, "reason")) == [(W1, "a", 2), (W1, "b", 1)]
    wide = spark.createDataFrame([("w", "3", "1"), ("v", "x", "2"), ("u", None, None)], "range string, a string, b string")
    assert rows(oc.add_total_and_shares(wide, skip=["range"])) == [
        ("u", None, None, 0.0, None, None), ("v", "x", "2", 2.0, None, 100.0), ("w", "3", "1", 4.0, 75.0, 25.0),
    ]


def test_agent_summary_and_periods(spark, rows):
    df = cases(
        spark,
        case(W1, "Yes", submission=labels.ON_OWN), case(W1, "Yes", submission=labels.SUBMITTED),
        case(W1, "No", labels.DOES_NOT_WANT), case(W1, "Yes", labels.DOES_NOT_WANT, labels.SUBMITTED),
        case(W2, "No", "other", labels.SUBMITTED, agent="y@example.com"),
        case(W1, "Yes", agent=None), case(W1, "Yes", disposition="Open"),
    )
    got = ag.agent_summary(ag.completed_cases(df))
    assert rows(got) == [
        ("x@example.com", 4, 3, 75.0, 1, 25.0, 1, 25.0, 1, 25.0, 33.3, 66.7),
        ("y@example.com", 1, 0, 0.0, 1, 100.0, 0, 0.0, 0, 0.0, None, None),
    ]
    for as_of, period, n in [(W1, "daily", 5), (W1 + timedelta(1), "daily", 0), (W2, "weekly", 1), (W2, "monthly", 6)]:
        assert ag.completed_cases(df, as_of, period).count() == n
    with pytest.raises(ValueError):
        ag.completed_cases(df, W1, "hourly")


AGENT = "agent string, total_completed long, pct_accepted double, pct_does_not_want double, pct_on_own_of_accepted double, pct_submitted_of_accepted double"


def scored(spark, *data):
    df = spark.createDataFrame(list(data), AGENT)
    return df.withColumns({c: F.lit(0.0) for c in ("pct_declined", "pct_on_own_of_total")})


def test_flags(spark):
    df = scored(
        spark,
        ("high-low", 100, 84.0, 0.0, 10.0, 10.0),  # exactly at the threshold is not low
        ("low-low", 150, 83.9, 30.0, 20.0, 20.0),
        ("low-high", 200, 50.0, 30.0, 30.0, 60.0),
        ("fine", 120, 90.0, 0.0, 40.0, 70.0),
        ("no-rates", 100, 0.0, 40.0, None, None),
        ("too-few", 99, 10.0, 90.0, 90.0, 0.0),
    )
    got = {r.agent: r for r in ag.performance_flags(df).collect()}
    # means over kept agents: submitted (10+20+60+70)/4 = 40, does not want (0+30+30+0+40)/5 = 20; 0.75 quantile = 32.5
    assert {a: r.performance_flag for a, r in got.items()} == {
        "high-low": "a", "low-low": "b, c", "low-high": "c", "fine": "", "no-rates": "c",
    }
    assert {a for a, r in got.items() if r.above_75th_percentile} == {"fine"}
    assert tuple(ag.thresholds(df).first()) == (100, 84.0, 40.0, 20.0)
    assert [r.agent for r in ag.performance_flags(df).collect()] == ["high-low", "low-low", "low-high", "fine", "no-rates"]

    flagged = al.flagged_agents(ag.performance_flags(df)).collect()
    assert [(r.flag, r.agent) for r in flagged] == [
        ("a", "high-low"), ("b", "low-low"), ("c", "low-low"), ("c", "low-high"), ("c", "no-rates"),
    ]
    assert flagged[0].title.startswith("High Accepted") and flagged[0].avg_submitted == 40.0


def test_a_quantile_tie_is_not_above(spark):
    df = scored(spark, *[(f"a{i}", 100, 90.0, 0.0, 50.0, 50.0) for i in range(4)])
    assert not any(r.above_75th_percentile for r in ag.performance_flags(df).collect())


def test_agents_share_one_shuffle_of_the_cases(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = ag.performance_flags(ag.agent_summary(cases(spark, case(W1, "Yes")).repartition(2)), 1)
        df.collect()
        assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_agents_give_an_empty_report(spark):
    df = ag.agent_report(cases(spark, case(W1, "Yes")), date(2020, 1, 1))
    assert df.count() == 0 and "performance_flag" in df.columns


@pytest.mark.parametrize("n, listed", [(99, True), (100, False)])
def test_under_minimum(spark, n, listed):
    df = cases(spark, *[case(W1, "Yes")] * n, case(W2, "Yes"))
    got = ag.under_min_completions(df, W1 + timedelta(3)).collect()
    assert [(r.agent, r.week, r.total_completed) for r in got] == (
        [("x@example.com", "03/02/2026 - 03/08/2026", n)] if listed else []
    )


def weekly(spark, *data):
    """(week, share submitted, share on own, ratio, without workflow)"""
    names = ["week", f"% {labels.SUBMITTED}", f"% {labels.ON_OWN}", oc.RATIO, labels.NO_WORKFLOW]
    types = ["date", "double", "double", "double", "long"]
    return spark.createDataFrame(list(data), ", ".join(f"`{n}` {t}" for n, t in zip(names, types)))


def test_week_over_week(spark):
    df = weekly(spark, (W1, 10.0, 5.0, 1.0, 3), (W2, 12.0, 7.0, 1.0, 11))
    got = {r.metric: r for r in al.week_over_week(df, W2 + timedelta(2)).collect()}
    up, own, flat = (got[m.label] for m in al.WEEKLY_METRICS)
    assert (up.change, up.improved, up.direction, up.previous_week, up.current_week) == (2.0, True, "increased", W1, W2)
    assert (own.change, own.improved, own.direction) == (2.0, False, "increased")
    assert (flat.change, flat.improved, flat.direction) == (0.0, False, "decreased")


def test_absent_week_falls_back_to_the_last(spark):
    df = weekly(spark, (W1, 10.0, 5.0, 1.0, 3), (W2, 12.0, None, 1.0, 11))
    later = {r.metric: r for r in al.week_over_week(df, date(2026, 6, 1)).collect()}
    first = later[al.WEEKLY_METRICS[0].label]
    assert (first.previous_week, first.current_week, first.change) == (W2, W2, 0.0)
    missing = later[al.WEEKLY_METRICS[1].label]
    assert (missing.change, missing.improved, missing.direction) == (None, False, "decreased")


def test_one_week_or_no_metric_gives_nothing(spark):
    one = weekly(spark, (W1, 10.0, 5.0, 1.0, 30))
    declines = spark.createDataFrame([(W1, 90.0)], f"week date, `% {labels.DOES_NOT_WANT}` double")
    assert al.week_over_week(one, W1).count() == 0
    assert al.threshold_alerts(one, declines, W1).count() == 0
    bare = weekly(spark, (W1, 1.0, 1.0, 1.0, 30), (W2, 1.0, 1.0, 1.0, 30)).select("week", labels.NO_WORKFLOW)
    assert al.week_over_week(bare, W2).count() == 0 and al.threshold_alerts(bare, declines, W2).count() == 0
    some = weekly(spark, (W1, 1.0, 1.0, 1.0, 30), (W2, 1.0, 1.0, 1.0, 30)).drop(oc.RATIO)
    assert al.week_over_week(some, W2).count() == 2


@pytest.mark.parametrize("count, share, want", [(10, 25.0, 0), (11, 25.0, 1), (10, 25.1, 1), (11, 90.0, 2)])
def test_threshold_alerts(spark, count, share, want):
    df = weekly(spark, (W1, 1.0, 1.0, 1.0, 99), (W2, 1.0, 1.0, 1.0, count))
    declines = spark.createDataFrame([(W1, 99.0), (W2, share)], f"week date, `% {labels.DOES_NOT_WANT}` double")
    alerts = al.threshold_alerts(df, declines, W2).collect()
    assert len(alerts) == want and all(r.week == W2 for r in alerts)


def test_disposition_rollup(spark, rows):
    codes = spark.createDataFrame([(24,), (73,), (16,), (59,)], "code int")
    got = disposition_rollup(codes, "Look here")
    assert rows(got, "code", "label", "category", "reporting_label", "presentation_label") == [
        (16, "Error", "Error / Failure", "Audio/Connectivity Issues", "Left VM/Member Unavailable"),
        (24, "Abandon", None, "Audio/Connectivity Issues", "Left VM/Member Unavailable"),
        (59, None, None, None, None),
        (73, "Retry Preview Rescheduled Agent Specific", None, None, None),
    ]
    assert labels.reporting_by_label("Look here")["Deceased"] == "Look here"
    assert (len(labels.ANSWERED), len(labels.CONVERTABLE), len(labels.CONVERTED)) == (18, 11, 2)
    assert set(labels.CONVERTED) < set(labels.CONVERTABLE) < set(labels.ANSWERED)


def test_result_summary_export(spark, rows, tmp_path):
    df = cases(
        spark,
        case(W1, "Yes", submission=labels.SUBMITTED), case(W1, "No", labels.DOES_NOT_WANT),
        *[case(W2, "Yes", submission=None)] * 12, case(W2, "No", labels.DOES_NOT_WANT), case(W2, "Yes", submission=labels.SUBMITTED),
    )
    claims = spark.createDataFrame([(W1, "a"), (W2, "b")], "day date, document_key string")
    reports = result_summary(df, claims, W2, min_completed=1)
    stored = export_result_summary(reports, str(tmp_path), W2, W2)
    assert rows(stored["result_summary"]) == rows(reports["result_summary"])
    base = f"{tmp_path}/2026-03-09"
    header = spark.read.option("header", True).csv(f"{base}/ytd_refill_result_summary_2026-03-09.csv").columns
    assert header == ["Date Range", "Accepted", "Declined", "Total", "Not Completed", "% Accepted", "% Declined", "% Not Completed", "% Completed"]
    alerts = spark.read.parquet(f"{base}/alerts/threshold_alerts")
    assert rows(alerts, "alert", "value") == [("% Member Does Not Want Refill", 100.0), (labels.NO_WORKFLOW, 12.0)]
    agents = spark.read.option("header", True).csv(f"{base}/weekly_agent_refill_submission_rate_2026-03-09.csv")
    assert agents.columns[-2:] == ["Above 75th Percentile", "Performance Flag"]

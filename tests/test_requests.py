from datetime import date, datetime

from ringwise.operators import requests as rq
from ringwise.plans.request_report import export_request_reports, request_reports

START, BOT = date(2026, 3, 1), "bot@example.com"
SCHEMA = "completed_ts timestamp_ntz, clerk string, label string"
S, O = "Refill Submitted", "Out of Refill - Refill Request"


def requests(spark):
    d = datetime
    return spark.createDataFrame(
        [
            (d(2026, 3, 1, 0, 0), " BOT@example.com", S),
            (d(2026, 3, 3, 9, 0), "bot@example.com ", None),
            (d(2026, 3, 3, 9, 0), "ann@example.com", S),
            (d(2026, 3, 3, 9, 0), "ann@example.com", f" {O} "),
            (d(2026, 3, 3, 23, 59), "bob@example.com", " "),
            (d(2026, 3, 9, 9, 0), None, "Left VM"),
            (d(2026, 2, 28, 9, 0), "ann@example.com", "Too early"),
            (None, "ann@example.com", "No date"),
        ],
        SCHEMA,
    )


def test_summary(spark, rows):
    got = rq.request_summary(requests(spark), START, BOT)
    assert rows(got, ordered=True) == [
        ("(Blank)", 2, "33.3%", 1, "50.0%", 1, "33.3%"),
        ("Left VM", 1, "16.7%", 0, "0.0%", 0, "0.0%"),
        (O, 1, "16.7%", 0, "0.0%", 1, "33.3%"),
        (S, 2, "33.3%", 1, "50.0%", 1, "33.3%"),
        ("Grand Total", 6, "", 2, "", 3, ""),
    ]


def test_summary_of_nothing_is_a_zero_total(spark, rows):
    got = rq.request_summary(requests(spark), date(2030, 1, 1), BOT)
    assert rows(got) == [("Grand Total", 0, "", 0, "", 0, "")]


def test_weekly_summary_has_every_label_in_every_week(spark, rows):
    got = rows(rq.request_weekly_summary(requests(spark), START, BOT), ordered=True)
    weeks = [date(2026, 2, 23), date(2026, 3, 2), date(2026, 3, 9)]
    assert [r[:2] for r in got] == [(w, x) for w in weeks for x in ("(Blank)", "Left VM", O, S, "Grand Total")]
    assert got[3] == (weeks[0], S, 1, "100.0%", 1, "100.0%", 0, "0%")
    assert got[5] == (weeks[1], "(Blank)", 2, "50.0%", 1, "100.0%", 1, "33.3%")
    assert got[11] == (weeks[2], "Left VM", 1, "100.0%", 0, "0%", 0, "0%")
    assert got[14] == (weeks[2], "Grand Total", 1, "", 0, "", 0, "")


def test_clerks(spark, rows):
    got = rq.clerk_daily(requests(spark), date(2026, 3, 3), BOT, ["", O, S])
    assert got.columns == ["clerk", "total_completed", "(Blank)", "% (Blank)", O, f"% {O}", S, f"% {S}", "combined_refills"]
    assert rows(got, ordered=True) == [
        ("ann@example.com", 2, 0, 0.0, 1, 50.0, 1, 50.0, 2),
        ("bob@example.com", 1, 1, 100.0, 0, 0.0, 0, 0.0, 0),
    ]
    assert rq.clerk_daily(requests(spark), date(2026, 3, 8), BOT, []).count() == 0
    long = rq.clerk_daily_long(requests(spark), date(2026, 3, 3), BOT)
    assert rows(long, "clerk", "label", "rows", "total_completed", "share", "combined_refills", ordered=True) == [
        ("ann@example.com", O, 1, 2, 50.0, 2), ("ann@example.com", S, 1, 2, 50.0, 2), ("bob@example.com", "(Blank)", 1, 1, 100.0, 0),
    ]


def test_reports_default_to_yesterday(spark, tmp_path):
    frames = request_reports(requests(spark), date(2026, 3, 4), BOT, START)
    assert frames["clerks"].select("clerk").distinct().count() == 2 and frames["clerks"].count() == 3
    export_request_reports(frames, str(tmp_path), date(2026, 3, 4))
    weekly = spark.read.option("header", True).csv(f"{tmp_path}/2026-03-04/pharmacy_request_weekly_ai_vs_agent_2026-03-04.csv")
    assert weekly.columns == ["Week", "Row Labels", "Count of dispo", "Total %", "AI", "AI %", "Agent", "Agent %"]
    assert weekly.filter("Week = '03/02/2026 - 03/08/2026'").count() == 5

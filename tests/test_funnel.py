import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ringwise import labels
from ringwise.operators import funnel as fu
from ringwise.operators import leads as le

LEAD = (
    "leadid string, card_id string, dependent_code string, contract string, stars_1 string, stars_2 string, "
    "stars_3 string, file_date date"
)
SCRUBBED = "leadid string, idcard_mbr_id string, stars_1 string, stars_2 string, stars_3 string, file_date date"
CALLS = (
    "leadid string, idcard_mbr_id string, attempt_ts timestamp_ntz, call_status_1 string, call_status_2 string, "
    "call_status_3 string, file_date date"
)
D1 = date(2026, 3, 2)


def lead_frame(spark, data):
    return le.with_member_key(spark.createDataFrame(data, LEAD))


def test_splits_overlap_and_unknown_contracts_are_default(spark, rows):
    data = [
        ("a", "A", "1", None, "Stars", None, None, D1),
        ("b", "B", "1", "S5884", "Nonstars", "Stars", None, D1),
        ("c", "C", "1", "H1", "Both", "Stars", None, D1),
        ("d", "D", "1", "S5552", None, None, None, D1),
    ]
    split = le.contract_star_splits(lead_frame(spark, data), le.Splits())
    assert rows(split, "split", "leadid") == [
        ("ALL:All", "a"), ("ALL:All", "b"), ("ALL:All", "c"), ("ALL:All", "d"),
        ("MAPD:Both", "c"), ("MAPD:Stars", "a"), ("MAPD:Stars", "c"), ("S5884:Stars", "b"),
    ]


def test_splits_from_text(spark, rows):
    splits = le.Splits.parse(["H1:Stars", "H1:All", "MAPD:All"], listed=["H1"])
    assert splits.names == ["H1:Stars", "H1:All", "MAPD:All", "ALL:All"]
    data = [("a", "A", "1", "H1", "Nonstars", None, None, D1), ("b", "B", "1", "H2", None, None, None, D1)]
    split = le.contract_star_splits(lead_frame(spark, data), splits)
    assert rows(split, "split", "leadid") == [("ALL:All", "a"), ("ALL:All", "b"), ("H1:All", "a"), ("MAPD:All", "b")]


def test_member_semi_join_matches_null_with_null(spark, rows):
    members = spark.createDataFrame([("A1",), (None,), ("A1",)], "idcard_mbr_id string")
    found = spark.createDataFrame([("x", "A1"), ("y", None), ("z", "B1")], "leadid string, idcard_mbr_id string")
    assert rows(le.member_semi_join(found, members), "leadid") == [("x",), ("y",)]
    assert rows(le.member_semi_join(found, members.filter("idcard_mbr_id IS NOT NULL")), "leadid") == [("x",)]


def test_contact_dates_and_right_day(spark, rows):
    drops = spark.createDataFrame([("a", D1), ("a", D1 + timedelta(1)), ("b", D1)], "leadid string, file_date date")
    dates = le.lead_index_date(drops)
    assert rows(dates) == [("a", D1 + timedelta(1)), ("b", D1)]
    calls = spark.createDataFrame(
        [("a", datetime(2026, 3, 2, 9)), ("a", datetime(2026, 3, 3, 9)), ("b", None), ("c", datetime(2026, 3, 2, 9)), (None, None)],
        "leadid string, attempt_ts timestamp_ntz",
    )
    assert rows(le.right_day_contacts(calls, dates), "leadid", "attempt_ts") == [("a", datetime(2026, 3, 3, 9))]


def test_dedup_keeps_one_row_for_null_keys(spark, rows):
    df = spark.createDataFrame([(D1, "a", 2), (D1, "a", 1), (D1, None, 5), (D1, None, 4)], "file_date date, leadid string, n int")
    assert rows(le.dedup_leads(df, ["n"])) == [(D1, "a", 1), (D1, None, 4)]


def test_first_disposition(spark, rows):
    t = datetime(2026, 3, 2, 9)
    df = spark.createDataFrame(
        [("a", D1, t, "Left VM"), ("a", D1, t, "DNC"), ("a", D1, t - timedelta(hours=1), None), ("a", D1, None, "x"), (None, D1, t, "x"), ("b", D1, t, "Left VM"), ("b", D1, t, "DNC")],
        "leadid string, file_date date, attempt_ts timestamp_ntz, call_status_1 string",
    )
    got = le.first_disposition(df, ["call_status_1"])
    assert rows(got, "leadid", "call_status_1") == [("a", None), ("b", "DNC")]


@pytest.mark.parametrize("statuses, first, again", [(("Declined", "No Answer"), "Declined", 0), (("No Answer", "No Answer"), "No Answer", 1)])
def test_funnel_and_first_disposition_break_ties_alike(spark, rows, statuses, first, again):
    drop = "idcard_mbr_id string, leadid string, contract string, stars_1 string, stars_2 string, stars_3 string, file_date date"
    leads = spark.createDataFrame([("m", "a", "H1", None, None, None, D1)], drop)
    at = datetime.combine(D1, datetime.min.time())
    calls = spark.createDataFrame(
        [("m", "a", D1, at, s, None, None) for s in (*statuses, "No Answer")[:2]],
        "idcard_mbr_id string, leadid string, file_date date, attempt_ts timestamp_ntz, call_status_1 string, call_status_2 string, call_status_3 string",
    )
    assert rows(le.first_disposition(calls), "call_status_1") == [(first,)]
    funnel = fu.weekly_funnel(leads, leads, calls, scrub_order=["idcard_mbr_id"])
    assert rows(funnel, "split", "attempted_leads", "available_for_second") == [("ALL:All", 1, again), ("MAPD:Stars", None, None)][:1]


def test_funnel_splits_a_filler_lead_id(spark):
    n = 900
    leads = spark.range(n).select(
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("idcard_mbr_id"),
        F.when(F.col("id") % 3 == 0, "0").otherwise(F.col("id").cast("string")).alias("leadid"),
        F.lit("H1").alias("contract"), *[F.lit(None).cast("string").alias(f"stars_{i}") for i in (1, 2, 3)], F.lit(D1).alias("file_date"),
    )
    calls = leads.select(
        "idcard_mbr_id", "leadid", "file_date", F.lit(D1).cast("timestamp_ntz").alias("attempt_ts"), F.lit("No Answer").alias("call_status_1"),
        *[F.lit(None).cast("string").alias(f"call_status_{i}") for i in (2, 3)],
    )
    one = fu.weekly_funnel(leads, leads, calls, scrub_order=["idcard_mbr_id"], rows_per_slice=50)
    whole = fu.weekly_funnel(leads, leads, calls, scrub_order=["idcard_mbr_id"])
    assert sorted(map(str, one.collect())) == sorted(map(str, whole.collect())) and one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_key_salt") > 4  # both joins of the calls carry salts


def test_attempt_counts(spark, rows):
    df = spark.createDataFrame([(D1, "a"), (D1, "a"), (D1, "b"), (D1, None)], "file_date date, leadid string")
    assert rows(le.attempt_counts(df)) == [(D1, 2, 1)]


def test_outer_fold(spark, rows):
    a = spark.createDataFrame([(D1, 1)], "file_date date, a long")
    b = spark.createDataFrame([(D1, 2), (D1 + timedelta(1), 3)], "file_date date, b long")
    assert rows(le.outer_fold([a, b], ["file_date"])) == [(D1, 1, 2), (D1 + timedelta(1), 0, 3)]


def test_missing_days(spark, rows):
    present = spark.createDataFrame([(D1,), (D1 + timedelta(2),), (D1 + timedelta(30),)], "file_date date")
    assert rows(le.missing_days(spark, present, D1, D1 + timedelta(3))) == [(D1 + timedelta(1),), (D1 + timedelta(3),)]


def test_area_codes(spark, rows):
    drop = spark.createDataFrame([("a", "2065550000"), ("b", "9995550000"), ("c", None)], "leadid string, phone string")
    codes = spark.createDataFrame([("206",), ("425",)], "area_code string")
    assert rows(le.area_code_members(drop, codes)) == [("a", "2065550000")]


# --- the whole funnel against a restatement in plain Python -------------------------------


def rate(num, den, fill=None):
    if num is None or den is None or (num == 0 and den == 0):
        return fill
    if den == 0:
        return None
    return half_even(num / den * 100)


def half_even(x):
    import numpy as np

    return float(np.round(x, 1))


def twin(leads, scrubbed, calls, splits, listed):
    out = {}

    def key(lead):
        return None if lead["card_id"] is None or lead["dependent_code"] is None else lead["card_id"] + lead["dependent_code"]

    def stars(row):
        return {row["stars_1"], row["stars_2"], row["stars_3"]}

    first_scrubbed = {}
    for e in sorted(scrubbed, key=lambda e: [(v is not None, v or "") for v in (e["idcard_mbr_id"], e["stars_1"], e["stars_2"])]):
        first_scrubbed.setdefault((e["file_date"], e["leadid"]), e)

    for group, star in splits:
        def inside(lead):
            if (group, star) == ("ALL", "All"):
                return True
            in_group = lead["contract"] not in listed if group == "MAPD" else lead["contract"] == group
            return in_group and (star == "All" or star in stars(lead))

        chosen = [x for x in leads if inside(x)]
        members = {key(x) for x in chosen}
        index = {}
        for x in chosen:
            if x["leadid"] is not None:
                index[x["leadid"]] = max(index.get(x["leadid"], date.min), x["file_date"])
        available = defaultdict(int)
        for e in first_scrubbed.values():
            if e["idcard_mbr_id"] in members and (star == "All" or star in stars(e)):
                available[e["file_date"]] += 1
        if not chosen or not available:
            continue
        mine = [c for c in calls if c["idcard_mbr_id"] in members]
        statuses = lambda c: {c["call_status_1"], c["call_status_2"], c["call_status_3"]}
        attempts = defaultdict(list)
        for c in mine:
            if c["attempt_ts"] and c["leadid"] in index and c["attempt_ts"].date() == index[c["leadid"]]:
                attempts[c["file_date"], c["leadid"]].append(c)
        for day in {x["file_date"] for x in chosen}:
            received = sum(x["file_date"] == day for x in chosen)
            tried = {k: v for k, v in attempts.items() if k[0] == day}
            n = {}
            if day in available or tried:
                on_day = [c for c in mine if c["file_date"] == day]
                n["attempted"] = len(tried)
                n["second"] = sum(len(v) >= 2 for v in tried.values())
                retry = lambda c: bool(statuses(c) & set(labels.RETRYABLE))
                n["retry"] = sum(retry(min(v, key=lambda c: (c["attempt_ts"], retry(c)))) for v in tried.values())
                n["reached"] = sum(bool(statuses(c) & set(labels.REACHED)) for c in on_day)
                for name, label in (("submitted", labels.SUBMITTED), ("request", labels.OUT_OF_REFILL), ("own", labels.ON_OWN)):
                    n[name] = sum(label in statuses(c) for c in on_day)
            a, r, s, o = n.get("attempted"), n.get("reached"), n.get("submitted"), n.get("own")
            v = available.get(day)
            both = None if s is None else s + o
            reach_fill = None if a is None else 0.0
            out[f"{group}:{star}", day] = (
                received, v, a, rate(a, v), n.get("retry"), n.get("second"), rate(n.get("second"), v), r,
                rate(r, a, reach_fill), s, o, rate(both, r, reach_fill), rate(s, r, reach_fill), n.get("request"),
                rate(None if v is None else received - v, received), rate(both, a, 0.0), rate(s, a, 0.0),
            )
    return out


def random_inputs(seed):
    rng = random.Random(seed)
    days = [D1 + timedelta(i) for i in range(4)]
    maybe = lambda xs, p=0.15: None if rng.random() < p else rng.choice(xs)
    star = lambda: maybe(["Stars", "Nonstars", "Both"], 0.4)
    ids = [f"L{i}" for i in range(12)]
    cards = [f"M{i}" for i in range(9)]
    status = [*labels.RETRYABLE[:2], *labels.REACHED[:4], "Wrong Number"]
    leads = [
        dict(leadid=maybe(ids, 0.05), card_id=maybe(cards), dependent_code=maybe(["1", "2"]),
             contract=maybe(["S5884", "S5552", "H1"]), stars_1=star(), stars_2=star(), stars_3=star(), file_date=rng.choice(days))
        for _ in range(60)
    ]
    scrubbed = [
        dict(leadid=maybe(ids), idcard_mbr_id=maybe([c + d for c in cards for d in "12"]), stars_1=star(), stars_2=star(),
             stars_3=None, file_date=rng.choice(days[1:]))
        for _ in range(50)
    ]
    calls = [
        dict(leadid="L0" if rng.random() < 0.3 else maybe(ids), idcard_mbr_id=maybe([c + d for c in cards for d in "12"]),
             attempt_ts=maybe([datetime(d.year, d.month, d.day, h, 30, 0, 5000) for d in days for h in (9, 15)]),
             call_status_1=maybe(status), call_status_2=maybe(status, 0.6), call_status_3=maybe(status, 0.8), file_date=rng.choice(days))
        for _ in range(150)
    ]
    return leads, scrubbed, calls


def frame(spark, data, schema):
    names = [part.split()[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(d[n] for n in names) for d in data], schema)


@pytest.mark.parametrize("seed, rows_per_slice", [(1, 1_000_000), (2, 10), (3, 25)])
def test_funnel_equals_plain_restatement(spark, seed, rows_per_slice):
    leads, scrubbed, calls = random_inputs(seed)
    got = fu.weekly_funnel(
        le.with_member_key(frame(spark, leads, LEAD)),
        frame(spark, scrubbed, SCRUBBED),
        frame(spark, calls, CALLS).repartition(5),
        scrub_order=["idcard_mbr_id", "stars_1", "stars_2"],
        rows_per_slice=rows_per_slice,
    )
    assert got.columns == ["split", *fu.FUNNEL_COLUMNS]
    found = {(r.split, r.file_date): tuple(r)[2:] for r in got.collect()}
    want = twin(leads, scrubbed, calls, [*labels.DEFAULT_SPLITS, ("ALL", "All")], labels.LISTED_CONTRACTS)
    assert found == want
    for row in found.values():
        if row[2] is not None:
            assert row[5] <= row[2] <= 12 and row[4] <= row[2]


def test_splits_without_available_leads_are_skipped(spark, rows):
    drop = lead_frame(spark, [("a", "A", "1", "S5884", "Stars", None, None, D1), ("b", "B", "1", "H1", "Stars", None, None, D1)])
    scrubbed = spark.createDataFrame([("b", "B1", "Stars", None, None, D1)], SCRUBBED)
    calls = spark.createDataFrame([], CALLS)
    got = fu.weekly_funnel(drop, scrubbed, calls)
    assert rows(got, "split", "leads_received", "leads_available", "attempted_leads", "scrub_rate") == [
        ("ALL:All", 2, 1, 0, 50.0), ("MAPD:Stars", 1, 1, 0, 0.0),
    ]


def test_infinite_rates_on_request(spark):
    counts = spark.createDataFrame(
        [("x", D1, 5, 4, 0, 0, 0, 2, 1, 0, 1)],
        "split string, file_date date, leads_received long, leads_available long, attempted_leads long, second_attempts long, "
        "available_for_second long, reached_leads long, submitted long, refill_request long, on_own long",
    )
    assert fu.funnel_rates(counts).first().reach_rate is None
    assert fu.funnel_rates(counts, inf_policy="inf").first().reach_rate == float("inf")


def test_impute_rates(spark, rows):
    data = [
        (date(2026, 3, 2), "10", "8.0", "2", "1", "5", "", None, None, ""),
        (date(2026, 3, 1), "4", "", None, "1", "0", None, "7.5", "3.0", None),
    ]
    text = spark.createDataFrame(
        data,
        "file_date date, leads_received string, leads_available string, submitted string, on_own string, attempted_leads string, "
        "reached_leads string, scrub_rate string, refill_of_attempted_rate string, submitted_of_attempted_rate string",
    )
    assert rows(fu.impute_rates(text), ordered=True) == [
        (date(2026, 3, 1), 4, 0, 0, 1, 0, 0, 7.5, 3.0, None),
        (date(2026, 3, 2), 10, 8, 2, 1, 5, 0, 20.0, 60.0, 40.0),
    ]
    assert fu.reports_of_year(text, 2025).count() == 0 and fu.reports_of_year(text, 2026).count() == 2


def test_status_flags(spark, rows):
    df = spark.createDataFrame(
        [(D1, None, "DNC", None), (D1, "Refill Submitted", None, "Refill Submitted"), (D1, None, None, None)],
        "file_date date, call_status_1 string, call_status_2 string, call_status_3 string",
    )
    assert rows(le.counts_by_file_date(df, fu.status_flags())) == [(D1, 2, 1, 0, 0)]


def test_calls_on_another_day_meet_without_their_lead(spark):
    """They only add to sums per split and date: kept apart by lead they would all be shuffled."""
    splits = fu.Splits([("MAPD", "Stars")])
    day, other = date(2026, 1, 1), date(2026, 1, 2)
    rows = [(day, "L1", day, 1, True, True, day, day), (day, "L1", other, 2, True, True, day, other), (day, None, day, 4, False, True, None, None)]
    dated = spark.createDataFrame(
        rows, "file_date date, leadid string, attempt_date date, calls long, in_0 boolean, in_1 boolean, index_0 date, index_1 date"
    )
    got = {tuple(r) for r in fu.split_calls(dated, splits, ["calls"]).select("split", "leadid", "calls", "right_day").collect()}
    assert got == {
        ("MAPD:Stars", "L1", 1, True), ("MAPD:Stars", None, 2, False), ("ALL:All", "L1", 1, True),
        ("ALL:All", "L1", 2, True), ("ALL:All", None, 4, False),
    }

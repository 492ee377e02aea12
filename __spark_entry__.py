
from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date, datetime, timezone
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from oracle_queries import MIN_COMPLETED, ORACLES, REASONS, RESULTS  # noqa: E402
from ringwise import functions as fx  # noqa: E402
from ringwise import labels  # noqa: E402
from ringwise.bindings import bind  # noqa: E402
from ringwise.operators import agents, alerts, calls, funnel, leads, outcomes, requests, scrub  # noqa: E402
from ringwise.operators.dispositions import disposition_rollup  # noqa: E402
from ringwise.plans.never_answered import never_answered_report  # noqa: E402
from ringwise.sources.call_log import recent_calls, unify_call_logs  # noqa: E402

try:
    import corpus_pipeline
    import llm.queries as llm_queries
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "llm", "llm.queries"):
        raise
    llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

OUTBOUND = [f"skill-{i}" for i in range(1, 6)]
INBOUND = ["skill-6", "skill-7"]
BOT = "bot@example.com"
CASE_DAY = date(1998, 6, 17)
REQUESTS_SINCE = date(1996, 3, 1)
SCRUB_DAY = date(2024, 1, 30)
SCRUB_ORDER = ["idcard_mbr_id", "stars_1", "stars_2"]
ACCEPTED_THRESHOLD = 33.0


def _utc(*parts: int) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


FIRST, LAST = _utc(1995, 1, 1), _utc(2001, 12, 31, 23, 59, 59)
CHANGE = _utc(1998, 6, 1)
BEFORE_CHANGE = _utc(1998, 5, 31, 23, 59, 59)
ALL_OUT = calls.Window(FIRST, LAST, OUTBOUND)
NOW_OUT, THEN_OUT = calls.Window(CHANGE, LAST, OUTBOUND), calls.Window(FIRST, BEFORE_CHANGE, OUTBOUND)
NOW_IN, THEN_IN = calls.Window(CHANGE, LAST, INBOUND), calls.Window(FIRST, BEFORE_CHANGE, INBOUND)


def _calls(spark: SparkSession, d: str) -> DataFrame:
    return unify_call_logs(bind(spark, d, "call_log_current"), bind(spark, d, "call_log_prior"))


def _year(log: DataFrame, year: int) -> DataFrame:
    return log.filter(F.col("log_year") == year)


def skill_metrics(spark: SparkSession, d: str) -> DataFrame:
    kpis = calls.skill_metrics(_calls(spark, d), ALL_OUT)
    return kpis.withColumn("skill", F.array_join("skill", ","))


def pickup_rate_by_destination(spark: SparkSession, d: str) -> DataFrame:
    return calls.pickup_rate_by_destination(_calls(spark, d), ALL_OUT)


def outbound_stats_by_number(spark: SparkSession, d: str) -> DataFrame:
    return calls.outbound_stats_by_number(_year(_calls(spark, d), 2026), NOW_OUT, min_attempts=3)


def outbound_never_answered(spark: SparkSession, d: str) -> DataFrame:
    return calls.outbound_stats_by_number(_year(_calls(spark, d), 2025), THEN_OUT, 3, never_answered_only=True)


def outbound_both_periods(spark: SparkSession, d: str) -> DataFrame:
    log = _calls(spark, d)
    return calls.outbound_both_periods(_year(log, 2026), _year(log, 2025), NOW_OUT, THEN_OUT, min_attempts=3)


def inbound_callbacks(spark: SparkSession, d: str) -> DataFrame:
    numbers = outbound_stats_by_number(spark, d)
    return calls.inbound_callbacks(_year(_calls(spark, d), 2026), NOW_IN, numbers)


def never_answered(spark: SparkSession, d: str) -> DataFrame:
    log = _calls(spark, d)
    return never_answered_report(
        _year(log, 2026), NOW_OUT, NOW_IN, _year(log, 2025), THEN_OUT, THEN_IN, never_answered_only=True
    )


def never_answered_clean_first(spark: SparkSession, d: str) -> DataFrame:
    log = _calls(spark, d)
    return never_answered_report(
        _year(log, 2026), NOW_OUT, NOW_IN, _year(log, 2025), THEN_OUT, THEN_IN, never_answered_only=True, clean_first=True
    )


def never_answered_current(spark: SparkSession, d: str) -> DataFrame:
    return never_answered_report(_year(_calls(spark, d), 2026), NOW_OUT, NOW_IN)


def never_answered_subset(spark: SparkSession, d: str) -> DataFrame:
    log = _calls(spark, d)
    silent = calls.outbound_stats_by_number(_year(log, 2026), NOW_OUT, 3, never_answered_only=True)
    return calls.never_answered_destinations(_year(log, 2025), silent.withColumnRenamed("member_phone", "destination"))


def _numbers(clean) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        return bind(spark, d, "raw_numbers").withColumn("clean", clean(F.col("phone")))

    return query


def blank_to_default(spark: SparkSession, d: str) -> DataFrame:
    label = fx.blank_to_default(F.col("submission"), labels.NO_WORKFLOW).alias("submission")
    return bind(spark, d, "case_report").groupBy(label).agg(F.count(F.lit(1)).alias("cases"))


def parse_attempt_ts(spark: SparkSession, d: str) -> DataFrame:
    return _attempts(spark, d).select("leadid", "contact_attempt_date_time", "attempt_ts")


def week_label(spark: SparkSession, d: str) -> DataFrame:
    weeks = outcomes.with_week(bind(spark, d, "case_report")).groupBy("week").agg(F.count(F.lit(1)).alias("cases"))
    return weeks.select("week", fx.week_label(F.col("week")).alias("label"), "cases")


def report_end_date(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return spark.read.parquet(f"{d}/orders.parquet").select(
        "o_orderkey", "o_orderdate", fx.report_end_day(day).alias("report_end_day"), fx.report_end(day).alias("report_end")
    )


def rollup_of_codes(spark: SparkSession, d: str) -> DataFrame:
    codes = spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_quantity").cast("int").alias("code"))
    return disposition_rollup(codes.groupBy("code").agg(F.count(F.lit(1)).alias("calls")))


def missing_days(spark: SparkSession, d: str) -> DataFrame:
    present = spark.read.parquet(f"{d}/orders.parquet").select(F.to_date("o_orderdate").alias("file_date"))
    return leads.missing_days(spark, present, date(1995, 1, 1), date(2001, 12, 31))


def status_any_of(spark: SparkSession, d: str) -> DataFrame:
    status = leads.cols(leads.STATUS_COLUMNS)
    return (
        bind(spark, d, "call_disposition")
        .groupBy(*leads.STATUS_COLUMNS)
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("reached", fx.any_of(status, labels.REACHED))
        .withColumn("retryable", fx.any_of(status, labels.RETRYABLE))
    )


def _leads(spark: SparkSession, d: str) -> DataFrame:
    drop = bind(spark, d, "lead_drop").filter(F.col("record_kind") != "F")
    return leads.with_member_key(drop)


def _attempts(spark: SparkSession, d: str) -> DataFrame:
    return funnel.with_attempt_time(bind(spark, d, "call_disposition"))


def contract_star_splits(spark: SparkSession, d: str) -> DataFrame:
    split = leads.contract_star_splits(_leads(spark, d), leads.Splits())
    return split.select("split", "leadid", "idcard_mbr_id", "contract", "stars_1", "stars_2", "file_date")


def member_semi_join(spark: SparkSession, d: str) -> DataFrame:
    split = _leads(spark, d).filter(leads.Splits([("S5884", "Stars")]).conditions()[0])
    rows = bind(spark, d, "call_disposition").select("leadid", "idcard_mbr_id", "file_date", "call_status_1")
    return leads.member_semi_join(rows, split)


def lead_index_date(spark: SparkSession, d: str) -> DataFrame:
    return leads.lead_index_date(_leads(spark, d))


def dedup_leads(spark: SparkSession, d: str) -> DataFrame:
    return leads.dedup_leads(bind(spark, d, "scrubbed_lead"), SCRUB_ORDER)


def right_day_contacts(spark: SparkSession, d: str) -> DataFrame:
    attempts = _attempts(spark, d).select("leadid", "idcard_mbr_id", "file_date", "attempt_ts")
    return leads.right_day_contacts(attempts, lead_index_date(spark, d))


def first_disposition(spark: SparkSession, d: str) -> DataFrame:
    attempts = _attempts(spark, d).select("leadid", "file_date", "attempt_ts", *leads.STATUS_COLUMNS)
    return leads.first_disposition(attempts, leads.STATUS_COLUMNS)


def attempt_counts(spark: SparkSession, d: str) -> DataFrame:
    return leads.attempt_counts(_attempts(spark, d))


def disposition_counts_by_date(spark: SparkSession, d: str) -> DataFrame:
    return leads.counts_by_file_date(bind(spark, d, "call_disposition"), funnel.status_flags())


def weekly_funnel(spark: SparkSession, d: str) -> DataFrame:
    return funnel.weekly_funnel(
        _leads(spark, d), bind(spark, d, "scrubbed_lead"), _attempts(spark, d), scrub_order=SCRUB_ORDER
    )


def impute_rates(spark: SparkSession, d: str) -> DataFrame:
    return funnel.impute_rates(bind(spark, d, "past_report"))


def reports_of_year(spark: SparkSession, d: str) -> DataFrame:
    reports = bind(spark, d, "past_report").select("file_date", "leads_received", "leads_available")
    return funnel.reports_of_year(reports, 1998)


def weekly_distinct_totals(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.weekly_distinct_totals(bind(spark, d, "claims"))


def _cases(spark: SparkSession, d: str) -> DataFrame:
    return bind(spark, d, "case_report")


def weekly_result_summary(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.weekly_result_summary(_cases(spark, d), weekly_distinct_totals(spark, d))


def decline_reason_long(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.decline_reason_long(_cases(spark, d))


def submission_result_long(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.submission_result_long(_cases(spark, d))


def total_and_shares(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.add_total_and_shares(decline_reason_pivot(spark, d).select("week", *REASONS), skip=["week"])


def outcome_counts_outer(spark: SparkSession, d: str) -> DataFrame:
    rows, flags = bind(spark, d, "call_disposition"), funnel.status_flags()
    frames = [leads.counts_by_file_date(rows.filter(flags[n]), {n: flags[n]}) for n in ("submitted", "refill_request", "on_own")]
    return leads.outer_fold(frames, ["file_date"])


def area_code_members(spark: SparkSession, d: str) -> DataFrame:
    numbers = bind(spark, d, "raw_numbers")
    codes = numbers.filter(F.col("l_linenumber").isin(2, 5)).select(fx.area_code(F.col("phone")).alias("area_code"))
    return leads.area_code_members(numbers, codes)


def decline_reason_pivot(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.decline_reason_pivot(_cases(spark, d), REASONS)


def submission_result_pivot(spark: SparkSession, d: str) -> DataFrame:
    return outcomes.submission_result_pivot(_cases(spark, d), RESULTS)


def agent_summary(spark: SparkSession, d: str) -> DataFrame:
    return agents.agent_summary(agents.completed_cases(_cases(spark, d)))


def agent_performance_flags(spark: SparkSession, d: str) -> DataFrame:
    return agents.performance_flags(agent_summary(spark, d), MIN_COMPLETED, ACCEPTED_THRESHOLD)


def agent_thresholds(spark: SparkSession, d: str) -> DataFrame:
    return agents.thresholds(agent_summary(spark, d), MIN_COMPLETED, ACCEPTED_THRESHOLD)


def agent_report_daily(spark: SparkSession, d: str) -> DataFrame:
    return agents.agent_report(_cases(spark, d), CASE_DAY, "daily", 1, ACCEPTED_THRESHOLD)


def agent_report_weekly(spark: SparkSession, d: str) -> DataFrame:
    return agents.agent_report(_cases(spark, d), CASE_DAY, "weekly", 1, ACCEPTED_THRESHOLD)


def agent_report_monthly(spark: SparkSession, d: str) -> DataFrame:
    return agents.agent_report(_cases(spark, d), CASE_DAY, "monthly", 2, ACCEPTED_THRESHOLD)


def under_min_completions(spark: SparkSession, d: str) -> DataFrame:
    return agents.under_min_completions(_cases(spark, d), CASE_DAY)


def flagged_agents(spark: SparkSession, d: str) -> DataFrame:
    return alerts.flagged_agents(agent_performance_flags(spark, d), ACCEPTED_THRESHOLD)


def request_summary(spark: SparkSession, d: str) -> DataFrame:
    return requests.request_summary(bind(spark, d, "request_report"), REQUESTS_SINCE, BOT)


def request_weekly_summary(spark: SparkSession, d: str) -> DataFrame:
    return requests.request_weekly_summary(bind(spark, d, "request_report"), REQUESTS_SINCE, BOT)


def clerk_daily_long(spark: SparkSession, d: str) -> DataFrame:
    return requests.clerk_daily_long(bind(spark, d, "request_report"), date(1998, 6, 15), BOT)


def clerk_daily(spark: SparkSession, d: str) -> DataFrame:
    values = ["Refill Submitted", "Out of Refill - Refill Request", "Left VM", ""]
    return requests.clerk_daily(bind(spark, d, "request_report"), date(1998, 6, 15), BOT, values)


def recent(spark: SparkSession, d: str) -> DataFrame:
    log = bind(spark, d, "dialer_log").withColumnRenamed("number", "destination")
    return recent_calls(log, ["click", "view"], _utc(2024, 1, 30))


def _scrub_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    log = bind(spark, d, "dialer_log")
    week = log.filter(F.col("ts") >= fx.utc_literal(log, "ts", _utc(2024, 1, 23)))
    return bind(spark, d, "scrub_lead"), bind(spark, d, "dnc_list"), week


def scrub_dnc(spark: SparkSession, d: str) -> DataFrame:
    drop, dnc, _ = _scrub_inputs(spark, d)
    return scrub.members_on_dnc_list(drop, dnc)


def scrub_called_yesterday(spark: SparkSession, d: str) -> DataFrame:
    drop, _, log = _scrub_inputs(spark, d)
    return scrub.members_called_yesterday(drop, log, SCRUB_DAY)


def scrub_fatigue(spark: SparkSession, d: str) -> DataFrame:
    drop, _, log = _scrub_inputs(spark, d)
    return scrub.fatigued_members(drop, log, SCRUB_DAY)


def scrub_call_limit(spark: SparkSession, d: str) -> DataFrame:
    dialer = bind(spark, d, "dialer_log").select(F.col("number").alias("phone"), F.to_date("ts").alias("contact_date"))
    return scrub.members_past_call_limit(bind(spark, d, "scrub_lead"), dialer)


def scrub_report(spark: SparkSession, d: str) -> DataFrame:
    return scrub.scrub_report(*_scrub_inputs(spark, d), SCRUB_DAY)


def scrub_report_first_day(spark: SparkSession, d: str) -> DataFrame:
    return scrub.scrub_report(*_scrub_inputs(spark, d), SCRUB_DAY, first_day=True)


def scrub_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return scrub.without_scrubbed(bind(spark, d, "scrub_lead"), scrub_report(spark, d))


def scrub_validation(spark: SparkSession, d: str) -> DataFrame:
    reason = F.when(F.col("dependent_code") == "2", "Do not call").when(F.col("dependent_code") == "3", "Missing data")
    reason = reason.when(F.col("dependent_code") != "1", "Moved")
    return scrub.scrub_violations(scrub.scrub_rows(bind(spark, d, "scrub_lead"), reason, SCRUB_DAY))


def week_over_week(spark: SparkSession, d: str) -> DataFrame:
    return alerts.week_over_week(submission_result_pivot(spark, d), CASE_DAY)


def threshold_alerts(spark: SparkSession, d: str) -> DataFrame:
    return alerts.threshold_alerts(submission_result_pivot(spark, d), decline_reason_pivot(spark, d), CASE_DAY, 2, 5.0)


def completion_summary(spark: SparkSession, d: str) -> DataFrame:
    return alerts.completion_summary(weekly_result_summary(spark, d), submission_result_pivot(spark, d), CASE_DAY)


def entry(spark: SparkSession) -> DataFrame:
    """The weekly lead funnel: every split, one job."""
    return weekly_funnel(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = report_queries()
    if llm_queries is not None:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def report_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "skill_metrics": skill_metrics,
        "pickup_rate_by_destination": pickup_rate_by_destination,
        "outbound_stats_by_number": outbound_stats_by_number,
        "outbound_never_answered": outbound_never_answered,
        "outbound_both_periods": outbound_both_periods,
        "inbound_callbacks": inbound_callbacks,
        "never_answered": never_answered,
        "never_answered_clean_first": never_answered_clean_first,
        "never_answered_current": never_answered_current,
        "never_answered_subset": never_answered_subset,
        "normalize_phone": _numbers(fx.normalize_phone),
        "normalize_phone_loose": _numbers(fx.normalize_phone_loose),
        "blank_to_default": blank_to_default,
        "parse_attempt_ts": parse_attempt_ts,
        "week_label": week_label,
        "report_end_date": report_end_date,
        "disposition_rollup": rollup_of_codes,
        "missing_days": missing_days,
        "status_any_of": status_any_of,
        "contract_star_splits": contract_star_splits,
        "member_semi_join": member_semi_join,
        "lead_index_date": lead_index_date,
        "dedup_leads": dedup_leads,
        "right_day_contacts": right_day_contacts,
        "first_disposition": first_disposition,
        "attempt_counts": attempt_counts,
        "disposition_counts_by_date": disposition_counts_by_date,
        "weekly_funnel": weekly_funnel,
        "impute_rates": impute_rates,
        "reports_of_year": reports_of_year,
        "weekly_distinct_totals": weekly_distinct_totals,
        "weekly_result_summary": weekly_result_summary,
        "decline_reason_long": decline_reason_long,
        "submission_result_long": submission_result_long,
        "total_and_shares": total_and_shares,
        "outcome_counts_outer": outcome_counts_outer,
        "area_code_members": area_code_members,
        "decline_reason_pivot": decline_reason_pivot,
        "submission_result_pivot": submission_result_pivot,
        "agent_summary": agent_summary,
        "agent_performance_flags": agent_performance_flags,
        "agent_thresholds": agent_thresholds,
        "agent_report_daily": agent_report_daily,
        "agent_report_weekly": agent_report_weekly,
        "agent_report_monthly": agent_report_monthly,
        "under_min_completions": under_min_completions,
        "flagged_agents": flagged_agents,
        "request_summary": request_summary,
        "request_weekly_summary": request_weekly_summary,
        "clerk_daily_long": clerk_daily_long,
        "clerk_daily": clerk_daily,
        "recent_calls": recent,
        "scrub_dnc": scrub_dnc,
        "scrub_called_yesterday": scrub_called_yesterday,
        "scrub_fatigue": scrub_fatigue,
        "scrub_call_limit": scrub_call_limit,
        "scrub_report": scrub_report,
        "scrub_report_first_day": scrub_report_first_day,
        "scrub_anti_join": scrub_anti_join,
        "scrub_validation": scrub_validation,
        "week_over_week": week_over_week,
        "threshold_alerts": threshold_alerts,
        "completion_summary": completion_summary,
    }


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLES)
    if llm_queries is not None:
        found |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found

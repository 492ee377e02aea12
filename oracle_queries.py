"""The registered queries restated as plain SQL over the same tables.

Written from the definitions of the reports, not from the DataFrame code: joins per
split instead of split arrays, windows instead of folded aggregates, and so on.
"""

from __future__ import annotations

from ringwise import labels
from ringwise.bindings import BINDINGS
from ringwise.functions.dates import ATTEMPT_TIME_PATTERN

OUTBOUND = "('skill-1', 'skill-2', 'skill-3', 'skill-4', 'skill-5')"
INBOUND = "('skill-6', 'skill-7')"
MIN_COMPLETED = 10


def quoted(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def pairs(mapping, key: str, value: str) -> str:
    rows = ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'" for x in kv) + ")" for kv in mapping.items())
    return f"(SELECT * FROM (VALUES {rows}) AS t({key}, {value}))"


def pct(num: str, den: str, digits: int = 1) -> str:
    return f"round_even(CAST({num} AS DOUBLE) / nullif({den}, 0) * 100, {digits})"


def pct0(num: str, den: str) -> str:
    """0 for 0/0, null for x/0."""
    return f"CASE WHEN {den} = 0 AND {num} <> 0 THEN NULL ELSE coalesce({pct(num, den)}, 0) END"


def ctes(*names: str) -> str:
    return ", ".join(f"{name} AS ({BINDINGS[name]})" for name in names)


NOT_DIALED = quoted(labels.not_dialed_labels())
ANSWERED = quoted(labels.ANSWERED)
CONVERTED = quoted(labels.CONVERTED)
REACHED = quoted(labels.REACHED)
RETRYABLE = quoted(labels.RETRYABLE)

CALLS = f"""{ctes('call_log_current', 'call_log_prior')}, calls AS (
    SELECT timestamp AS ts, dialer_disposition AS d, skill_name AS skill, abandoned, destination AS number,
        source AS inbound, 2026 AS log_year FROM call_log_current
    UNION ALL SELECT timestamp, disposition, skill, abandoned, dnis, ani, 2025 FROM call_log_prior)"""
RESOLVED = "NOT (d = 'UNKNOWN' AND abandoned = false)"


def stats(source: str, days: int, extra: str = "", resolved: bool = True, skills: str = OUTBOUND) -> str:
    return f"""SELECT number AS member_phone, count(*) FILTER (WHERE d NOT IN {NOT_DIALED}) AS total_calls,
    count(DISTINCT CASE WHEN d NOT IN {NOT_DIALED} THEN CAST(ts AS DATE) END) AS attempt_days,
    count(*) FILTER (WHERE d IN {ANSWERED}) AS answered_calls
    FROM calls WHERE log_year = {source} AND skill IN {skills} {'AND ' + RESOLVED if resolved else ''}
    GROUP BY number HAVING count(DISTINCT CASE WHEN d NOT IN {NOT_DIALED} THEN CAST(ts AS DATE) END) >= {days} {extra}"""


def rate(answered: str = "answered_calls", total: str = "total_calls") -> str:
    return f"CASE WHEN {total} > 0 THEN {pct(answered, total, 2)} ELSE 0 END"


NEVER = f"AND count(*) FILTER (WHERE d IN {ANSWERED}) = 0"
MANY = f"AND count(*) FILTER (WHERE d NOT IN {NOT_DIALED}) >= 3"
CALLBACKS = f"""SELECT inbound AS member_phone, count(*) AS inbound_calls FROM calls
    WHERE log_year = {{year}} AND skill IN {INBOUND} GROUP BY inbound"""


def both(extra: str) -> str:
    return f"""now AS ({stats('2026', 3, MANY + ' ' + extra, resolved=False)}), before AS ({stats('2025', 0)}),
both_periods AS (SELECT now.member_phone, now.total_calls AS attempts_2026, now.attempt_days AS attempt_days_2026,
    now.answered_calls AS pickups_2026, before.total_calls AS attempts_2025, before.attempt_days AS attempt_days_2025,
    before.answered_calls AS pickups_2025, {rate('now.answered_calls', 'now.total_calls')} AS pickup_rate_2026,
    {rate('before.answered_calls', 'before.total_calls')} AS pickup_rate_2025
    FROM now JOIN before ON now.member_phone = before.member_phone)"""


CLEAN = """CASE WHEN length(local) = 10 THEN local END"""
BARE = "ltrim(trim(phone), '+')"
LOCAL = f"CASE WHEN length({BARE}) > 10 AND starts_with({BARE}, '1') THEN substr({BARE}, 2) ELSE {BARE} END"

CLEAN_CALLS = CALLS.replace("calls AS (", "written AS (") + f""", calls AS (SELECT * REPLACE (
    CASE WHEN length(a) = 10 THEN a END AS number, CASE WHEN length(b) = 10 THEN b END AS inbound) FROM (SELECT *,
    {LOCAL.replace('phone', 'number')} AS a, {LOCAL.replace('phone', 'inbound')} AS b FROM written))"""

ATTEMPT = f"TRY_CAST(nullif(regexp_extract(contact_attempt_date_time, '{ATTEMPT_TIME_PATTERN}'), '') AS TIMESTAMP)"
STATUS = ("call_status_1", "call_status_2", "call_status_3")


def any_status(values: str) -> str:
    return "(" + " OR ".join(f"coalesce({c} IN {values}, false)" for c in STATUS) + ")"


def has_star(star: str) -> str:
    return "(" + " OR ".join(f"coalesce(stars_{i} = '{star}', false)" for i in (1, 2, 3)) + ")"


def split_conditions() -> list[tuple[str, str, str]]:
    out = []
    for group, star in labels.DEFAULT_SPLITS:
        group_sql = (
            f"(contract IS NULL OR contract NOT IN {quoted(labels.LISTED_CONTRACTS)})"
            if group == labels.DEFAULT_GROUP
            else f"contract = '{group}'"
        )
        out.append((f"{group}:{star}", f"{group_sql} AND {has_star(star)}", has_star(star)))
    return [*out, (":".join(labels.EVERYTHING), "true", "true")]


LEADS = f"""{ctes('lead_drop')}, leads AS (SELECT *, card_id || dependent_code AS idcard_mbr_id FROM lead_drop
    WHERE record_kind <> 'F')"""
SPLIT_LEADS = LEADS + ", split_leads AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS split, * FROM leads WHERE {cond}" for name, cond, _ in split_conditions()
) + ")"
ATTEMPTS = f"""{ctes('call_disposition')}, attempts AS (SELECT *, {ATTEMPT} AS attempt_ts FROM call_disposition)"""
INDEX = "index_dates AS (SELECT leadid, max(file_date) AS lead_index_date FROM leads GROUP BY leadid)"
RIGHT_DAY = f"""right_day AS (SELECT a.*, i.lead_index_date FROM attempts a JOIN index_dates i ON a.leadid = i.leadid
    WHERE CAST(a.attempt_ts AS DATE) = i.lead_index_date)"""

FUNNEL = f"""WITH {SPLIT_LEADS}, {ATTEMPTS}, {ctes('scrubbed_lead')},
stars AS (SELECT * FROM (VALUES {", ".join(f"('{n}', '{n.split(':')[1]}')" for n, _, _ in split_conditions())}) t(split, star)),
members AS (SELECT DISTINCT split, idcard_mbr_id FROM split_leads),
index_dates AS (SELECT split, leadid, max(file_date) AS lead_index_date FROM split_leads GROUP BY split, leadid),
received AS (SELECT split, file_date, count(*) AS leads_received FROM split_leads GROUP BY split, file_date),
deduped AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_date, leadid
    ORDER BY idcard_mbr_id NULLS FIRST, stars_1 NULLS FIRST, stars_2 NULLS FIRST) AS rn FROM scrubbed_lead) WHERE rn = 1),
available AS (SELECT m.split, e.file_date, count(*) AS leads_available FROM deduped e
    JOIN members m ON e.idcard_mbr_id IS NOT DISTINCT FROM m.idcard_mbr_id JOIN stars s ON s.split = m.split
    WHERE s.star = 'All' OR coalesce(e.stars_1 = s.star, false) OR coalesce(e.stars_2 = s.star, false)
        OR coalesce(e.stars_3 = s.star, false) GROUP BY m.split, e.file_date),
d AS (SELECT m.split, a.*, coalesce(CAST(a.attempt_ts AS DATE) = i.lead_index_date, false) AS on_day,
    {any_status(RETRYABLE)} AS retry FROM attempts a
    JOIN members m ON a.idcard_mbr_id IS NOT DISTINCT FROM m.idcard_mbr_id
    LEFT JOIN index_dates i ON i.split = m.split AND i.leadid = a.leadid),
outcomes AS (SELECT split, file_date, count(*) FILTER (WHERE {any_status(REACHED)}) AS reached,
    count(*) FILTER (WHERE {any_status("('Refill Submitted')")}) AS submitted,
    count(*) FILTER (WHERE {any_status("('Out of Refill - Refill Request')")}) AS request,
    count(*) FILTER (WHERE {any_status("('Reminded - Refilled on own')")}) AS own FROM d GROUP BY split, file_date),
per_lead AS (SELECT split, file_date, leadid, count(*) AS n, max(CASE WHEN rn = 1 AND retry THEN 1 ELSE 0 END) AS first_retry
    FROM (SELECT *, row_number() OVER (PARTITION BY split, file_date, leadid ORDER BY attempt_ts, retry) AS rn
        FROM d WHERE on_day AND leadid IS NOT NULL) GROUP BY split, file_date, leadid),
attempted AS (SELECT split, file_date, count(*) AS attempted, count(*) FILTER (WHERE n >= 2) AS second,
    sum(first_retry) AS retry_leads FROM per_lead GROUP BY split, file_date),
rows AS (SELECT r.split, r.file_date, r.leads_received, v.leads_available,
    CASE WHEN v.split IS NOT NULL OR t.split IS NOT NULL THEN coalesce(t.attempted, 0) END AS attempted,
    CASE WHEN v.split IS NOT NULL OR t.split IS NOT NULL THEN coalesce(t.second, 0) END AS second,
    CASE WHEN v.split IS NOT NULL OR t.split IS NOT NULL THEN coalesce(t.retry_leads, 0) END AS retry_leads,
    CASE WHEN v.split IS NOT NULL OR t.split IS NOT NULL THEN coalesce(o.reached, 0) END AS reached,
    CASE WHEN v.split IS NOT NULL OR t.split IS NOT NULL THEN coalesce(o.submitted, 0) END AS submitted,
    CASE WHEN v.split IS NOT NULL OR t.split IS NOT NULL THEN coalesce(o.request, 0) END AS request,
    CASE WHEN v.split IS NOT NULL OR t.split IS NOT NULL THEN coalesce(o.own, 0) END AS own
    FROM received r LEFT JOIN available v ON v.split = r.split AND v.file_date = r.file_date
    LEFT JOIN attempted t ON t.split = r.split AND t.file_date = r.file_date
    LEFT JOIN outcomes o ON o.split = r.split AND o.file_date = r.file_date
    WHERE r.split IN (SELECT split FROM available))
SELECT split, file_date, leads_received, leads_available, attempted AS attempted_leads,
    {pct('attempted', 'leads_available')} AS attempt_rate, CAST(retry_leads AS BIGINT) AS available_for_second,
    second AS second_attempts, {pct('second', 'leads_available')} AS second_attempt_rate, reached AS reached_leads,
    CASE WHEN attempted IS NOT NULL THEN {pct0('reached', 'attempted')} END AS reach_rate, submitted, own AS on_own,
    CASE WHEN attempted IS NOT NULL THEN {pct0('(submitted + own)', 'reached')} END AS refill_of_reached_rate,
    CASE WHEN attempted IS NOT NULL THEN {pct0('submitted', 'reached')} END AS submitted_of_reached_rate,
    request AS refill_request, {pct('(leads_received - leads_available)', 'leads_received')} AS scrub_rate,
    {pct0('(submitted + own)', 'attempted')} AS refill_of_attempted_rate,
    {pct0('submitted', 'attempted')} AS submitted_of_attempted_rate FROM rows"""

REASONS = ["Member Does Not Want Refill", "Member Stopped Medication", "Pharmacy Change", "Provider Changed Dose"]
RESULTS = [labels.NO_WORKFLOW, labels.OUT_OF_REFILL, labels.SUBMITTED, labels.ON_OWN]
WEEK = "CAST(date_trunc('week', interaction_ts) AS DATE)"


def week_text(week: str) -> str:
    return f"strftime({week}, '%m/%d/%Y') || ' - ' || strftime({week} + 6, '%m/%d/%Y')"


def wide(rows: str, label: str, values: list[str], total: str) -> str:
    counts = ", ".join(f"count(*) FILTER (WHERE {label} = '{v}') AS \"{v}\"" for v in values)
    shares = ", ".join(f"{pct(chr(34) + v + chr(34), total)} AS \"% {v}\"" for v in values)
    return f"""SELECT *, {shares} FROM (SELECT {WEEK} AS week, {counts}, count(*) AS {total}
    FROM ({rows}) WHERE {label} IS NOT NULL GROUP BY 1)"""


DECLINES = wide("SELECT * FROM case_report WHERE result = 'No'", "reason", REASONS, "total_declined")
DECLINED_ROWS = "SELECT * FROM case_report WHERE result = 'No'"
OUTCOMES = {"submitted": "('Refill Submitted')", "refill_request": "('Out of Refill - Refill Request')", "on_own": "('Reminded - Refilled on own')"}


def long_form(rows: str, label: str, total: str) -> str:
    return f"""SELECT week, label, rows, {total}, {pct('rows', total)} AS share FROM (SELECT *, CAST(sum(rows) OVER (PARTITION BY week) AS BIGINT)
    AS {total} FROM (SELECT {WEEK} AS week, {label} AS label, count(*) AS rows FROM ({rows}) WHERE {label} IS NOT NULL GROUP BY 1, 2))"""


ACCEPTED_ROWS = f"""SELECT * REPLACE (CASE WHEN submission IS NULL OR trim(submission) = '' THEN '{labels.NO_WORKFLOW}'
    ELSE submission END AS submission) FROM case_report WHERE result = 'Yes'"""
SUBMISSIONS = f"""SELECT *, round_even(CAST("{labels.ON_OWN}" + "{labels.NO_WORKFLOW}" AS DOUBLE)
    / nullif("{labels.SUBMITTED}" + "{labels.OUT_OF_REFILL}", 0), 2) AS follow_up_ratio
    FROM ({wide(ACCEPTED_ROWS, 'submission', RESULTS, 'total_accepted')})"""

WEEK_TOTALS = """SELECT CAST(date_trunc('week', day) AS DATE) AS week, CAST(sum(keys) AS BIGINT) AS total
    FROM (SELECT day, count(DISTINCT document_key) AS keys FROM claims GROUP BY day) GROUP BY 1"""
RESULT_SUMMARY = f"""SELECT *, round_even(pct_accepted + pct_declined, 1) AS pct_completed FROM (
    SELECT *, {pct('accepted', 'total')} AS pct_accepted, {pct('declined', 'total')} AS pct_declined,
    {pct('not_completed', 'total')} AS pct_not_completed FROM (
    SELECT c.*, coalesce(t.total, 0) AS total, greatest(coalesce(t.total, 0) - accepted - declined, 0) AS not_completed
    FROM (SELECT {WEEK} AS week, count(*) FILTER (WHERE result = 'Yes') AS accepted,
        count(*) FILTER (WHERE result = 'No') AS declined FROM case_report GROUP BY 1) c
    LEFT JOIN ({WEEK_TOTALS}) t ON c.week = t.week))"""


def agents(where: str = "true") -> str:
    return f"""SELECT agent, total_completed, accepted, {pct('accepted', 'total_completed')} AS pct_accepted, declined,
    {pct('declined', 'total_completed')} AS pct_declined, does_not_want,
    {pct('does_not_want', 'total_completed')} AS pct_does_not_want, on_own,
    {pct('on_own', 'total_completed')} AS pct_on_own_of_total, {pct('on_own', 'accepted')} AS pct_on_own_of_accepted,
    {pct('submitted', 'accepted')} AS pct_submitted_of_accepted FROM (SELECT agent, count(*) AS total_completed,
    count(*) FILTER (WHERE result = 'Yes') AS accepted, count(*) FILTER (WHERE result = 'No') AS declined,
    count(*) FILTER (WHERE result = 'No' AND reason = 'Member Does Not Want Refill') AS does_not_want,
    count(*) FILTER (WHERE result = 'Yes' AND submission = 'Reminded - Refilled on own') AS on_own,
    count(*) FILTER (WHERE result = 'Yes' AND submission = 'Refill Submitted') AS submitted
    FROM case_report WHERE disposition = 'Completed' AND agent IS NOT NULL AND {where} GROUP BY agent)"""


def flags(threshold: float) -> str:
    low = f"coalesce(pct_accepted < {threshold}, false)"
    sub = "coalesce(pct_submitted_of_accepted < avg_submitted, false)"
    return f"""SELECT * EXCLUDE (p75), coalesce(pct_on_own_of_accepted > p75, false) AS above_75th_percentile,
    concat_ws(', ', CASE WHEN NOT {low} AND {sub} THEN 'a' END, CASE WHEN {low} AND {sub} THEN 'b' END,
    CASE WHEN {low} AND coalesce(pct_does_not_want > avg_does_not_want, false) THEN 'c' END) AS performance_flag
    FROM (SELECT * FROM kept), (SELECT quantile_cont(pct_on_own_of_accepted, 0.75) AS p75,
        CAST(sum(CAST(round_even(pct_submitted_of_accepted * 10, 0) AS BIGINT)) AS DOUBLE)
            / count(pct_submitted_of_accepted) / 10 AS avg_submitted,
        CAST(sum(CAST(round_even(pct_does_not_want * 10, 0) AS BIGINT)) AS DOUBLE)
            / count(pct_does_not_want) / 10 AS avg_does_not_want FROM kept)"""


def with_kept(agents_sql: str, minimum: int) -> str:
    return f"WITH {ctes('case_report')}, kept AS (SELECT * FROM ({agents_sql}) WHERE total_completed >= {minimum})"


ON_17_JUNE = "interaction_ts >= DATE '1998-06-17' AND interaction_ts < DATE '1998-06-18'"
WEEK_OF_17_JUNE = "interaction_ts >= DATE '1998-06-15' AND interaction_ts < DATE '1998-06-22'"
IN_JUNE = "interaction_ts >= DATE '1998-06-01' AND interaction_ts < DATE '1998-07-01'"
FLAGGED = ", ".join(
    "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in (flag, *meaning)) + ")"
    for flag, meaning in {
        "a": ("High Accepted Rate + Low Refill Submissions", "Acceptance is good but refill conversion during calls is low. Inform agent to improve refill submission rate during calls."),
        "b": ("Low Accepted Rate + Low Refill Submissions", "Low acceptance and conversion effectiveness. Highlight for performance improvement / training."),
        "c": ("Low Accepted Rate + High 'Member Does Not Want Refill'", "Higher declines observed during calls. Inform agent to improve objection handling & member communication."),
    }.items()
)

REQUESTS = f"""{ctes('request_report')}, requests AS (SELECT CAST(date_trunc('week', completed_ts) AS DATE) AS week,
    trim(coalesce(label, '')) AS label, lower(trim(clerk)) = 'bot@example.com' AS is_bot
    FROM request_report WHERE completed_ts >= DATE '1996-03-01')"""
POPULATIONS = "count(*) AS requests, count(*) FILTER (WHERE is_bot) AS bot, count(*) FILTER (WHERE NOT is_bot) AS human"


def share_text(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({pct(part, whole)} AS VARCHAR) || '%' ELSE '0%' END"


def share_columns(prefix: str) -> str:
    return f"""CASE WHEN label = '' THEN '(Blank)' ELSE label END AS row_label, requests,
    {share_text('requests', prefix + 'requests')} AS share, bot, {share_text('bot', prefix + 'bot')} AS bot_share,
    human, {share_text('human', prefix + 'human')} AS human_share"""


TOTAL_COLUMNS = "'Grand Total' AS row_label, requests, '' AS share, bot, '' AS bot_share, human, '' AS human_share"
CLERK_LABELS = ["Refill Submitted", "Out of Refill - Refill Request", "Left VM", ""]

SCRUB = f"""{ctes('scrub_lead', 'dialer_log', 'dnc_list')}, yesterday AS (SELECT DISTINCT number FROM dialer_log
    WHERE CAST(ts AS DATE) = DATE '2024-01-29'), fatigued AS (SELECT number FROM dialer_log WHERE
    ts >= TIMESTAMP '2024-01-23 00:00:00' AND CAST(ts AS DATE) < DATE '2024-01-30' GROUP BY number
    HAVING count(DISTINCT CAST(ts AS DATE)) >= 4)"""
SCRUB_ROW = "leadid, '{}' AS scrub_reason, card_id || dependent_code AS idcard_mbr_id, '2024-01-30' AS scrub_date"
SCRUB_REPORT = f"""{SCRUB}, hits AS (SELECT *, 1 AS rule FROM scrub_lead WHERE phone IN (SELECT dnc_number FROM dnc_list)
    UNION ALL SELECT *, 2 FROM scrub_lead WHERE phone IN (SELECT number FROM yesterday)
    UNION ALL SELECT *, 3 FROM scrub_lead WHERE phone IN (SELECT number FROM fatigued)),
report AS (SELECT leadid, CASE WHEN rule = 1 THEN 'Do not call' ELSE 'Max attempt reached' END AS scrub_reason,
    card_id || dependent_code AS idcard_mbr_id, '2024-01-30' AS scrub_date FROM (SELECT *, row_number() OVER (
    PARTITION BY leadid ORDER BY rule, phone, card_id NULLS FIRST, dependent_code) AS rn FROM hits) WHERE rn = 1)"""

LABELS = {
    "codes": pairs(labels.DISPOSITION_BY_CODE, "code", "label"),
    "categories": pairs(labels.CATEGORY_BY_LABEL, "label", "category"),
    "reporting": pairs(labels.reporting_by_label(), "label", "reporting_label"),
    "presentation": pairs(labels.PRESENTATION_BY_REPORTING, "reporting_label", "presentation_label"),
}

METRICS = [
    ("% Refill Submitted", "Refill Submitted Rate", ">"),
    ("% Reminded - Refilled on own", "Reminded - Refilled on Own Rate", "<"),
    ("follow_up_ratio", "Refilled on Own + No Post Completion : Refill Submitted + Out of Refill", ">"),
]


def picked(frame: str, monday: str) -> str:
    """The row of one week, or else the last one."""
    return f"(SELECT * FROM {frame} ORDER BY week = DATE '{monday}' DESC, week DESC LIMIT 1)"


WEEK_CHANGES = " UNION ALL ".join(
    f"""SELECT '{label}' AS metric, p.week AS previous_week, c.week AS current_week, p."{column}" AS previous,
    c."{column}" AS current, c."{column}" - p."{column}" AS change,
    coalesce(c."{column}" - p."{column}" {sign} 0, false) AS improved,
    CASE WHEN c."{column}" - p."{column}" > 0 THEN 'increased' ELSE 'decreased' END AS direction
    FROM {picked('subs', '1998-06-08')} p, {picked('subs', '1998-06-15')} c WHERE (SELECT count(*) FROM subs) >= 2"""
    for column, label, sign in METRICS
)

REPORT_END = "(CAST(o_orderdate AS DATE) - CAST(((isodow(o_orderdate) - 1 + 5) % 7 + 1) AS INTEGER))"
REPORT_FILL = "CAST(coalesce(nullif(trim({}), ''), '0') AS DOUBLE)"


def report_count(name: str) -> str:
    return f"CAST({REPORT_FILL.format(name)} AS BIGINT)"


ORACLES = {
    "skill_metrics": f"""WITH {CALLS}, c AS (SELECT count(*) FILTER (WHERE d NOT IN {NOT_DIALED}) AS total_calls,
        count(*) FILTER (WHERE d IN {ANSWERED}) AS answered_calls, count(*) FILTER (WHERE d IN {CONVERTED}) AS converted_calls,
        count(*) FILTER (WHERE d = 'Completed') AS completed, count(*) FILTER (WHERE d = 'Abandon') AS abandoned_calls
        FROM calls WHERE skill IN {OUTBOUND} AND {RESOLVED})
        SELECT 'skill-1,skill-2,skill-3,skill-4,skill-5' AS skill, TIMESTAMP '1995-01-01 00:00:00' AS start_datetime,
        TIMESTAMP '2001-12-31 23:59:59' AS end_datetime, total_calls, answered_calls, converted_calls, abandoned_calls,
        coalesce(CAST(answered_calls AS DOUBLE) / nullif(total_calls, 0) * 100, 0) AS pickup_rate,
        coalesce(CAST(converted_calls AS DOUBLE) / nullif(answered_calls, 0) * 100, 0) AS conversion_rate,
        coalesce(CAST(completed AS DOUBLE) / nullif(total_calls, 0) * 100, 0) AS completion_rate,
        coalesce(CAST(abandoned_calls AS DOUBLE) / nullif(total_calls, 0) * 100, 0) AS abandon_rate FROM c""",
    "pickup_rate_by_destination": f"""WITH {CALLS} SELECT *, {rate()} AS pickup_rate FROM (SELECT number AS destination,
        count(*) FILTER (WHERE d NOT IN {NOT_DIALED}) AS total_calls, count(*) FILTER (WHERE d IN {ANSWERED}) AS answered_calls
        FROM calls WHERE skill IN {OUTBOUND} AND {RESOLVED} GROUP BY number)""",
    "outbound_stats_by_number": f"WITH {CALLS}, s AS ({stats('2026', 3)}) SELECT *, {rate()} AS pickup_rate FROM s",
    "outbound_never_answered": f"WITH {CALLS}, s AS ({stats('2025', 3, NEVER)}) SELECT *, {rate()} AS pickup_rate FROM s",
    "outbound_both_periods": f"WITH {CALLS}, {both('')} SELECT * FROM both_periods",
    "inbound_callbacks": f"""WITH {CALLS}, s AS ({stats('2026', 3)}) SELECT * FROM ({CALLBACKS.format(year=2026)})
        WHERE member_phone IN (SELECT member_phone FROM s)""",
    "never_answered": f"""WITH {CALLS}, {both(NEVER)}, ib26 AS ({CALLBACKS.format(year=2026)}), ib25 AS ({CALLBACKS.format(year=2025)})
        SELECT b.member_phone, attempts_2026, attempt_days_2026, pickups_2026, pickup_rate_2026, attempts_2025,
        attempt_days_2025, pickups_2025, pickup_rate_2025, attempts_2026 + attempts_2025 AS total_attempts_combined,
        coalesce(ib26.inbound_calls, 0) AS inbound_callbacks_2026, coalesce(ib25.inbound_calls, 0) AS inbound_callbacks_2025,
        coalesce(ib26.inbound_calls, 0) + coalesce(ib25.inbound_calls, 0) > 0 AS ever_called_back FROM both_periods b
        LEFT JOIN ib26 ON b.member_phone = ib26.member_phone LEFT JOIN ib25 ON b.member_phone = ib25.member_phone""",
    "never_answered_clean_first": f"""WITH {CLEAN_CALLS}, {both(NEVER)}, ib26 AS ({CALLBACKS.format(year=2026)}), ib25 AS ({CALLBACKS.format(year=2025)})
        SELECT b.member_phone, attempts_2026, attempt_days_2026, pickups_2026, pickup_rate_2026, attempts_2025,
        attempt_days_2025, pickups_2025, pickup_rate_2025, attempts_2026 + attempts_2025 AS total_attempts_combined,
        coalesce(ib26.inbound_calls, 0) AS inbound_callbacks_2026, coalesce(ib25.inbound_calls, 0) AS inbound_callbacks_2025,
        coalesce(ib26.inbound_calls, 0) + coalesce(ib25.inbound_calls, 0) > 0 AS ever_called_back FROM both_periods b
        LEFT JOIN ib26 ON b.member_phone = ib26.member_phone LEFT JOIN ib25 ON b.member_phone = ib25.member_phone""",
    "never_answered_current": f"""WITH {CALLS}, s AS ({stats('2026', 3)}), ib26 AS ({CALLBACKS.format(year=2026)})
        SELECT s.member_phone, total_calls AS attempts_2026, attempt_days AS attempt_days_2026,
        answered_calls AS pickups_2026, {rate()} AS pickup_rate_2026,
        coalesce(inbound_calls, 0) AS inbound_callbacks_2026, coalesce(inbound_calls, 0) > 0 AS ever_called_back
        FROM s LEFT JOIN ib26 ON s.member_phone = ib26.member_phone""",
    "never_answered_subset": f"""WITH {CALLS}, s AS ({stats('2026', 3, NEVER)}) SELECT number AS destination,
        count(*) FILTER (WHERE d NOT IN {NOT_DIALED}) AS total_calls, count(*) FILTER (WHERE d IN {ANSWERED}) AS answered_calls
        FROM calls WHERE log_year = 2025 AND number IN (SELECT member_phone FROM s) GROUP BY number
        HAVING count(*) FILTER (WHERE d IN {ANSWERED}) = 0""",
    "normalize_phone": f"""WITH {ctes('raw_numbers')} SELECT l_orderkey, l_linenumber, phone, {CLEAN} AS clean FROM
        (SELECT *, {LOCAL} AS local FROM raw_numbers)""",
    "normalize_phone_loose": f"""WITH {ctes('raw_numbers')} SELECT l_orderkey, l_linenumber, phone,
        ltrim(phone, '+1') AS clean FROM raw_numbers""",
    "blank_to_default": f"""WITH {ctes('case_report')} SELECT CASE WHEN submission IS NULL OR trim(submission) = ''
        THEN '{labels.NO_WORKFLOW}' ELSE submission END AS submission, count(*) AS cases FROM case_report GROUP BY 1""",
    "parse_attempt_ts": f"""WITH {ctes('call_disposition')} SELECT leadid, contact_attempt_date_time,
        {ATTEMPT} AS attempt_ts FROM call_disposition""",
    "week_label": f"""WITH {ctes('case_report')} SELECT {WEEK} AS week, {week_text(WEEK)} AS label, count(*) AS cases
        FROM case_report GROUP BY 1, 2""",
    "report_end_date": f"""SELECT o_orderkey, o_orderdate, {REPORT_END} AS report_end_day,
        CAST({REPORT_END} AS TIMESTAMP) + INTERVAL '23:59:59' HOUR TO SECOND AS report_end FROM orders""".replace(
        "INTERVAL '23:59:59' HOUR TO SECOND", "INTERVAL 86399 SECOND"
    ),
    "disposition_rollup": f"""SELECT l.code, c.label, g.category, r.reporting_label, p.presentation_label, count(*) AS calls
        FROM (SELECT CAST(l_quantity AS INTEGER) AS code FROM lineitem) l LEFT JOIN {LABELS['codes']} c ON l.code = c.code
        LEFT JOIN {LABELS['categories']} g ON c.label = g.label LEFT JOIN {LABELS['reporting']} r ON c.label = r.label
        LEFT JOIN {LABELS['presentation']} p ON r.reporting_label = p.reporting_label GROUP BY ALL""",
    "missing_days": """SELECT CAST(d AS DATE) AS file_date FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)
        AS t(d) WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
    "status_any_of": f"""WITH {ctes('call_disposition')} SELECT call_status_1, call_status_2, call_status_3,
        {any_status(REACHED)} AS reached, {any_status(RETRYABLE)} AS retryable, count(*) AS rows
        FROM call_disposition GROUP BY ALL""",
    "contract_star_splits": f"""WITH {SPLIT_LEADS} SELECT split, leadid, idcard_mbr_id, contract, stars_1, stars_2, file_date
        FROM split_leads""",
    "member_semi_join": f"""WITH {LEADS}, {ctes('call_disposition')} SELECT leadid, idcard_mbr_id, file_date, call_status_1
        FROM call_disposition d WHERE EXISTS (SELECT 1 FROM leads l WHERE {has_star('Stars')}
        AND contract = 'S5884' AND l.idcard_mbr_id IS NOT DISTINCT FROM d.idcard_mbr_id)""",
    "lead_index_date": f"WITH {LEADS}, {INDEX} SELECT * FROM index_dates",
    "dedup_leads": f"""WITH {ctes('scrubbed_lead')} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY file_date, leadid ORDER BY idcard_mbr_id NULLS FIRST, stars_1 NULLS FIRST, stars_2 NULLS FIRST) AS rn
        FROM scrubbed_lead) WHERE rn = 1""",
    "right_day_contacts": f"""WITH {LEADS}, {ATTEMPTS}, {INDEX}, {RIGHT_DAY} SELECT leadid, idcard_mbr_id, file_date,
        attempt_ts, lead_index_date FROM right_day""",
    "first_disposition": f"""WITH {ATTEMPTS} SELECT leadid, file_date, attempt_ts, call_status_1, call_status_2, call_status_3
        FROM (SELECT *, row_number() OVER (PARTITION BY leadid, file_date ORDER BY attempt_ts, {any_status(RETRYABLE)}, call_status_1,
        call_status_2 NULLS FIRST, call_status_3 NULLS FIRST) AS rn FROM attempts
        WHERE attempt_ts IS NOT NULL AND leadid IS NOT NULL) WHERE rn = 1""",
    "attempt_counts": f"""WITH {ATTEMPTS} SELECT file_date, count(*) AS attempted_leads,
        count(*) FILTER (WHERE n >= 2) AS second_attempts FROM (SELECT file_date, leadid, count(*) AS n FROM attempts
        WHERE leadid IS NOT NULL GROUP BY file_date, leadid) GROUP BY file_date""",
    "disposition_counts_by_date": f"""WITH {ctes('call_disposition')} SELECT file_date,
        count(*) FILTER (WHERE {any_status(REACHED)}) AS reached, count(*) FILTER (WHERE {any_status("('Refill Submitted')")}) AS submitted,
        count(*) FILTER (WHERE {any_status("('Out of Refill - Refill Request')")}) AS refill_request,
        count(*) FILTER (WHERE {any_status("('Reminded - Refilled on own')")}) AS on_own FROM call_disposition GROUP BY file_date""",
    "weekly_funnel": FUNNEL,
    "impute_rates": f"""WITH {ctes('past_report')}, t AS (SELECT file_date, CAST(leads_received AS BIGINT) AS leads_received,
        {report_count('leads_available')} AS leads_available, {report_count('submitted')} AS submitted,
        {report_count('on_own')} AS on_own, {report_count('attempted_leads')} AS attempted_leads,
        {report_count('reached_leads')} AS reached_leads, CAST(scrub_rate AS DOUBLE) AS s,
        CAST(refill_of_attempted_rate AS DOUBLE) AS r, CAST(submitted_of_attempted_rate AS DOUBLE) AS u FROM past_report)
        SELECT * EXCLUDE (s, r, u), coalesce(s, {pct('(leads_received - leads_available)', 'leads_received')}) AS scrub_rate,
        coalesce(r, {pct('(submitted + on_own)', 'attempted_leads')}) AS refill_of_attempted_rate,
        coalesce(u, {pct('submitted', 'attempted_leads')}) AS submitted_of_attempted_rate FROM t""",
    "reports_of_year": f"""WITH {ctes('past_report')} SELECT file_date, leads_received, leads_available FROM past_report
        WHERE year(file_date) = 1998""",
    "weekly_distinct_totals": f"WITH {ctes('claims')} {WEEK_TOTALS}",
    "weekly_result_summary": f"WITH {ctes('case_report', 'claims')} {RESULT_SUMMARY}",
    "decline_reason_long": f"WITH {ctes('case_report')} {long_form(DECLINED_ROWS, 'reason', 'total_declined')}",
    "submission_result_long": f"WITH {ctes('case_report')} {long_form(ACCEPTED_ROWS, 'submission', 'total_accepted')}",
    "total_and_shares": f"""WITH {ctes('case_report')}, w AS ({wide(DECLINED_ROWS, 'reason', REASONS, 'n')})
        SELECT week, {", ".join(f'"{r}"' for r in REASONS)}, CAST({" + ".join(f'"{r}"' for r in REASONS)} AS DOUBLE) AS total,
        {", ".join(pct(f'"{r}"', "(" + " + ".join(f'"{x}"' for x in REASONS) + ")") + f' AS "% {r}"' for r in REASONS)} FROM w""",
    "outcome_counts_outer": f"""WITH {ctes('call_disposition')} SELECT file_date,
        {", ".join(f"count(*) FILTER (WHERE {any_status(v)}) AS {n}" for n, v in OUTCOMES.items())} FROM call_disposition
        GROUP BY file_date HAVING {" OR ".join(f"count(*) FILTER (WHERE {any_status(v)}) > 0" for v in OUTCOMES.values())}""",
    "area_code_members": f"""WITH {ctes('raw_numbers')} SELECT l_orderkey, l_linenumber, phone FROM raw_numbers
        WHERE substr(phone, 1, 3) IN (SELECT substr(phone, 1, 3) FROM raw_numbers WHERE l_linenumber IN (2, 5))""",
    "decline_reason_pivot": f"WITH {ctes('case_report')} {DECLINES}",
    "submission_result_pivot": f"WITH {ctes('case_report')} {SUBMISSIONS}",
    "agent_summary": f"WITH {ctes('case_report')} {agents()}",
    "agent_performance_flags": f"{with_kept(agents(), MIN_COMPLETED)} {flags(33.0)}",
    "agent_thresholds": f"""{with_kept(agents(), MIN_COMPLETED)} SELECT DISTINCT {MIN_COMPLETED} AS min_completed, CAST(33.0 AS DOUBLE) AS accepted_rate,
        avg_submitted, avg_does_not_want FROM ({flags(33.0)})""",
    "agent_report_daily": f"{with_kept(agents(ON_17_JUNE), 1)} {flags(33.0)}",
    "agent_report_weekly": f"{with_kept(agents(WEEK_OF_17_JUNE), 1)} {flags(33.0)}",
    "agent_report_monthly": f"{with_kept(agents(IN_JUNE), 2)} {flags(33.0)}",
    "under_min_completions": f"""WITH {ctes('case_report')} SELECT *, '06/15/1998 - 06/21/1998' AS week FROM
        ({agents("interaction_ts >= DATE '1998-06-15' AND interaction_ts < DATE '1998-06-22'")}) WHERE total_completed < 100""",
    "flagged_agents": f"""{with_kept(agents(), MIN_COMPLETED)} SELECT f.*, agent, total_completed, pct_accepted,
        pct_submitted_of_accepted, pct_on_own_of_accepted, pct_does_not_want, CAST(33.0 AS DOUBLE) AS accepted_rate,
        avg_submitted, avg_does_not_want FROM ({flags(33.0)}) r
        JOIN (VALUES {FLAGGED}) f(flag, title, recommendation) ON contains(r.performance_flag, f.flag)""",
    "request_summary": f"""WITH {REQUESTS}, t AS (SELECT {POPULATIONS} FROM requests), l AS (SELECT label, {POPULATIONS}
        FROM requests GROUP BY label) SELECT {share_columns('all_')} FROM l,
        (SELECT requests AS all_requests, bot AS all_bot, human AS all_human FROM t)
        UNION ALL SELECT {TOTAL_COLUMNS} FROM t""",
    "request_weekly_summary": f"""WITH {REQUESTS}, t AS (SELECT week, requests AS all_requests, bot AS all_bot, human AS all_human
        FROM (SELECT week, {POPULATIONS} FROM requests GROUP BY week)), l AS (SELECT DISTINCT label FROM requests),
        c AS (SELECT week AS w, label AS lab, {POPULATIONS} FROM requests GROUP BY 1, 2),
        g AS (SELECT t.*, l.label, coalesce(c.requests, 0) AS requests, coalesce(c.bot, 0) AS bot, coalesce(c.human, 0) AS human
            FROM t CROSS JOIN l LEFT JOIN c ON c.w = t.week AND c.lab = l.label)
        SELECT week, {share_columns('all_')} FROM g UNION ALL SELECT week, {TOTAL_COLUMNS} FROM
        (SELECT week, all_requests AS requests, all_bot AS bot, all_human AS human FROM t)""",
    "clerk_daily_long": f"""WITH {ctes('request_report')}, c AS (SELECT clerk, trim(coalesce(label, '')) AS label, count(*) AS rows
        FROM request_report WHERE CAST(completed_ts AS DATE) = DATE '1998-06-15' AND lower(trim(clerk)) <> 'bot@example.com' GROUP BY 1, 2)
        SELECT clerk, CASE WHEN label = '' THEN '(Blank)' ELSE label END AS label, rows, total_completed, combined_refills,
        {pct('rows', 'total_completed')} AS share FROM (SELECT *, CAST(sum(rows) OVER w AS BIGINT) AS total_completed,
        CAST(coalesce(sum(rows) FILTER (WHERE label IN ('Refill Submitted', 'Out of Refill - Refill Request')) OVER w, 0) AS BIGINT)
        AS combined_refills FROM c WINDOW w AS (PARTITION BY clerk))""",
    "clerk_daily": f"""WITH {ctes('request_report')}, r AS (SELECT clerk, trim(coalesce(label, '')) AS label FROM request_report
        WHERE CAST(completed_ts AS DATE) = DATE '1998-06-15' AND lower(trim(clerk)) <> 'bot@example.com')
        SELECT *, {", ".join(f'{pct(chr(34) + (v or "(Blank)") + chr(34), "total_completed")} AS "% {v or "(Blank)"}"' for v in CLERK_LABELS)}
        FROM (SELECT clerk, count(*) AS total_completed,
        {", ".join(f"count(*) FILTER (WHERE label = '{v}') AS {chr(34)}{v or '(Blank)'}{chr(34)}" for v in CLERK_LABELS)},
        count(*) FILTER (WHERE label IN ('Refill Submitted', 'Out of Refill - Refill Request')) AS combined_refills
        FROM r GROUP BY clerk)""",
    "recent_calls": f"""WITH {ctes('dialer_log')} SELECT ltrim(number, '+1') AS number, ts FROM dialer_log
        WHERE skill IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-23 00:00:00'""",
    "scrub_dnc": f"WITH {SCRUB} SELECT * FROM scrub_lead WHERE phone IN (SELECT dnc_number FROM dnc_list)",
    "scrub_called_yesterday": f"""WITH {SCRUB} SELECT {SCRUB_ROW.format('Max attempt reached')} FROM scrub_lead
        WHERE phone IN (SELECT number FROM yesterday)""",
    "scrub_fatigue": f"""WITH {SCRUB} SELECT {SCRUB_ROW.format('Max attempt reached')} FROM scrub_lead
        WHERE phone IN (SELECT number FROM fatigued)""",
    "scrub_call_limit": f"""WITH {SCRUB} SELECT * FROM scrub_lead WHERE phone IN (SELECT number FROM dialer_log
        GROUP BY number HAVING count(DISTINCT CAST(ts AS DATE)) >= 2)""",
    "scrub_report": f"WITH {SCRUB_REPORT} SELECT * FROM report",
    "scrub_report_first_day": f"""WITH {SCRUB} SELECT {SCRUB_ROW.format('Do not call')} FROM (SELECT *, row_number() OVER (
        PARTITION BY leadid ORDER BY phone, card_id NULLS FIRST, dependent_code) AS rn FROM scrub_lead
        WHERE phone IN (SELECT dnc_number FROM dnc_list)) WHERE rn = 1""",
    "scrub_anti_join": f"""WITH {SCRUB_REPORT} SELECT s.*, card_id || dependent_code AS idcard_mbr_id FROM scrub_lead s
        WHERE NOT EXISTS (SELECT 1 FROM report r WHERE r.idcard_mbr_id IS NOT DISTINCT FROM s.card_id || s.dependent_code)""",
    "scrub_validation": f"""WITH {SCRUB} SELECT CASE WHEN dependent_code = '1' THEN NULL ELSE skill END AS scrub_reason,
        count(*) AS rows FROM (SELECT dependent_code, CASE dependent_code WHEN '2' THEN 'Do not call'
        WHEN '3' THEN 'Missing data' ELSE 'Moved' END AS skill FROM scrub_lead) WHERE dependent_code NOT IN ('2', '3') GROUP BY 1""",
    "week_over_week": f"WITH {ctes('case_report')}, subs AS ({SUBMISSIONS}) {WEEK_CHANGES}",
    "threshold_alerts": f"""WITH {ctes('case_report')}, subs AS ({SUBMISSIONS}), decl AS ({DECLINES})
        SELECT '{labels.NO_WORKFLOW}' AS alert, week, CAST("{labels.NO_WORKFLOW}" AS DOUBLE) AS value, CAST(2 AS DOUBLE) AS threshold
        FROM {picked('subs', '1998-06-15')} WHERE "{labels.NO_WORKFLOW}" > 2 AND (SELECT count(*) FROM subs) >= 2
        UNION ALL SELECT '% Member Does Not Want Refill', week, "% Member Does Not Want Refill", CAST(5 AS DOUBLE)
        FROM {picked('decl', '1998-06-15')} WHERE "% Member Does Not Want Refill" > 5 AND (SELECT count(*) FROM subs) >= 2""",
    "completion_summary": f"""WITH {ctes('case_report', 'claims')}, s AS ({RESULT_SUMMARY}), subs AS ({SUBMISSIONS}) SELECT week, total, pct_completed,
        pct_not_completed FROM {picked('s', '1998-06-15')} WHERE (SELECT count(*) FROM subs) >= 2""",
}

"""The domain tables as views over a star-schema test set.

Each binding is one SELECT that Spark and other SQL engines read alike. They only rename
and relabel columns; which rows count is left to the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "events", "lineitem", "orders")

_DIAL_LABEL = """CASE concat(l_returnflag, l_linestatus)
    WHEN 'RF' THEN 'Completed' WHEN 'RO' THEN 'Declined'
    WHEN 'NF' THEN 'No Answer' WHEN 'NO' THEN 'UNKNOWN'
    WHEN 'AF' THEN 'Abandon' ELSE 'Manual Suppression' END"""

_PART_NUMBER = "CAST(CAST(1000000000 AS BIGINT) + l_partkey AS STRING)"

_STARS = """CASE l_returnflag WHEN 'A' THEN 'Stars' WHEN 'N' THEN 'Nonstars' ELSE 'Both' END AS stars_1,
    CASE l_linestatus WHEN 'F' THEN 'Stars' END AS stars_2,
    CAST(NULL AS STRING) AS stars_3"""

_MEMBER = "concat('M', CAST(l_partkey AS STRING))"
_FILE_DATE = "CAST(date_trunc('month', l_shipdate) AS DATE)"

BINDINGS = {
    # Call log in its two table layouts: one row per line item, parts are the numbers.
    "call_log_current": f"""SELECT l_shipdate AS timestamp, {_DIAL_LABEL} AS dialer_disposition,
    concat('skill-', CAST(l_linenumber AS STRING)) AS skill_name, l_discount < 0.05 AS abandoned,
    {_PART_NUMBER} AS destination, {_PART_NUMBER} AS source
    FROM lineitem WHERE l_shipdate >= DATE '1998-06-01'""",
    "call_log_prior": f"""SELECT l_shipdate AS timestamp, {_DIAL_LABEL} AS disposition,
    concat('skill-', CAST(l_linenumber AS STRING)) AS skill, l_discount < 0.05 AS abandoned,
    {_PART_NUMBER} AS destination, {_PART_NUMBER} AS dnis, {_PART_NUMBER} AS ani
    FROM lineitem WHERE l_shipdate < DATE '1998-06-01'""",
    # Numbers as people type them.
    "raw_numbers": f"""SELECT l_orderkey, l_linenumber, CASE l_linenumber
    WHEN 1 THEN concat('+1', {_PART_NUMBER}) WHEN 2 THEN concat('1', {_PART_NUMBER})
    WHEN 3 THEN concat(' ', {_PART_NUMBER}, ' ') WHEN 4 THEN concat('+', {_PART_NUMBER})
    WHEN 5 THEN CAST(l_partkey AS STRING) WHEN 6 THEN NULL ELSE {_PART_NUMBER} END AS phone
    FROM lineitem""",
    # Lead drops, scrubbed leads and call dispositions: line items by month of shipping.
    "lead_drop": f"""SELECT CASE WHEN l_quantity >= 50 THEN 'F' ELSE 'D' END AS record_kind,
    CAST(l_orderkey AS STRING) AS leadid, {_MEMBER} AS card_id,
    CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber AS STRING) END AS dependent_code,
    CASE l_linenumber WHEN 1 THEN 'S5884' WHEN 2 THEN 'S5552' WHEN 3 THEN NULL ELSE 'H0001' END AS contract,
    {_STARS}, {_FILE_DATE} AS file_date FROM lineitem""",
    "scrubbed_lead": f"""SELECT CAST(l_orderkey AS STRING) AS leadid,
    concat({_MEMBER}, CASE WHEN l_linenumber < 7 THEN CAST(l_linenumber AS STRING) ELSE '' END) AS idcard_mbr_id,
    {_STARS}, {_FILE_DATE} AS file_date FROM lineitem""",
    "call_disposition": f"""SELECT CASE WHEN l_quantity >= 3 THEN CAST(l_orderkey AS STRING) END AS leadid,
    CASE WHEN l_linenumber < 7 THEN concat({_MEMBER}, CAST(l_linenumber AS STRING)) END AS idcard_mbr_id,
    concat(CAST(CASE WHEN l_tax < 0.06 THEN {_FILE_DATE} ELSE CAST(l_shipdate AS DATE) END AS STRING),
        CASE WHEN l_tax = 0.03 THEN ' 10:00:00'
        ELSE concat(' 1', CAST(l_linenumber AS STRING), ':30:00.125500-05:00') END) AS contact_attempt_date_time,
    CASE l_returnflag WHEN 'A' THEN 'No Answer' WHEN 'N' THEN 'Refill Submitted' ELSE 'Left VM' END AS call_status_1,
    CASE l_linestatus WHEN 'F' THEN 'Reminded - Refilled on own' END AS call_status_2,
    CASE WHEN l_discount > 0.07 THEN 'Out of Refill - Refill Request'
        WHEN l_discount < 0.02 THEN 'Declined' END AS call_status_3,
    {_FILE_DATE} AS file_date FROM lineitem""",
    # Scrubbing: orders are leads, events the call log, customers the do-not-call list.
    "scrub_lead": """SELECT concat('L', CAST(o_custkey AS STRING), o_orderstatus) AS leadid,
    concat('555-', CAST(o_custkey AS STRING), '-', substr(o_orderpriority, 1, 1)) AS phone,
    CASE WHEN o_totalprice < 480000 THEN concat('M', CAST(o_custkey AS STRING)) END AS card_id,
    substr(o_orderpriority, 1, 1) AS dependent_code, CAST(o_orderdate AS DATE) AS file_date FROM orders""",
    "dialer_log": """SELECT concat('555-', CAST(user_id AS STRING), '-', CASE event_type WHEN 'click' THEN '1'
    WHEN 'error' THEN '2' WHEN 'purchase' THEN '3' WHEN 'signup' THEN '4' ELSE '5' END) AS number,
    ts, event_type AS skill FROM events""",
    "dnc_list": """SELECT concat('555-', CAST(c_custkey AS STRING), '-', CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '1'
    WHEN 'BUILDING' THEN '2' WHEN 'FURNITURE' THEN '3' WHEN 'HOUSEHOLD' THEN '4' ELSE '5' END) AS dnc_number
    FROM customer""",
    # Case and request reports: one row per order, customers are the agents.
    "case_report": """SELECT o_orderdate AS interaction_ts,
    CASE WHEN o_totalprice < 450000 THEN 'Completed' ELSE 'Open' END AS disposition,
    CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' ELSE '' END AS result,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Member Does Not Want Refill' WHEN '2' THEN 'Pharmacy Change'
        WHEN '3' THEN 'Provider Changed Dose' WHEN '4' THEN 'Member Stopped Medication' END AS reason,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Refill Submitted' WHEN '2' THEN 'Reminded - Refilled on own'
        WHEN '3' THEN 'Out of Refill - Refill Request' WHEN '4' THEN ' ' END AS submission,
    CASE WHEN o_totalprice >= 5000 THEN concat('agent', CAST(o_custkey AS STRING), '@example.com') END AS agent
    FROM orders""",
    "request_report": """SELECT o_orderdate AS completed_ts,
    CASE WHEN o_totalprice < 100000 THEN ' Bot@Example.com' WHEN o_totalprice < 480000
        THEN concat('clerk', CAST(o_custkey AS STRING), '@example.com') END AS clerk,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Refill Submitted' WHEN '2' THEN 'Out of Refill - Refill Request'
        WHEN '3' THEN ' Left VM ' WHEN '4' THEN '' END AS label
    FROM orders""",
    "claims": "SELECT CAST(l_shipdate AS DATE) AS day, l_orderkey AS document_key FROM lineitem",
    # Past funnel rows as text, some rates missing.
    "past_report": f"""SELECT {_FILE_DATE} AS file_date, CAST(count(*) AS STRING) AS leads_received,
    concat(CAST(sum(CASE WHEN l_discount < 0.08 THEN 1 ELSE 0 END) AS STRING), '.0') AS leads_available,
    CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS STRING) AS submitted,
    CASE WHEN month(min(l_shipdate)) < 3 THEN '' ELSE
        CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS STRING) END AS on_own,
    CAST(sum(CASE WHEN l_tax < 0.06 THEN 1 ELSE 0 END) AS STRING) AS attempted_leads,
    CAST(NULL AS STRING) AS reached_leads,
    CASE WHEN month(min(l_shipdate)) < 7 THEN '12.5' END AS scrub_rate,
    CASE WHEN month(min(l_shipdate)) > 9 THEN '40.0' END AS refill_of_attempted_rate,
    CAST(NULL AS STRING) AS submitted_of_attempted_rate
    FROM lineitem GROUP BY {_FILE_DATE}""",
}


def bind(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One domain table over the parquet files in ``sf_dir``."""
    tables = {table: spark.read.parquet(f"{sf_dir}/{table}.parquet") for table in TABLES if table in BINDINGS[name]}
    query = BINDINGS[name]
    for table in tables:
        query = query.replace(f"FROM {table}", f"FROM {{{table}}}")
    return spark.sql(query, **tables)

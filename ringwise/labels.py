"""Label lists and lookup tables, and the small dimension frames made from them.

Everything under a FIXED VALUES comment has to equal what the data carries.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: system disposition code -> label.
DISPOSITION_BY_CODE = {
    1: "Positive w/Amount",
    2: "Positive no Amount",
    3: "Negative — DNC — Skill",
    4: "Negative — DNC — BU",
    5: "Negative",
    6: "Other",
    7: "Retry — Rescheduled Agent Specific",
    8: "Retry — Rescheduled Specified Date/Time — Any Agent",
    9: "Retry — Rescheduled Later Date/Time Unspecified",
    10: "Retry — Not Available",
    11: "Retry — Answering Machine",
    12: "Final — Answering Machine",
    13: "Fax Machine",
    14: "Answering Machine Left Message",
    15: "Busy",
    16: "Error",
    17: "Fax",
    18: "Invalid Number",
    19: "Answering Machine",
    20: "No Answer",
    21: "Number Changed",
    22: "Disconnect",
    23: "Network Busy",
    24: "Abandon",
    25: "Agent Abandon",
    26: "Manual Suppression",
    27: "Webservice Suppression",
    28: "IVR Suppression",
    29: "Script Action Suppression",
    30: "Bulk Upload Suppression",
    31: "None",
    32: "Called Party Hang Up",
    33: "Force Agent Disconnect",
    34: "Call Takeover",
    35: "Disposition Timeout",
    36: "No Disposition",
    37: "Forced Remove Call",
    38: "System Failure",
    39: "No Ports",
    40: "Bad Number",
    41: "Retry - Preview Requeue",
    42: "Third Party — Cell Phone",
    43: "Third Party — DNC",
    44: "Third Party — Time Zone Restricted",
    45: "Third Party — Legislative Restricted",
    46: "Script Action 1",
    47: "Script Action 2",
    48: "No Scripting Disposition",
    49: "Agent Specific — Queue Is Full Final",
    50: "Agent Specific — Queue Is Full",
    51: "Callback Undeliverable",
    52: "Agent Specific — Agent Unavailable Final",
    53: "Agent Specific — Agent Unavailable",
    54: "Agent Specific — Agentless Skill Final",
    55: "ISDN Cause Code 18",
    56: "ISDN Cause Code 21",
    57: "ISDN Cause Code 102",
    58: "SysUnclassified",
    60: "DialerBlendingRetry",
    61: "Reactivation",
    62: "SMS Final - Destination",
    63: "SMS Transport Failure Retry",
    64: "SMS Failure",
    65: "SMS Failure Message too Long",
    66: "SMS Failure Invalid Transport Code",
    67: "Email Final",
    68: "Email Failure",
    69: "Email Retry",
    70: "SMS Final - Record",
    71: "SMS Retry",
    72: "Retry - Snooze",
    73: "Retry Preview Rescheduled Agent Specific",
    74: "Retry Preview Rescheduled Any Agent",
    75: "Preview Reject - Positive",
    76: "Preview Reject - Positive w/Amount",
    77: "Preview Reject - Negative",
    78: "Preview Reject - Negative DNC BU",
    79: "Preview Reject - Negative DNC Skill",
    80: "Preview Reject - Negative Other",
    81: "Proactive Identified - Fax",
    82: "Proactive Identified - Answering Machine",
    83: "Proactive Identified - Bad Number",
    84: "Proactive Identified - Answering Machine Left Message Long",
    85: "Agent Session Timed Out",
    86: "Agent Override Answering Machine - No Message",
    87: "Agent Override Answering Machine - System Left Message",
    90: "Call Blocked by Carrier Analytics",
    91: "Call Refused By Customer",
    92: "Live Person Left Message",
    93: "Live Person Left Message Attempts Max",
    94: "Live Person Left Message Partial",
    95: "Answering Machine Left Message Partial",
    96: "Answering Machine Left Message Attempts Max",
    97: "Agent Override Fax Machine",
    98: "Invalid Caller ID",
}

# FIXED VALUES: disposition category of each label.
CATEGORY_BY_LABEL = {
    "Agent Override Answering Machine - No Message": "Voicemail / Answering Machine",
    "Agent Override Answering Machine - System Left Message": "Voicemail / Answering Machine",
    "Answering Machine": "Voicemail / Answering Machine",
    "Answering Machine Left Message": "Voicemail / Answering Machine",
    "Answering Machine Left Message Attempts Max": "Voicemail / Answering Machine",
    "Answering Machine Left Message Partial": "Voicemail / Answering Machine",
    "Live Person Left Message": "Voicemail / Answering Machine",
    "Live Person Left Message Attempts Max": "Voicemail / Answering Machine",
    "Live Person Left Message Partial": "Voicemail / Answering Machine",
    "Retry — Answering Machine": "Voicemail / Answering Machine",
    "Final — Answering Machine": "Voicemail / Answering Machine",
    "Proactive Identified - Answering Machine": "Voicemail / Answering Machine",
    "Proactive Identified - Answering Machine Left Message Long": "Voicemail / Answering Machine",
    "Called Party Hang Up": "Interrupted Call",
    "Force Agent Disconnect": "Interrupted Call",
    "Fax Machine": "Fax Machine",
    "Fax": "Fax Machine",
    "Proactive Identified - Fax": "Fax Machine",
    "Agent Override Fax Machine": "Fax Machine",
    "Error": "Error / Failure",
    "Number Changed": "Error / Failure",
    "Disconnect": "Error / Failure",
    "Network Busy": "Error / Failure",
    "Call Takeover": "Error / Failure",
    "Disposition Timeout": "Error / Failure",
    "No Disposition": "Error / Failure",
    "Forced Remove Call": "Error / Failure",
    "System Failure": "Error / Failure",
    "No Ports": "Error / Failure",
    "Bad Number": "Error / Failure",
    "ISDN Cause Code 18": "Error / Failure",
    "ISDN Cause Code 21": "Error / Failure",
    "ISDN Cause Code 102": "Error / Failure",
    "SysUnclassified": "Error / Failure",
    "SMS Failure": "Error / Failure",
    "SMS Failure Message too Long": "Error / Failure",
    "SMS Failure Invalid Transport Code": "Error / Failure",
    "Email Failure": "Error / Failure",
    "SMS Final - Record": "Error / Failure",
    "Agent Session Timed Out": "Error / Failure",
    "Invalid Caller ID": "Error / Failure",
    "Proactive Identified - Bad Number": "Error / Failure",
    "Manual Suppression": "Suppressed",
    "Webservice Suppression": "Suppressed",
    "IVR Suppression": "Suppressed",
    "Script Action Suppression": "Suppressed",
    "Bulk Upload Suppression": "Suppressed",
    "Script Action 1": "Suppressed",
    "Script Action 2": "Suppressed",
}

# FIXED VALUES: labels that mean a person was on the line.
ANSWERED = [
    "Audio/Connectivity Issues",
    "Call Back (Outbound)",
    "Completed",
    "Deceased",
    "Declined",
    "Do Not Call",
    "Ineligible-Hospice",
    "Ineligible-LTC",
    "Member Authenticated",
    "Opted Out",
    "Other-Unable to Complete",
    "Pharmacy Call-Complete",
    "Previously Completed",
    "Service Offered",
    "Transferred to agent",
    "Transferred to 3rd party",
    "Unavailable",
    "Wrong Number",
]

# FIXED VALUES: answered labels that could still end in success.
CONVERTABLE = [
    "Audio/Connectivity Issues",
    "Call Back (Outbound)",
    "Completed",
    "Declined",
    "Do Not Call",
    "Member Authenticated",
    "Opted Out",
    "Other-Unable to Complete",
    "Pharmacy Call-Complete",
    "Service Offered",
    "Unavailable",
]

# FIXED VALUES: labels that mean success.
CONVERTED = ["Completed", "Pharmacy Call-Complete"]

# Reporting label of records that need a look at the case data. A free choice: set the
# wording your downstream sheets expect with ``reporting_by_label(review_label=...)``.
REVIEW = "Use case data / REMOVE"

# FIXED VALUES: disposition label -> reporting label.
REPORTING_BY_LABEL = {
    "Positive w/Amount": "UNKNOWN",
    "Positive no Amount": "UNKNOWN",
    "Negative — DNC — Skill": "DNC",
    "Negative — DNC — BU": "DNC",
    "Negative": "UNKNOWN",
    "Other": "Invalid Number",
    "Retry — Rescheduled Agent Specific": "Other-Unable to Complete",
    "Retry — Rescheduled Specified Date/Time — Any Agent": "Other-Unable to Complete",
    "Retry — Rescheduled Later Date/Time Unspecified": "Other-Unable to Complete",
    "Retry — Not Available": "Member Unavailable",
    "Retry — Answering Machine": "Left VM",
    "Final — Answering Machine": "Left VM",
    "Fax Machine": "Invalid Number",
    "Answering Machine Left Message": "Left VM",
    "Busy": "No Answer",
    "Error": "Audio/Connectivity Issues",
    "Fax": "Invalid Number",
    "Invalid Number": "Invalid Number",
    "Answering Machine": "Left VM",
    "No Answer AM": "No Answer",
    "No Answer / Answering Machine": "No Answer",
    "Number Changed": "Wrong Number",
    "Disconnect": "Invalid Number",
    "Network Busy": "No Answer",
    "Abandon": "Audio/Connectivity Issues",
    "Agent Abandon": "Audio/Connectivity Issues",
    "Manual Suppression": "DNC",
    "Webservice Suppression": "UNKNOWN",
    "IVR Suppression": "UNKNOWN",
    "Script Action Suppression": "REMOVE",
    "Bulk Upload Suppression": "UNKNOWN",
    "None": "Other-Unable to Complete",
    "Called Party Hang Up": "Audio/Connectivity Issues",
    "Force Agent Disconnect": "Audio/Connectivity Issues",
    "Call Takeover": "Other-Unable to Complete",
    "Disposition Timeout": "Other-Unable to Complete",
    "No Disposition": "Other-Unable to Complete",
    "Forced Remove Call": "Other-Unable to Complete",
    "System Failure": "Audio/Connectivity Issues",
    "No Ports": "Audio/Connectivity Issues",
    "Bad Number": "Invalid Number",
    "Retry - Preview Requeue": "Other-Unable to Complete",
    "Third Party — Cell Phone": "Other-Unable to Complete",
    "Third Party — DNC": "DNC",
    "Third Party — Time Zone Restricted": "Other-Unable to Complete",
    "Third Party — Legislative Restricted": "Other-Unable to Complete",
    "Script Action 1": "REMOVE",
    "Script Action 2": "REMOVE",
    "No Scripting Disposition": "UNKNOWN",
    "Agent Specific — Queue Is Full Final": "UNKNOWN",
    "Agent Specific — Queue Is Full": "UNKNOWN",
    "Callback Undeliverable": "Audio/Connectivity Issues",
    "Agent Specific — Agent Unavailable Final": "Audio/Connectivity Issues",
    "Agent Specific — Agent Unavailable": "Audio/Connectivity Issues",
    "Agent Specific — Agentless Skill Final": "Audio/Connectivity Issues",
    "ISDN Cause Code 18": "Audio/Connectivity Issues",
    "ISDN Cause Code 21": "Audio/Connectivity Issues",
    "ISDN Cause Code 102": "Audio/Connectivity Issues",
    "SysUnclassified": "UNKNOWN",
    "DialerBlendingRetry": "UNKNOWN",
    "Reactivation": "UNKNOWN",
    "SMS Final - Destination": "REMOVE",
    "SMS Transport Failure Retry": "REMOVE",
    "SMS Failure": "REMOVE",
    "SMS Failure Message too Long": "REMOVE",
    "SMS Failure Invalid Transport Code": "REMOVE",
    "Email Final": "REMOVE",
    "Email Failure": "REMOVE",
    "Email Retry": "REMOVE",
    "SMS Final - Record": "REMOVE",
    "SMS Retry": "REMOVE",
    "Retry - Snooze": "Audio/Connectivity Issues",
    "Retry - Preview Rescheduled Agent Specific": "Audio/Connectivity Issues",
    "Retry - Preview Rescheduled Any Agent": "Audio/Connectivity Issues",
    "Preview Reject - Positive": "Audio/Connectivity Issues",
    "Preview Reject - Positive w/Amount": "Audio/Connectivity Issues",
    "Preview Reject - Negative": "Audio/Connectivity Issues",
    "Preview Reject - Negative DNC BU": "DNC",
    "Preview Reject - Negative DNC Skill": "DNC",
    "Preview Reject - Negative Other": "Other-Unable to Complete",
    "Proactive Identified - Fax": "Invalid Number",
    "Proactive Identified - Answering Machine": "Left VM",
    "Proactive Identified - Bad Number": "Invalid Number",
    "Proactive Identified - Answering Machine Left Message Long": "Left VM",
    "Agent Session Timed Out": "Audio/Connectivity Issues",
    "Agent Override Answering Machine - No Message": "Left VM",
    "Agent Override Answering Machine - System Left Message": "Left VM",
    "Call Blocked by Carrier Analytics": "Audio/Connectivity Issues",
    "Call Refused By Customer": "No Answer",
    "Live Person Left Message": "Left VM",
    "Live Person Left Message Attempts Max": "Left VM",
    "Live Person Left Message Partial": "Left VM",
    "Answering Machine Left Message Partial": "Left VM",
    "Answering Machine Left Message Attempts Max": "Left VM",
    "Agent Override Fax Machine": "Invalid Number",
    "Agent Override Fax machine": "Invalid Number",
    "Audio/Connectivity Issues": "Audio/Connectivity Issues",
    "Call Back (Outbound)": "Member Unavailable",
    "Call Queued For later": "Audio/Connectivity Issues",
    "Completed": "Completed",
    "Deceased": REVIEW,
    "Declined": "Declined",
    "Do Not Call": "DNC",
    "Ineligible-LTC": "LTC",
    "Ineligible-Hospice": "Hospice",
    "Left Voicemail": "Left VM",
    "Member Authenticated": "Member Authenticated",
    "No Answer": "No Answer",
    "Opted Out": REVIEW,
    "Other-Unable to Complete": "Other-Unable to Complete",
    "Pharmacy Call-Complete": "REMOVE",
    "Previously Completed": "REMOVE",
    "Robo Response": "Other-Unable to Complete",
    "Service Offered": "Service Offered, Deferred",
    "Unavailable": "Member Unavailable",
    "Wrong Number": "Wrong Number",
    "Left Recorded Message": "Left VM",
    "UNKNOWN": "REMOVE",
    "Transferred to agent": "Transferred",
    "Transferred to Agent": "Transferred",
    "Automatic Transfer": "REMOVE",
}

# FIXED VALUES: reporting label -> label on slides.
PRESENTATION_BY_REPORTING = {
    "Audio/Connectivity Issues": "Left VM/Member Unavailable",
    "Completed": "Completed",
    "Deceased": "Deceased",
    "Declined": "Declined",
    "DNC": "DNC",
    "Invalid Number": "Invalid Number",
    "Left VM": "Left VM/Member Unavailable",
    "Member Unavailable": "Left VM/Member Unavailable",
    "No Answer": "Left VM/Member Unavailable",
    "Other-Unable to Complete": "Left VM/Member Unavailable",
    "Service Offered, Deferred": "Service Offered, Deferred",
    "Transferred": "Transferred",
    "Wrong Number": "Invalid Number",
}

# FIXED VALUES: call statuses that count as having reached the member.
REACHED = [
    "Refill Submitted",
    "Reminded - Refilled on own",
    "Out of Refill - Refill Request",
    "Already Ordered Refill",
    "Member Does Not Want Refill",
    "Member Stopped Medication",
    "Member No Longer With Plan",
    "Provider Changed Dose",
    "Provider Changed Medication",
    "Provider Discontinued Medicine",
    "Pharmacy Change",
    "Deceased",
    "Declined",
    "DNC",
]

# FIXED VALUES: first-call statuses after which a second attempt is allowed.
RETRYABLE = [
    "No Answer",
    "Left VM",
    "Audio/Connectivity Issues",
    "Other-Unable to Complete",
    "Member Unavailable",
]

# FIXED VALUES: outcome labels counted on their own.
SUBMITTED = "Refill Submitted"
OUT_OF_REFILL = "Out of Refill - Refill Request"
ON_OWN = "Reminded - Refilled on own"
NO_WORKFLOW = "No Post Completion Workflow"
DOES_NOT_WANT = "Member Does Not Want Refill"

# FIXED VALUES: reasons a scrub report may give.
DO_NOT_CALL = "Do not call"
MAX_ATTEMPTS = "Max attempt reached"
SCRUB_REASONS = [DO_NOT_CALL, "Invalid number", MAX_ATTEMPTS, "Missing data"]

# FIXED VALUES: contracts with their own split, and the default (contract, star) splits.
LISTED_CONTRACTS = ["S5884", "S5552"]
DEFAULT_GROUP = "MAPD"
DEFAULT_SPLITS = [("MAPD", "Stars"), ("MAPD", "Both"), ("S5884", "Stars"), ("S5552", "Stars")]
EVERYTHING = ("ALL", "All")

NOT_DIALED_CATEGORIES = ["Error / Failure", "Suppressed"]


def not_dialed_labels() -> list[str]:
    """System labels whose category says that no call went out."""
    return [label for label in DISPOSITION_BY_CODE.values() if CATEGORY_BY_LABEL.get(label) in NOT_DIALED_CATEGORIES]


def reporting_by_label(review_label: str = REVIEW) -> dict[str, str]:
    return {label: review_label if to == REVIEW else to for label, to in REPORTING_BY_LABEL.items()}


def literal_frame(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small fixed table as one literal: it lives in the plan, and Spark knows its size."""
    names = [field.split()[0] for field in schema.split(",")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    table = F.from_json(F.lit(text), "array<struct<" + schema.replace(" ", ":").replace(",:", ",") + ">>")
    return spark.range(1).select(F.inline(table))


def lookup_frame(spark: SparkSession, mapping: Mapping, schema: str) -> DataFrame:
    """A mapping as a two-column dimension frame; its size is fixed by the mapping in code."""
    return literal_frame(spark, list(mapping.items()), schema)

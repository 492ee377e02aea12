"""FIXED VALUES: column headers of the exported reports, in the order of the frames."""

FUNNEL = {
    "contact_date": "Contact Date",
    "leads_received": "Leads Received",
    "leads_available": "Leads Available for Outreach Count",
    "attempted_leads": "Attempted Leads Count",
    "attempt_rate": "Attempt Rate",
    "available_for_second": "Available for 2nd Attempts",
    "second_attempts": "2nd Attempt Count",
    "second_attempt_rate": "2nd Attempt Rate",
    "reached_leads": "Reached Leads Count",
    "reach_rate": "Reach Rate %",
    "submitted": "Refill Submitted",
    "on_own": "Reminded - Refilled on own",
    "refill_of_reached_rate": "Refill of Reached Rate %",
    "submitted_of_reached_rate": 'Refill of "Refill Submitted" Rate %',
    "refill_request": "Refill Request",
    "scrub_rate": "Scrub Rate",
    "refill_of_attempted_rate": "Refill of Attempted Rate",
    "submitted_of_attempted_rate": "Refill Submitted of Attempted Rate",
}

RESULT_SUMMARY = {
    "accepted": "Accepted",
    "declined": "Declined",
    "total": "Total",
    "not_completed": "Not Completed",
    "pct_accepted": "% Accepted",
    "pct_declined": "% Declined",
    "pct_not_completed": "% Not Completed",
    "pct_completed": "% Completed",
}

DECLINES = {"total_declined": "Total Declined"}

SUBMISSIONS = {
    "total_accepted": "Total Accepted",
    "follow_up_ratio": "(Refilled on Own + No Post Completion) : (Refill Submitted + Out of Refill)",
}

AGENTS = {
    "agent": "Completion By Email",
    "week": "Week",
    "total_completed": "Total Completed Calls",
    "accepted": "Refill Accepted",
    "pct_accepted": "% Refill Accepted",
    "declined": "Refill Declined",
    "pct_declined": "% Refill Declined",
    "does_not_want": "Member Does Not Want Refill",
    "pct_does_not_want": "% Member Does Not Want Refill",
    "on_own": "Reminded - Refilled on Own",
    "pct_on_own_of_total": "% Reminded - Refilled on Own (of Total)",
    "pct_on_own_of_accepted": "% Reminded - Refilled on Own (of Accepted)",
    "pct_submitted_of_accepted": "% Refill Submitted (of Accepted)",
    "above_75th_percentile": "Above 75th Percentile",
    "performance_flag": "Performance Flag",
}

REQUESTS = {
    "week": "Week",
    "row_label": "Row Labels",
    "requests": "Count of dispo",
    "share": "Total %",
    "bot": "AI",
    "bot_share": "AI %",
    "human": "Agent",
    "human_share": "Agent %",
}

CLERKS = {
    "clerk": "Clerk Email",
    "total_completed": "Total Completed",
    "combined_refills": "Refill Submitted + Out of Refill",
}

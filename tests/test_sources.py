import gzip
import json
from datetime import date, datetime, timezone

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ringwise.plans.weekly_report import (
    WeeklyInputs,
    export_weekly_report,
    missing_input_days,
    reread_reports,
    weekly_report,
)
from ringwise.sources import files as fs
from ringwise.sources import sinks
from ringwise.sources.call_log import CURRENT_LAYOUT, with_layout

DROP = fs.DatedFiles("Drop_*.csv", r"Drop_(\d{8})", "yyyyMMdd")
SCRUBBED = fs.DatedFiles("*_scrubbed.csv", r"^(\d{4}-\d{2}-\d{2})_")
CALLS = fs.DatedFiles("Calls-*.csv", r"Calls-(\d{8})", "yyyyMMdd")


def put(path, *lines, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))


def test_text_tables(spark, rows, tmp_path):
    put(tmp_path / "a" / "x.csv", "id,name", "01,NA", '02,""', "03,Zoë", "04,")
    df = fs.read_text_table(spark, [str(tmp_path / "a")])
    assert [t for _, t in df.dtypes] == ["string", "string"]
    assert rows(df) == [("01", None), ("02", None), ("03", "Zoë"), ("04", None)]
    kept = fs.read_text_table(spark, [str(tmp_path / "a")], na_words=False)
    assert rows(kept) == [("01", "NA"), ("02", ""), ("03", "Zoë"), ("04", "")]


def test_latin_1(spark, rows, tmp_path):
    put(tmp_path / "x.csv", "id,name", "1,Zoë", encoding="iso-8859-1")
    assert rows(fs.read_text_table(spark, [str(tmp_path)], encoding=fs.LATIN_1)) == [("1", "Zoë")]


def test_column_sets_are_united_by_name(spark, rows, tmp_path):
    put(tmp_path / "a" / "x.csv", "id,name", "1,n")
    put(tmp_path / "b" / "x.csv", "more,id", "m,2")
    paths = [str(tmp_path / p) for p in ("a", "b", "nowhere")]
    df = fs.read_text_table(spark, paths)
    assert df.columns == ["id", "name", "more"] and rows(df) == [("1", "n", None), ("2", None, "m")]


def test_another_header_in_the_same_scan_is_an_error(spark, tmp_path):
    put(tmp_path / "a" / "x.csv", "id,name", "1,n")
    put(tmp_path / "a" / "y.csv", "name,id", "n,1")
    with pytest.raises(Exception, match="header|CSV"):
        fs.read_text_table(spark, [str(tmp_path / "a")], columns=["id", "name"]).collect()


def test_dates_from_file_names_skip_files(spark, rows, tmp_path):
    for day in ("20251231", "20260101", "20260105"):
        put(tmp_path / f"Drop_{day}.csv", "H,leadid", f"D,{day}", "F,trailer", ",nokind")
    put(tmp_path / "other.csv", "x", "1")
    everything = fs.read_dated(spark, [str(tmp_path)], DROP)
    assert everything.count() == 9 and dict(everything.dtypes)["file_date"] == "date"
    year = fs.read_lead_drops(spark, [str(tmp_path)], DROP, date(2026, 1, 1), date(2026, 12, 31))
    assert rows(year, "leadid", "file_date") == [("20260101", date(2026, 1, 1)), ("20260105", date(2026, 1, 5))]
    one = fs.read_lead_drops(spark, [str(tmp_path)], DROP, date(2026, 1, 5), date(2026, 1, 5))
    assert rows(one, "leadid") == [("20260105",)]
    # The date filter picks files while listing: a broken file outside the range is never opened.
    (tmp_path / "Drop_20260201.csv.gz").write_bytes(b"not gzip at all")
    assert fs.read_lead_drops(spark, [str(tmp_path)], fs.DatedFiles("Drop_*", DROP.date_pattern, DROP.date_format), date(2026, 1, 5), date(2026, 1, 5)).count() == 1


def test_claims_days_are_folders(spark, rows, tmp_path):
    put(tmp_path / "2026-03-02" / "p_claims.csv", "Document Key,x", "a,1", "b,1")
    put(tmp_path / "2026-03-02" / "q_claims.csv", "Document Key,x", "a,1")
    put(tmp_path / "2026-03-03" / "p_claims.csv", "x", "1")
    put(tmp_path / "notaday" / "p_claims.csv", "Document Key,x", "z,1")
    put(tmp_path / "2026-03-04" / "ignored.csv", "Document Key,x", "y,1")
    claims = fs.read_claims(spark, [f"{tmp_path}/{d}" for d in ("2026-03-02", "2026-03-03", "2026-03-04", "notaday")], "*_claims.csv")
    d = date(2026, 3, 2)
    assert set(rows(claims)) == {(d, "a"), (d, "b"), (date(2026, 3, 3), None), (None, "z")} and claims.count() == 5


def test_case_report_is_strict_and_request_report_is_not(spark, rows, tmp_path):
    put(tmp_path / "c" / "x.csv", "Interaction Date,Disposition,Refill Reminder Result", "2026-03-02 10:00:00,Completed,Yes")
    case = fs.read_case_report(spark, [str(tmp_path / "c")])
    assert rows(case, "interaction_ts", "result", "reason") == [(datetime(2026, 3, 2, 10), "Yes", None)]
    put(tmp_path / "c" / "y.csv", "Interaction Date,Disposition,Refill Reminder Result", "soon,Completed,Yes")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        fs.read_case_report(spark, [str(tmp_path / "c")]).collect()
    put(
        tmp_path / "r" / "x.csv",
        "Pharmacy Request Completion Date,Pharmacy Request Completion By Email,Pharmacy Request Result",
        "03/02/2026,a@example.com,x", "2026-03-02 10:00:00,a@example.com,x", "soon,a@example.com,x",
    )
    found = fs.read_request_report(spark, [str(tmp_path / "r")])
    assert rows(found, "completed_ts") == [(datetime(2026, 3, 2),), (datetime(2026, 3, 2, 10),), (None,)]


def dnc_page(total, *records):
    return json.dumps({"dncList": {"totalRecords": str(total), "dncRecords": [dict(phoneNumber=p, dateCollected=d) for p, d in records]}}, indent=1)


def test_dnc_pages(spark, rows, tmp_path):
    first = ("+15550000001", "2026-03-01T10:00:00+00:00"), ("+115550000002", "2026-03-01T10:00:00-08:00")
    put(tmp_path / "g1" / "p1.json", dnc_page(2, *first))
    put(tmp_path / "g1" / "p2.json", dnc_page(2))
    put(tmp_path / "g2" / "p1.json", dnc_page(2, ("5550000001", "2026-01-01T00:00:00+00:00"), ("5550000009", "2026-03-05T00:00:00+00:00")))
    paths = [str(tmp_path / g) for g in ("g1", "g2")]
    cutoff = datetime(2026, 3, 1, 18, tzinfo=timezone.utc)
    assert rows(fs.read_dnc_pages(spark, paths, cutoff)) == [("5550000001",), ("5550000001",), ("5550000002",)]
    assert fs.read_dnc_pages(spark, paths).count() == 4
    before = datetime(2026, 3, 1, 17, 59, tzinfo=timezone.utc)
    assert fs.read_dnc_pages(spark, paths, before).count() == 2


@pytest.mark.parametrize("second", [None, "cut", "no list", "other total"])
def test_broken_or_missing_dnc_pages_fail(spark, tmp_path, second):
    one, other = ("5550000001", "2026-03-01T10:00:00+00:00"), ("5550000002", "2026-03-01T10:00:00+00:00")
    put(tmp_path / "p1.json", dnc_page(2, one))
    whole = dnc_page(2, other)
    texts = {"cut": whole[: len(whole) // 2], "no list": "{}", "other total": dnc_page(3, other)}
    if second is not None:
        put(tmp_path / "p2.json", texts[second])
    with pytest.raises(Exception):
        fs.read_dnc_pages(spark, [str(tmp_path)]).collect()
    put(tmp_path / "p2.json", whole)
    assert fs.read_dnc_pages(spark, [str(tmp_path)]).count() == 2


def test_csv_sink_round_trip(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x, y"), (3, 'say "hi"')], "a int, b string")
    path = str(tmp_path / "out.csv")
    sinks.write_csv(df, path, files=1)
    (part,) = (tmp_path / "out.csv").glob("part-*.csv")
    assert part.read_text().splitlines()[:2] == ["a,b", "1,"]
    assert rows(fs.read_text_table(spark, [path])) == [("1", None), ("2", "x, y"), ("3", 'say "hi"')]
    sinks.write_csv(df.limit(1), path, overwrite=False)
    assert fs.read_text_table(spark, [path]).count() == 3
    sinks.write_csv(df.limit(1), path)
    assert fs.read_text_table(spark, [path]).count() == 1


def test_table_sink_replaces_only_its_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    for day, n in ((1, 1), (2, 2), (1, 9)):
        df = sinks.with_run_date(spark.createDataFrame([(n,)], "n int"), date(2026, 3, day))
        sinks.write_table(df, path, ["run_date"])
    assert rows(spark.read.parquet(path)) == [(2, date(2026, 3, 2)), (9, date(2026, 3, 1))]


def test_names():
    assert sinks.scrub_report_name(date(2026, 3, 2)) == "2026-03-02_initial_scrub_file.csv"
    assert sinks.scrubbed_leads_name(date(2026, 3, 2)) == "2026-03-02_original_refill_data_scrubbed.csv"
    assert sinks.scrub_transfer_name(datetime(2026, 3, 2, 7)) == "Scrub-2026030207.csv"


def test_layout_projection_lets_filters_reach_the_scan(spark, tmp_path):
    names = list(dict.fromkeys(CURRENT_LAYOUT.values()))
    raw = spark.range(1).select(*[F.lit(datetime(2026, 1, 1) if n == "timestamp" else "x").alias(n) for n in names])
    raw.write.parquet(str(tmp_path / "log"))
    log = with_layout(spark.read.parquet(str(tmp_path / "log")), CURRENT_LAYOUT)
    plan = log.filter(F.col("skill") == "x").select("disposition")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(skill_name,x)" in plan and "ReadSchema: struct<dialer_disposition:string,skill_name:string>" in plan


@pytest.fixture
def weekly_inputs(tmp_path):
    lead = "H,leadid,RecipientMemberCardId,RecipientMemberDependentCode,MCO_Contract_Number,Stars_Nonstars_1,Stars_Nonstars_2,Stars_Nonstars_3"
    put(tmp_path / "leads" / "Drop_20260302.csv", lead, "D,L1,A,1,S5884,Stars,,", "D,L2,B,1,H1,Both,Stars,", "F,,,,,,,")
    put(tmp_path / "leads" / "Drop_20260311.csv", lead, "D,L9,Z,1,S5884,Stars,,")
    kept = "leadid,idcard_mbr_id,Stars_Nonstars_1,Stars_Nonstars_2,Stars_Nonstars_3"
    put(tmp_path / "etl" / "2026-03-02" / "2026-03-02_scrubbed.csv", kept, "L1,A1,Stars,,", "L1,A1,Stars,,")
    calls = "leadid,idcard_mbr_id,contact_attempt_date_time,call_status_1,call_status_2,call_status_3"
    put(
        tmp_path / "daily" / "2026-03-02" / "Calls-2026030218.csv", calls,
        "L1,A1,2026-03-02 09:00:00.000000-05:00,No Answer,,", "L1,A1,2026-03-02 15:00:00.000000-05:00,,Refill Submitted,",
        "L2,B1,2026-03-01 15:00:00.000000-05:00,Left VM,,",
    )
    return WeeklyInputs(str(tmp_path / "leads"), str(tmp_path / "etl"), str(tmp_path / "daily"), DROP, SCRUBBED, CALLS)


def test_weekly_report_from_files_to_files_and_back(spark, rows, weekly_inputs, tmp_path):
    as_of = date(2026, 3, 4)  # week of 25 February to 3 March
    report = weekly_report(spark, weekly_inputs, as_of)
    assert rows(report, "split", "file_date", "leads_received", "leads_available", "attempted_leads", "second_attempts",
                "available_for_second", "reached_leads", "submitted", "scrub_rate") == [
        ("ALL:All", date(2026, 3, 2), 2, 1, 1, 1, 1, 1, 1, 50.0),
        ("S5884:Stars", date(2026, 3, 2), 1, 1, 1, 1, 1, 1, 1, 0.0),
    ]
    ytd = weekly_report(spark, weekly_inputs, as_of, ytd=True, contract_splits=["H1:All", "S5884:All"])
    assert rows(ytd, "split", "file_date", "leads_received") == [
        ("ALL:All", date(2026, 3, 2), 2), ("ALL:All", date(2026, 3, 11), 1),
        ("S5884:All", date(2026, 3, 2), 1), ("S5884:All", date(2026, 3, 11), 1),
    ]
    missing = missing_input_days(spark, weekly_inputs.scrubbed, as_of)
    assert date(2026, 3, 2) not in {r[0] for r in missing.collect()} and missing.count() == 6

    out = str(tmp_path / "out")
    export_weekly_report(report, out, as_of)
    written = fs.read_text_table(spark, [f"{out}/run_date=2026-03-04"])
    assert written.columns[0] == "Contact Date" and len(written.columns) == 18
    again = reread_reports(spark, [out])
    columns = ("split", "file_date", "leads_received", "leads_available", "submitted", "scrub_rate", "submitted_of_attempted_rate")
    assert rows(again, *columns) == rows(report, *columns)
    old = tmp_path / "old" / "2026-03-04_S5884_Stars_weekly_report.csv"
    (part,) = (tmp_path / "out" / "run_date=2026-03-04" / "split=S5884%3AStars").glob("part-*.csv")
    old.parent.mkdir()
    old.write_text(part.read_text().replace(",0.0,", ",,", 1))
    named = reread_reports(spark, [str(old.parent)], "*_weekly_report.csv")
    assert rows(named, "split", "file_date", "leads_received", "scrub_rate") == [("S5884_Stars", date(2026, 3, 2), 1, 0.0)]


def test_empty_files_add_nothing(spark, rows, tmp_path):
    (tmp_path / "2026-03-02").mkdir()
    (tmp_path / "2026-03-02" / "a_claims.csv").write_text("")
    put(tmp_path / "2026-03-02" / "b_claims.csv", "Document Key,x", "a,1")
    (tmp_path / "2026-03-03").mkdir()
    (tmp_path / "2026-03-03" / "a_claims.csv").write_text("")
    claims = fs.read_claims(spark, [f"{tmp_path}/2026-03-02", f"{tmp_path}/2026-03-03"], "*_claims.csv")
    assert rows(claims) == [(date(2026, 3, 2), "a")]


def test_damaged_files_fail_or_are_returned(spark, rows, tmp_path):
    put(tmp_path / "a.csv", "id", "1")
    whole = gzip.compress(("id\n" + "".join(f"{i}\n" for i in range(50_000))).encode())
    (tmp_path / "b.csv.gz").write_bytes(b"not gzip at all")
    (tmp_path / "c.csv.gz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "d.csv").write_text("")
    for options in ({}, {"columns": ["id"]}):
        with pytest.raises(Exception):
            fs.read_text_table(spark, [str(tmp_path)], **options).collect()
    found, skipped = fs.read_readable(spark, [str(tmp_path)])
    assert rows(found) == [("1",)]
    assert sorted(r.path.rsplit("/", 1)[1] for r in skipped.collect()) == ["b.csv.gz", "c.csv.gz"]
    assert all(r.error for r in skipped.collect())
    nothing, skipped = fs.read_readable(spark, [str(tmp_path)], glob="*.gz")
    assert nothing is None and skipped.count() == 2


def test_files_of_one_folder_keep_their_own_headers(spark, rows, tmp_path):
    put(tmp_path / "Drop_20260101.csv", "H,leadid,RecipientPhoneNumber", "D,a,1", "D,b,2")
    put(tmp_path / "Drop_20260102.csv", "H,leadid,RecipientPhoneNumber,extra", "D,c,3,x", "F,,,")
    put(tmp_path / "Drop_20260103.csv", "RecipientPhoneNumber,H,leadid", "4,D,d")
    put(tmp_path / "Drop_20260104[1].csv", "H,leadid", "D,e")
    drops = fs.read_lead_drops(spark, [str(tmp_path)], DROP)
    want = [("a", "1", None), ("b", "2", None), ("c", "3", "x"), ("d", "4", None), ("e", None, None)]
    assert rows(drops, "leadid", "phone", "extra") == want
    day = tmp_path / "2026-03-02"
    put(day / "p_claims.csv", "Document Key,x", "a,1")
    put(day / "q_claims.csv", "x,Document Key", "1,b")
    assert rows(fs.read_claims(spark, [str(tmp_path)], "*_claims.csv"), "document_key") == [("a",), ("b",)]


def test_year_to_date_unites_headers(spark, rows, weekly_inputs):
    kept = "idcard_mbr_id,leadid,Stars_Nonstars_1,Stars_Nonstars_2,Stars_Nonstars_3,note"
    put(Path(weekly_inputs.scrubbed) / "2026-03-09" / "2026-03-09_scrubbed.csv", kept, "A1,L1,Stars,,,x")
    put(
        Path(weekly_inputs.dispositions) / "2026-03-09" / "Calls-2026030918.csv",
        "call_status_1,leadid,idcard_mbr_id,contact_attempt_date_time,call_status_2,call_status_3",
        "Refill Submitted,L1,A1,2026-03-09 09:00:00.000000-05:00,,",
    )
    put(Path(weekly_inputs.leads) / "Drop_20260309.csv", "leadid,H,RecipientMemberCardId,RecipientMemberDependentCode,MCO_Contract_Number,Stars_Nonstars_1,Stars_Nonstars_2,Stars_Nonstars_3", "L1,D,A,1,S5884,Stars,,")
    ytd = weekly_report(spark, weekly_inputs, date(2026, 3, 11), ytd=True).filter("split = 'ALL:All'")
    assert rows(ytd, "file_date", "leads_received", "leads_available", "submitted") == [
        (date(2026, 3, 2), 2, 1, 1), (date(2026, 3, 9), 1, 1, 1), (date(2026, 3, 11), 1, None, None)
    ]


def test_nothing_found(spark, tmp_path):
    empty = fs.read_dated(spark, [str(tmp_path / "nowhere")], DROP, columns=["H", "leadid"])
    assert empty.columns == ["H", "leadid", "file_date"] and empty.count() == 0
    with pytest.raises(FileNotFoundError):
        fs.read_dated(spark, [str(tmp_path / "nowhere")], DROP)


def test_dates_out_of_range_are_never_opened(spark, rows, tmp_path):
    put(tmp_path / "Drop_20260101.csv", "H,leadid", "D,a")
    put(tmp_path / "Drop_20250101.csv", "other,header", "x,y")
    found = fs.read_dated(
        spark, [str(tmp_path)], DROP, date(2026, 1, 1), columns=["H", "leadid"]
    )
    assert rows(found, "leadid") == [("a",)]


def _csv(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_quoted_line_breaks_stay_in_their_field(spark, tmp_path):
    path = _csv(tmp_path / "a.csv", 'a,b\n"x\ny",2\n3,"p, ""q"""\n')
    got = sorted(tuple(r) for r in fs.read_text_table(spark, [path], na_words=False).select("a", "b").collect())
    assert got == [("3", 'p, "q"'), ("x\ny", "2")]


def test_short_rows_have_nulls_and_surplus_fields_fail(spark, tmp_path):
    short = _csv(tmp_path / "short" / "a.csv", "a,b,c\n1,2\n4,5,6\n")
    got = sorted(tuple(r) for r in fs.read_text_table(spark, [short]).select("a", "b", "c").collect())
    assert got == [("1", "2", None), ("4", "5", "6")]
    long = _csv(tmp_path / "long" / "a.csv", 'a,b\n1,2\n1,2,3\n"x,y",2\n')
    with pytest.raises(Exception, match="more fields than the 2 of its header"):
        fs.read_text_table(spark, [long]).select("a").collect()
    with pytest.raises(Exception, match="more fields"):
        fs.read_text_table(spark, [long]).count()


def test_rows_with_surplus_fields_are_returned_apart(spark, tmp_path):
    _csv(tmp_path / "d" / "a.csv", 'a,b\n1,2\n1,2,3\n"x,\ny",2\n7\n')
    _csv(tmp_path / "d" / "b.csv", 'b,a\n5,6\n"q","r",,\n')
    rows, rejects = fs.read_with_rejects(spark, [str(tmp_path / "d")], na_words=False)
    assert sorted(tuple(r) for r in rows.select("a", "b").collect()) == [("1", "2"), ("6", "5"), ("7", ""), ("x,\ny", "2")]
    got = sorted((Path(r.path).name, r.record) for r in rejects.collect())
    assert got == [("a.csv", "1,2,3"), ("b.csv", '"q","r",,')]
    empty_rows, empty_rejects = fs.read_with_rejects(spark, [str(tmp_path / "d")], glob="*.none", columns=["a"])
    assert empty_rows.count() == 0 and empty_rejects.count() == 0


def test_a_header_with_a_quoted_line_break(spark, tmp_path):
    path = _csv(tmp_path / "h.csv", '"first\nname",b\nx,1\n')
    assert fs.file_header(spark, path) == ("first\nname", "b")
    assert [tuple(r) for r in fs.read_text_table(spark, [path]).select("b").collect()] == [("1",)]


def test_a_killed_export_is_written_again(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "a int, b string")
    path = tmp_path / "killed.csv"
    (path / "_temporary" / "0").mkdir(parents=True)
    (path / "part-00000-half.csv").write_text("a,b\n1,")
    assert not sinks.is_written(spark, str(path))
    sinks.write_csv(df, str(path), overwrite=False)
    assert sinks.is_written(spark, str(path))
    assert sorted(tuple(r) for r in fs.read_text_table(spark, [str(path)]).collect()) == [("1", "a"), ("2", "b")]
    sinks.write_csv(df.limit(1), str(path), overwrite=False)  # finished: left alone
    assert fs.read_text_table(spark, [str(path)]).count() == 2
    table = tmp_path / "table"
    (table / "_temporary").mkdir(parents=True)
    sinks.write_table(df, str(table), overwrite=False)
    assert spark.read.parquet(str(table)).count() == 2

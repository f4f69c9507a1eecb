"""Issue reports on hand-made rows the fixtures do not reach."""

from __future__ import annotations

import datetime as dt
import html
import re
from dataclasses import replace

from pyspark.sql import functions as F

from gapledger.config import IssueRules
from gapledger.plans import issues as iss
from gapledger.sources.named_sql import run_named_query

RULES = IssueRules(as_of=dt.date(2022, 12, 1), cutoff=dt.date(2022, 10, 1))
SPRINT_SCHEMA = "sprint_id string, start_date string, end_date string"
TEAM_SCHEMA = "alias string, manager string, sr_manager string"
FOLDER_SCHEMA = "assignedfolderid string, folder_roll_up string"
ISSUE = {
    "issueid": "1", "title": "t", "issueurl": "u1", "assignedfolderid": "F0",
    "assigneeidentity": "kerberos:ann@CORP.EXAMPLE", "status": "Resolved", "createdate": "2022-10-03",
    "resolveddate": "2022-10-07", "estimatedcompletiondate": None, "actualstartdate": "2022-10-03",
    "label_customer": None, "label_product": "p", "label_execution": None, "label_planning": None,
    "labelids": "S7,L1", "totaleffortspent": 0, "rootcauses": "x", "conversationcount": 3,
    "last_comment_author": "ann", "parenttaskids": None,
}
ISSUE_SCHEMA = ", ".join(
    f"{c} {'bigint' if c in ('totaleffortspent', 'conversationcount') else 'string'}" for c in ISSUE
)
SPRINTS = [("S7", "2022-11-28T09:00:00", "2022-12-09T17:00:00")]
TEAM = [("ann", "mia", "sue"), ("bob", "bob", "sue"), ("cy", None, "sue"), ("di", "di", None)]


def issues(spark, *changes: dict):
    rows = [tuple((ISSUE | change).values()) for change in changes]
    return spark.createDataFrame(rows, ISSUE_SCHEMA)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def identity(alias: str) -> str:
    return f"kerberos:{alias}@CORP.EXAMPLE"


def test_overlapping_sprints_take_the_latest_start_then_the_lowest_id(spark):
    overlapping = [
        ("S6", "2022-11-14", "2022-11-29"), ("S8", "2022-11-28", "2022-12-09"), ("S7", "2022-11-28", "2022-12-09"),
        ("S9", "2022-12-12", "2022-12-23"),
    ]
    sprints = frame(spark, overlapping, SPRINT_SCHEMA)
    assert {r.sprint_id for r in iss.active_sprints(sprints, RULES).collect()} == {"S6", "S7", "S8"}
    assert iss.current_sprint(sprints, RULES).first().current_sprint_id == "S7"


def test_no_active_sprint_means_no_rows(spark):
    sprints = frame(spark, [("S7", "2021-01-01", "2021-01-10"), ("S8", None, "x")], SPRINT_SCHEMA)
    folders = frame(spark, [("F0", "BUG")], FOLDER_SCHEMA)
    assert iss.current_sprint(sprints, RULES).collect() == []
    assert iss.missing_mandatory_fields(issues(spark, {}), folders, sprints, RULES).collect() == []
    assert iss.assignee_recipients(issues(spark, {}), folders, sprints, RULES).collect() == []


def test_missing_fields_scope(spark):
    rows = issues(
        spark,
        {"issueurl": "no customer"},
        {"issueurl": "complete", "label_customer": "c"},
        {"issueurl": "no finish", "label_customer": "c", "resolveddate": None, "labelids": "S7,L1,L2"},
        {"issueurl": "no finish, no own label", "label_customer": "c", "resolveddate": None, "labelids": "S7,L1"},
        {"issueurl": "child", "parenttaskids": "P"},
        {"issueurl": "other sprint", "labelids": "S6"},
        {"issueurl": "longer id", "labelids": "S77"},
        {"issueurl": "no labels", "labelids": None},
        {"issueurl": "epic", "assignedfolderid": "F3"},
        {"issueurl": "unknown folder", "assignedfolderid": "F9"},
        {"issueurl": "unassigned", "assigneeidentity": None},
    )
    folders = frame(spark, [("F0", "BUG"), ("F3", "Epic"), ("F4", None)], FOLDER_SCHEMA)
    sprints = frame(spark, SPRINTS, SPRINT_SCHEMA)
    found = {
        r.issueurl: (r.missing_customer_label, r.missing_completion_date)
        for r in iss.missing_mandatory_fields(rows, folders, sprints, RULES).collect()
    }
    assert found == {
        "no customer": ("Yes", "No"), "no finish": ("No", "Yes"), "longer id": ("Yes", "No"),
        "unknown folder": ("Yes", "No"), "unassigned": ("Yes", "No"),
    }
    exact = iss.missing_mandatory_fields(rows, folders, sprints, replace(RULES, exact_sprint_label=True))
    assert "longer id" not in {r.issueurl for r in exact.collect()}


def test_recipients(spark):
    people = ["ann", "bob", "cy", "di", "stranger"]
    rows = issues(spark, *[{"assigneeidentity": identity(p)} for p in people + people], {"assigneeidentity": None})
    folders = frame(spark, [("F0", "BUG")], FOLDER_SCHEMA)
    sprints, team = frame(spark, SPRINTS, SPRINT_SCHEMA), frame(spark, TEAM, TEAM_SCHEMA)
    found = iss.assignee_recipients(rows, folders, sprints, RULES).collect()
    assert sorted(tuple(r) for r in found) == sorted((p, f"{p}@example.org") for p in people)
    managers = iss.manager_recipients(rows, folders, team, sprints, RULES).collect()
    # The manager who manages themselves without a senior leaves a null row.
    assert {tuple(r) for r in managers} == {("mia", "mia@example.org"), ("sue", "sue@example.org"), (None, None)}


def gap_fixture(spark):
    rows = issues(
        spark,
        {"issueurl": "u1"}, {"issueurl": "u1"},
        {"issueurl": "u2", "resolveddate": "2022-10-28", "title": 'a <b> & "c"'},
        {"issueurl": "u3", "assigneeidentity": identity("bob")},
        {"issueurl": "u4", "assigneeidentity": identity("cy")},
        {"issueurl": "u5", "assigneeidentity": None},
        {"issueurl": "bot", "last_comment_author": "robot"},
        {"issueurl": "no author", "last_comment_author": None},
        {"issueurl": "open", "status": "Open"},
        {"issueurl": "on the cut-off", "resolveddate": "2022-10-01"},
        {"issueurl": "bad date", "resolveddate": "soon"},
        {"issueurl": "no gap", "label_customer": "c", "labelids": "a,b,c,d,e", "totaleffortspent": 5,
         "label_execution": "e", "estimatedcompletiondate": "2022-10-05", "label_planning": "p", "rootcauses": "x"},
        {"issueurl": "negative count", "label_customer": None, "label_execution": "e", "label_planning": "p",
         "labelids": None, "totaleffortspent": None, "estimatedcompletiondate": "2022-10-05", "conversationcount": None},
    )
    return rows, frame(spark, TEAM, TEAM_SCHEMA)


def test_resolved_bug_gaps(spark):
    rows, team = gap_fixture(spark)
    report = iss.resolved_bug_gaps(rows, team, RULES).collect()
    by_url = {r.issueurl: r for r in report}
    assert set(by_url) == {"u1", "u2", "u3", "u4", "u5", "negative count"}
    assert by_url["u1"].missing_labels == "Customer"
    assert by_url["u1"].missing_dates == "Estimated Completion Date"
    assert by_url["u1"].missing_effort == "Yes"
    assert by_url["u1"].business_days == 55 - 2 * 8
    assert by_url["negative count"].missing_labels == "No"
    assert by_url["negative count"].missing_effort == "No"
    assert by_url["negative count"].missing_comments == "Yes"
    assert {u: r.manager_email for u, r in by_url.items()} == {
        "u1": "mia@example.org", "u2": "mia@example.org", "u3": "sue@example.org", "u4": None, "u5": None,
        "negative count": "mia@example.org",
    }
    # By assignee, unassigned last; longest wait first; then by link.
    order = [(r.assignee is None, r.assignee or "", -r.business_days, r.issueurl) for r in report]
    assert order == sorted(order)


def test_lists_keep_the_order_of_appearance(spark):
    rows, team = gap_fixture(spark)
    gaps = iss.bug_gap_rows(rows, team, RULES)
    report = iss.resolved_bug_gaps(rows, team, RULES).collect()
    to_list = iss.bug_gap_to_list(gaps, RULES).orderBy("list_order").collect()
    assert [r.address for r in to_list] == list(dict.fromkeys(f"{r.assignee}@example.org" for r in report if r.assignee))
    rules = replace(RULES, always_copied=("lead@example.org", "mia@example.org", "zoe@example.org"))
    cc = iss.bug_gap_cc_list(gaps, rules).orderBy("list_order").collect()
    managers = [r.manager_email for r in report if r.manager_email]
    assert [r.address for r in cc] == list(dict.fromkeys([*managers, *rules.always_copied]))
    assert [r.list_order for r in cc] == list(range(1, len(cc) + 1))


def test_managers_of_one_issue_are_listed_in_address_order(spark, settings):
    settings(spark__sql__adaptive__enabled="false")
    managers = [f"m{n:02}" for n in range(15)]
    team = frame(spark, [("ann", m, None) for m in reversed(managers)] * 2, TEAM_SCHEMA)
    gaps = iss.bug_gap_rows(issues(spark, {}).repartition(8), team, RULES)
    assert gaps.count() == 15
    cc = iss.bug_gap_cc_list(gaps, RULES).orderBy("list_order").collect()
    report = iss.resolved_bug_gaps(issues(spark, {}), team, RULES).collect()
    assert [r.address for r in cc][:15] == [r.manager_email for r in report] == [f"{m}@example.org" for m in managers]


def test_cut_off_on_the_text_keeps_what_the_date_keeps(spark):
    texts = ["2022-10-01", "2022-10-01T23:59", "2022-10-02", "2022-10-02junk", "2022-11", "2022", "2023-1-5", "x", " 2022-10-07"]
    rows = issues(spark, *[{"resolveddate": t} for t in texts])
    kept = [r.resolveddate for r in iss.resolved_bugs(rows, RULES).collect()]
    assert kept == ["2022-10-02", "2022-10-02junk"]


def test_named_query_follows_the_week_start(spark):
    rows = issues(spark, {"resolveddate": "2022-10-07"}, {"issueurl": "u2", "resolveddate": "2022-10-09"})
    team = frame(spark, TEAM, TEAM_SCHEMA)
    for start in ("monday", "sunday"):
        rules = replace(RULES, week_start=start)
        params = {n: getattr(rules, n) for n in (
            "as_of", "cutoff", "bug_folder", "resolved_status", "bot_author", "realm_prefix", "realm_suffix",
            "mail_domain", "week_start",
        )}
        named = run_named_query(spark, "resolved_bug_gaps", params, {"issues": rows, "team": team})
        assert named.collect() == iss.resolved_bug_gaps(rows, team, rules).collect()


def test_cell_flags_leave_comments_out(spark):
    rows, team = gap_fixture(spark)
    gaps = iss.bug_gap_rows(rows, team, RULES)
    flags = {r.issueurl: r for r in iss.bug_gap_cell_flags(gaps, RULES).collect()}
    assert flags["u1"].flag_missing_labels and flags["u1"].flag_missing_effort
    assert not flags["negative count"].flag_missing_comments
    every = replace(RULES, flagged_columns=iss.METRICS)
    assert {r.issueurl: r for r in iss.bug_gap_cell_flags(gaps, every).collect()}["negative count"].flag_missing_comments


def test_digest_holds_every_row_once_and_escapes(spark):
    rows, team = gap_fixture(spark)
    report = iss.resolved_bug_gaps(rows, team, RULES).collect()
    for page_rows in (1, 2, 200):
        pages = iss.bug_gap_digest(iss.bug_gap_rows(rows, team, RULES), replace(RULES, page_rows=page_rows)).collect()
        assert max(p.row_count for p in pages) <= page_rows
        for manager in {r.manager_email for r in report}:
            mine = sorted((p for p in pages if p.manager_email == manager), key=lambda p: p.page)
            assert [p.page for p in mine] == list(range(1, len(mine) + 1))
            links = [u for p in mine for u in re.findall(r'href="([^"]*)"', p.html)]
            assert links == [r.issueurl for r in report if r.manager_email == manager]
        text = "".join(p.html for p in pages)
        assert html.escape('a <b> & "c"') in text and "<b>" not in text
    by_person = iss.bug_gap_digest(iss.bug_gap_rows(rows, team, RULES), RULES, "assignee").collect()
    assert {p.assignee for p in by_person} == {"ann", "bob", "cy", None}
    assert sum(p.row_count for p in by_person) == len(report)


def test_digest_of_a_recipient_with_very_many_rows(spark):
    team = frame(spark, TEAM, TEAM_SCHEMA)
    one = issues(spark, {}).drop("issueurl")
    many = one.crossJoin(spark.range(5_000).select(F.concat(F.lit("u"), F.col("id")).alias("issueurl")))
    pages = iss.bug_gap_digest(iss.bug_gap_rows(many, team, RULES), replace(RULES, page_rows=300)).collect()
    assert sum(p.row_count for p in pages) == 5_000
    assert sorted(p.page for p in pages) == list(range(1, 18))
    links = [u for p in sorted(pages, key=lambda p: p.page) for u in re.findall(r'href="([^"]*)"', p.html)]
    assert links == sorted(f"u{n}" for n in range(5_000))


def test_nothing_to_send(spark):
    rows, team = gap_fixture(spark)
    none = iss.bug_gap_rows(rows.filter("issueurl = 'bot'"), team, RULES)
    status = iss.bug_gap_run_status(none, RULES).collect()
    assert [tuple(r) for r in status] == [(RULES.as_of, 0, True)]
    assert iss.bug_gap_digest(none, RULES).collect() == []
    assert [r.address for r in iss.bug_gap_cc_list(none, RULES).collect()] == ["lead@example.org"]
    some = iss.bug_gap_run_status(iss.bug_gap_rows(rows, team, RULES), RULES).first()
    assert (some.row_count, some.is_empty) == (6, False)

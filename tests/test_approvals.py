"""Approval reports on hand-made rows the fixtures do not reach."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from gapledger.config import ApprovalRules
from gapledger.plans import approvals as ap
from gapledger.plans import reconcile as rec

RULES = ApprovalRules(as_of_time=dt.datetime(2001, 6, 20, 9, 0))
SCHEMA = (
    "approval_id bigint, title string, needed_on string, decision string, approver string, status string, "
    "template_id int, role string"
)
ROW = {
    "approval_id": 1, "title": "EU 2001 ABC1 Startup $5M", "needed_on": "06-20-2001 12:00:00", "decision": "Pending",
    "approver": "Lead, A", "status": "Pending", "template_id": 0, "role": "APPROVER",
}


def extract(spark, *changes: dict):
    return spark.createDataFrame([tuple((ROW | change).values()) for change in changes], SCHEMA)


def test_filters_follow_the_columns_present(spark):
    rows = extract(
        spark, {}, {"role": "OBSERVER"}, {"status": "Closed"}, {"decision": None}, {"decision": "Rejected"},
        {"decision": "Approved with condition"}, {"template_id": 37508},
    )
    assert ap.pending_approvals(rows, RULES).count() == 2
    assert ap.pending_approvals(rows, RULES, template="eu_real_estate").count() == 1
    without_role = ap.pending_approvals(rows.drop("role", "template_id"), RULES)
    assert without_role.count() == 3
    assert {r.template_id for r in without_role.collect()} == {0}
    wider = replace(RULES, accepted_decisions=(*RULES.accepted_decisions, "Approved with condition"))
    assert ap.pending_approvals(rows, wider).count() == 3


def test_own_headings(spark):
    headed = extract(spark, {}).withColumnsRenamed({"approval_id": "Approval Id", "decision": "Actor Action"})
    rows = ap.pending_approvals(headed, RULES, names={"Approval Id": "approval_id", "Actor Action": "decision"})
    assert rows.columns == extract(spark, {}).columns


def test_marks_queue_and_sets(spark):
    rows = extract(
        spark,
        {"approver": "Lead, A", "decision": "Approved"}, {"approver": "Lead, A", "decision": "Pending in future"},
        {"approver": "Lead, B", "decision": "Approved"}, {"approver": "Zed", "decision": "Pending"},
        {"approver": "Zed", "decision": "Pending"}, {"approver": "Abe", "decision": "Pending"},
        {"approval_id": 2, "approver": "Lead, C"},
        {"approval_id": 3, "approver": "Finance, D"},
        {"approval_id": 4, "approver": "Lead, A", "decision": "Approved"},
        {"approval_id": 5, "approver": "Somebody"},
        {"approval_id": 6, "title": None}, {"approval_id": None}, {"approval_id": 7, "approver": None},
        {"approval_id": 8, "approver": "Lead, A (deputy)"},
    )
    pending = ap.pending_approvals(rows, RULES)
    found = {r.approval_id: r for r in ap.approver_checklist(pending, RULES).collect()}
    assert {i: (r.mark_a, r.mark_b, r.mark_c, r.mark_d, r.queue) for i, r in found.items()} == {
        1: (" ", "✓", "NA", "NA", "Pre-VP"),
        2: ("NA", "NA", " ", "NA", "VP"),
        3: ("NA", "NA", "NA", " ", "Pre-VP"),
    }
    rollup = {r.approval_id: r for r in ap.approval_rollup(pending, RULES).collect()}
    assert set(rollup) == {1, 2, 3, 4, 5, 7, 8}
    assert rollup[1].pending == "Abe | Zed" and rollup[1].pending_in_future == "Lead, A"
    assert rollup[1].approved == "Lead, A | Lead, B" and rollup[1].approved_with_condition == ""
    assert rollup[7].pending == ""
    # The queue goes by containment of the name, so a deputy's counts.
    groups = {r.approval_id: r.queue for r in ap.request_groups(pending, RULES).collect()}
    assert groups[8] == "VP"


def test_one_request_may_hold_a_third_of_all_rows(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).cast("bigint").alias("approval_id"),
        F.lit(ROW["title"]).alias("title"), F.lit(ROW["needed_on"]).alias("needed_on"),
        F.lit("Pending").alias("decision"),
        F.when(F.col("id") % 2 == 0, "Lead, A").otherwise(F.concat(F.lit("P"), F.col("id") % 9)).alias("approver"),
        F.lit("Pending").alias("status"), F.lit(0).alias("template_id"), F.lit("APPROVER").alias("role"),
    )
    found = ap.approval_rollup(ap.pending_approvals(hot, RULES), RULES)
    assert found.count() == 20_001
    assert found.filter("approval_id = 1").first().pending == "Lead, A | P0 | P3 | P6"


def test_needed_by_conflict(spark):
    rows = extract(
        spark, {"needed_on": "12-01-2001 05:00:00"}, {"needed_on": "02-01-2002 05:00:00"},
        {"approval_id": 2, "needed_on": None}, {"approval_id": 3, "needed_on": "broken"},
    )
    pending = ap.pending_approvals(rows, RULES)
    assert {r.approval_id: r.needed_by for r in ap.needed_by_rollup(pending).collect()}[1] == (
        "02-01-2002 05:00:00 | 12-01-2001 05:00:00")
    report = {r.approval_id: r for r in ap.approval_report(pending, RULES).collect()}
    # The earliest time counts, not the first text.
    assert report[1].need_by == "30-Nov, 2001" and report[1].needed_by_conflict
    assert report[2].need_by is None and report[3].need_by is None


def test_report_order_and_numbers(spark):
    titles = [
        "NA 2001 Startup", "EU 2001 Startup", "EU 2000 Startup", "AP 2001 Construction", "AP nothing known", "EU  other",
        "", "JP 2001 SU RE ",
    ]
    rows = extract(spark, *[
        {"approval_id": i, "title": t, "decision": d} for i, t in enumerate(titles, 1) for d in ("Pending",)
    ], *[{"approval_id": i + 100, "title": t, "decision": "Pending in future"} for i, t in enumerate(titles, 1)])
    report = ap.approval_report(ap.pending_approvals(rows, RULES), RULES).orderBy("row_number").collect()
    assert [r.row_number for r in report] == list(range(1, 17))
    expected = sorted(report, key=lambda r: (
        r.queue == "Pre-VP", r.request_type is None, r.request_type or "", RULES.region_rank[r.region], r.plan_year,
        r.template_id, r.approval_id, r.original_title))
    assert [r.approval_id for r in report] == [r.approval_id for r in expected]
    assert [r.approval_id for r in report[:3]] == [4, 8, 3]
    assert report[0].approval_link == '=HYPERLINK("https://approvals.example.org/4", 4)'
    empty = {r.approval_id: r for r in report}[7]
    assert (empty.region, empty.plan_year, empty.request_type, empty.amount_mm, empty.clean_title) == (
        "Check", "", None, None, "  ")
    assert empty.unrecognized


def test_unknown_templates(spark):
    rows = extract(spark, {}, {"approval_id": 2, "template_id": 7393}, {"approval_id": 3, "template_id": 5},
                   {"approval_id": 4, "template_id": 6, "approver": "Nobody tracked"})
    found = ap.unknown_templates(ap.pending_approvals(rows, RULES), RULES).collect()
    assert {r.template_id for r in found} == {0, 5}


def link(n: int) -> str:
    return f'=HYPERLINK("https://approvals.example.org/{n}", {n})'


def test_reconcile(spark):
    rows = extract(spark, *[{"approval_id": i} for i in (1, 2, 3, 4, 5)])
    report = ap.approval_report(ap.pending_approvals(rows, RULES), RULES)
    previous = spark.createDataFrame([
        (link(1), "NA", "1999", "RE", "second", 9.0, 12),
        (link(1), "AP", None, "SU", "first", 5.04, 8),
        (link(2), "EU", "2001", "SU", "unknown before", None, 9),
        (link(3), "EU", "2001", "SU", "raised", 4.9, 10),
        ("note", "EU", "2001", "SU", "no id", 1.0, 7),
        (link(77), "EU", "2001", "SU", "gone", 1.0, 11),
    ], rec.PREVIOUS_SCHEMA)
    final = {r.approval_id: r for r in rec.reconcile_report(report, previous).collect()}
    assert len(final) == 5
    one = final[1]
    assert (one.region, one.plan_year, one.request_type, one.clean_title, one.amount_mm) == (
        "AP", None, "SU", "first", 5.04)
    assert (one.new_entity, one.is_new_amount, one.new_amount_mm) == (False, "No", 5.0)
    assert one.need_by == dt.date(2001, 6, 20) and one.queue == "VP"
    assert (final[2].amount_mm, final[2].is_new_amount, final[2].new_amount_mm) == (None, "No", 5.0)
    assert (final[3].amount_mm, final[3].is_new_amount) == (4.9, "Yes")
    assert final[4].new_entity and final[4].clean_title == "ABC1  " and final[4].is_new_amount == "No"
    assert {r.approval_id for r in rec.new_entities(report, previous).collect()} == {4, 5}
    changes = {r.approval_id: r.is_new_amount for r in rec.amount_changes(report, previous).collect()}
    assert changes == {1: False, 2: False, 3: True}


def test_reconcile_with_hot_previous_key(spark):
    """A third of the previous rows are one request, a third hold no id."""
    rows = extract(spark, {"approval_id": 1}, {"approval_id": 2})
    report = ap.approval_report(ap.pending_approvals(rows, RULES), RULES)
    previous = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, link(1)).when(F.col("id") % 3 == 1, "note")
        .otherwise(F.format_string('=HYPERLINK("https://x/%d", %d)', F.col("id") + 10, F.col("id") + 10))
        .alias("approval_link"),
        *[F.lit("x").alias(c) for c in ("region", "plan_year", "request_type")],
        F.col("id").cast("string").alias("clean_title"), F.lit(1.0).alias("amount_mm"), F.col("id").alias("row_pos"),
    )
    final = {r.approval_id: r for r in rec.reconcile_report(report, previous).collect()}
    assert len(final) == 2
    assert final[1].clean_title == "0" and final[2].new_entity

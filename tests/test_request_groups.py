"""Approver sets of a request: one set in the aggregate, cut by action afterwards."""

from __future__ import annotations

import datetime as dt

from gapledger.config import ACTION_COLUMNS, ApprovalRules
from gapledger.plans import approvals as ap

RULES = ApprovalRules(as_of_time=dt.datetime(2001, 6, 20, 9, 0))


def _pending(spark):
    lines = [
        ("Pending", "B"), ("Pending", "A"), ("Pending", "A"), ("Pending", None), ("Approved", "A"), (None, "C"),
        ("Rejected", "D"), ("Approved with condition", "E"),
    ]
    rows = [(1, 0, "one", "01-02-2001 05:00:00", d, a) for d, a in lines] + [(2, 0, "two", None, None, None)]
    return spark.createDataFrame(
        rows, "approval_id long, template_id int, title string, needed_on string, decision string, approver string"
    )


def test_sets_by_action(spark):
    rows = {r["approval_id"]: r for r in ap.request_groups(_pending(spark), RULES).collect()}
    of = lambda i: {c: rows[i][c] for c in ACTION_COLUMNS.values()}
    assert of(1) == {"pending": ["A", "B"], "pending_in_future": [], "approved": ["A"], "approved_with_condition": ["E"]}
    assert of(2) == dict.fromkeys(ACTION_COLUMNS.values(), [])


def test_one_set_is_collected(spark):
    groups = ap.request_groups(_pending(spark), RULES).select("approval_id", *ACTION_COLUMNS.values())
    assert groups._jdf.queryExecution().optimizedPlan().toString().count("collect_set(") == 1


def test_a_sort_does_not_repeat_the_groups(spark, monkeypatch):
    """Range sorts read their input twice; it has to be a table then."""
    sorted_plans = []

    def number(df, order_by, name):
        sorted_plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return df.withColumn(name, ap.F.lit(1))

    monkeypatch.setattr(ap, "number_rows", number)
    ap.approval_report(_pending(spark), RULES)
    assert "Aggregate" not in sorted_plans[0]

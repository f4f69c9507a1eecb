"""Physical plans: shuffles, push-down, code size, nothing on Python workers."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from gapledger.plans import approvals as ap
from gapledger.plans import issues as iss
from gapledger.plans import reconcile as rec
from gapledger.sources.fixtures import APPROVAL_RULES, ISSUE_RULES, view


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    """Shuffles of the initial plan; broadcasts do not count."""
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange (?:hash|range|Single|RoundRobin)", plan_of(df)))


@pytest.fixture(scope="module")
def issue_tables(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    for table in ("issues", "folders", "team", "sprints", "approvals"):
        view(spark, sf_dir, f"fx_{table}").write.parquet(f"{folder}/{table}")
    return lambda table: spark.read.parquet(f"{folder}/{table}")


@pytest.mark.parametrize("name", sorted(entry._report_queries()))
def test_no_python_and_no_pairing(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    for bad in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_rollup_takes_one_shuffle(issue_tables):
    pending = ap.pending_approvals(issue_tables("approvals"), APPROVAL_RULES)
    for df in (
        ap.needed_by_rollup(pending), ap.actions_pivot(pending), ap.approval_rollup(pending, APPROVAL_RULES),
        ap.approver_checklist(pending, APPROVAL_RULES), ap.unnumbered_report(pending, APPROVAL_RULES),
    ):
        assert exchanges(df) == 1


def test_checklist_keeps_no_sets(issue_tables):
    pending = ap.pending_approvals(issue_tables("approvals"), APPROVAL_RULES)
    plan = plan_of(ap.approver_checklist(pending, APPROVAL_RULES))
    assert "collect_set" not in plan and "ObjectHashAggregate" not in plan


def test_filters_and_columns_reach_the_scan(issue_tables, settings):
    # Plans are printed in full, not cut after a hundred characters.
    settings(spark__sql__maxMetadataStringLength="2000")
    plan = iss.bug_gap_rows(issue_tables("issues"), issue_tables("team"), ISSUE_RULES)
    text = plan._jdf.queryExecution().toString()
    pushed = re.findall(r"PushedFilters: \[([^\]]*)", text)[0]
    assert "assignedfolderid" in pushed and "status" in pushed
    assert "GreaterThan(resolveddate,1996-10-01)" in pushed
    schema = re.findall(r"ReadSchema: struct<([^>]*)", text)[0]
    assert "createdate" not in schema and "parenttaskids" not in schema and "issueid" not in schema

    gaps = iss.sprint_gaps(issue_tables("issues"), issue_tables("sprints"), ISSUE_RULES)
    simple = gaps._jdf.queryExecution().toString()
    assert "IsNull(parenttaskids)" in simple
    assert exchanges(gaps) == 0

    pending = ap.pending_approvals(issue_tables("approvals"), APPROVAL_RULES)
    assert "EqualTo(status,Pending)" in pending._jdf.queryExecution().toString()


def test_unknown_sizes_are_not_forced_to_broadcast(issue_tables, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    gaps = iss.bug_gap_rows(issue_tables("issues"), issue_tables("team"), ISSUE_RULES)
    assert "BroadcastHashJoin" not in plan_of(gaps)
    assert re.search(r"SortMergeJoin \[assignee#\d+, _spread#\d+L\]", plan_of(gaps))


def test_both_forms_of_the_gap_report_scatter_rows_without_assignee(issue_tables, settings):
    settings(spark__sql__maxMetadataStringLength="2000")
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    tables = issue_tables("issues"), issue_tables("team")
    text = entry._named_gaps(*tables)
    built = iss.resolved_bug_gaps(*tables, ISSUE_RULES)
    assert re.search(r"SortMergeJoin \[assignee#\d+, spread#\d+L\]", plan_of(text))
    assert exchanges(text) == exchanges(built) == 4
    assert "GreaterThan(resolveddate,1996-10-01)" in text._jdf.queryExecution().toString()


def test_each_side_of_the_reconciling_join_has_its_own_shuffle(spark, sf_dir, issue_tables, settings):
    """What adaptive skew handling needs, although the previous side was grouped."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    pending = ap.pending_approvals(issue_tables("approvals"), APPROVAL_RULES)
    joined = rec.matched_report(
        ap.unnumbered_report(pending, APPROVAL_RULES), view(spark, sf_dir, "fx_previous_report")
    )
    lines = [re.sub(r"^[\s:+-]*(\*\(\d+\) )?", "", line) for line in plan_of(joined).splitlines()]
    after_sort = [lines[i + 1] for i, line in enumerate(lines) if line.startswith("Sort [") and "_spread" in line]
    assert len(after_sort) == 2 and all(line.startswith("Exchange hashpartitioning") for line in after_sort)


def test_generated_methods_stay_compilable(spark, issue_tables, settings, tmp_path):
    """HotSpot leaves methods above 8000 bytes of bytecode interpreted. The report
    runs as two stages, before and after its sort."""
    settings(spark__sql__adaptive__enabled="false")
    pending = ap.pending_approvals(issue_tables("approvals"), APPROVAL_RULES)
    ap.with_sort_facts(ap.awaited_requests(pending, APPROVAL_RULES), APPROVAL_RULES).write.parquet(
        str(tmp_path / "sorted")
    )
    plans = {
        "sort facts": ap.with_sort_facts(pending, APPROVAL_RULES),
        "roll-up": ap.approval_rollup(pending, APPROVAL_RULES),
        "report after the sort": ap._shown(spark.read.parquet(str(tmp_path / "sorted")), APPROVAL_RULES),
        "gaps": iss.bug_gap_rows(issue_tables("issues"), issue_tables("team"), ISSUE_RULES),
    }
    largest = {}
    for name, df in plans.items():
        code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(
            df._jdf.queryExecution().executedPlan()
        )
        largest[name] = max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code))
    assert {n: size for n, size in largest.items() if size >= 8000} == {}, largest

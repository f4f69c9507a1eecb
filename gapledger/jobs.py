"""The two scheduled runs: daily issue digest, weekly approval report.

Each takes frames and rules, writes its tables as one run, publishes them in one step and
returns nothing to the driver but the folder names. ``sources.publishing`` reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapledger.config import ApprovalRules, IssueRules
from gapledger.functions.dates import data_cut_label
from gapledger.plans import approvals, issues, reconcile
from gapledger.sources.extracts import DAMAGED
from gapledger.sources.publishing import latest_published, publish_run
from gapledger.staging import discarding, staged


def run_issue_digest(issue_table: DataFrame, team: DataFrame, rules: IssueRules, folder: str) -> dict[str, str]:
    """Write gaps, recipient lists, cell flags, digest pages and run status.

    All outputs share the gap rows, which are therefore worked out once. What is staged
    for them goes when they are written.
    """
    with discarding(issue_table.sparkSession):
        gaps = staged(issues.bug_gap_rows(issue_table, team, rules))
        outputs = {
            "gaps": gaps.orderBy(*issues.report_order()),
            "to_list": issues.bug_gap_to_list(gaps, rules),
            "cc_list": issues.bug_gap_cc_list(gaps, rules),
            "cell_flags": issues.bug_gap_cell_flags(gaps, rules),
            "digest": issues.bug_gap_digest(gaps, rules),
            "status": issues.bug_gap_run_status(gaps, rules),
        }
        return publish_run(issue_table.sparkSession, folder, rules.as_of, outputs)


def run_approval_report(
    extract: DataFrame,
    rules: ApprovalRules,
    folder: str,
    previous: DataFrame | None = None,
    template: str | None = None,
    names: dict[str, str] | None = None,
    damaged: DataFrame | None = None,
) -> dict[str, str]:
    """Write the reconciled report of ``rules.as_of``, the templates not known yet, the
    data-cut label with what went into it, and the damaged lines of the extract.

    ``damaged`` are lines that the reader has set aside (``read_damaged_csv``); they are
    published beside the report, and counted in ``data_cut``.
    ``previous`` is the last report as edited by hand (with ``row_pos``); without
    it the latest report published in the folder for an earlier date stands in. ``template`` and ``names`` are those
    of ``pending_approvals``.
    """
    spark = extract.sparkSession
    pending = approvals.pending_approvals(extract, rules, template, names)
    if previous is None and (stored := latest_published(spark, folder, "report", rules.as_of)) is not None:
        previous = stored.withColumnRenamed("row_number", "row_pos")
    if previous is None:
        previous = spark.createDataFrame([], reconcile.PREVIOUS_SCHEMA)
    if damaged is None:
        damaged = spark.createDataFrame([], f"source_file string, {DAMAGED} string")
    cut = pending.agg(F.count(F.lit(1)).alias("row_count"))
    set_aside = damaged.agg(F.count(F.lit(1))).scalar()
    with discarding(spark):
        return publish_run(spark, folder, rules.as_of, {
            "report": lambda: reconcile.reconcile_report(approvals.approval_report(pending, rules), previous),
            "unknown_templates": approvals.unknown_templates(pending, rules),
            "data_cut": cut.select(
                data_cut_label(rules.as_of_time).alias("label"), "row_count", set_aside.alias("damaged_count")
            ),
            "damaged": damaged,
        }, ordered={"report": "row_number"})

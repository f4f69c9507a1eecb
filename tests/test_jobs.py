"""Both scheduled runs end to end on the fixture views."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from pathlib import Path

from pyspark.sql import functions as F

from gapledger import jobs
from gapledger.plans import approvals as ap
from gapledger.plans import issues as iss
from gapledger.sources.fixtures import APPROVAL_RULES, ISSUE_RULES, view
from gapledger.staging import staging_folder


def test_issue_digest_run(spark, sf_dir, tmp_path):
    issues, team = view(spark, sf_dir, "fx_issues"), view(spark, sf_dir, "fx_team")
    paths = jobs.run_issue_digest(issues, team, ISSUE_RULES, str(tmp_path))
    rows = {name: spark.read.parquet(path) for name, path in paths.items()}
    gaps = iss.resolved_bug_gaps(issues, team, ISSUE_RULES)
    assert rows["gaps"].count() == gaps.count() == rows["cell_flags"].count() == rows["status"].first().row_count
    assert rows["digest"].agg(F.sum("row_count")).first()[0] == gaps.count()
    assert rows["digest"].filter("manager_email IS NULL").count() > 0
    assert {r.report_date for r in rows["to_list"].select("report_date").collect()} == {ISSUE_RULES.as_of}


def test_issue_digest_rerun_without_gaps_leaves_nothing_of_the_former(spark, sf_dir, tmp_path):
    issues, team = view(spark, sf_dir, "fx_issues"), view(spark, sf_dir, "fx_team")
    folder = Path(staging_folder(spark))
    before = set(folder.rglob("*"))
    jobs.run_issue_digest(issues, team, ISSUE_RULES, str(tmp_path))
    paths = jobs.run_issue_digest(issues.filter("status = 'Open'"), team, ISSUE_RULES, str(tmp_path))
    rows = {name: spark.read.parquet(path) for name, path in paths.items()}
    assert {name: df.count() for name, df in rows.items()} == {
        "gaps": 0, "to_list": 0, "cc_list": 1, "cell_flags": 0, "digest": 0, "status": 1}
    assert rows["status"].first().is_empty
    assert set(folder.rglob("*")) == before


def test_approval_runs_follow_each_other(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "reports")
    store = f"{folder}/report"
    extract = view(spark, sf_dir, "fx_approvals")
    early = extract.filter("approval_id < 700")
    first = replace(APPROVAL_RULES, as_of_time=dt.datetime(2001, 6, 13, 9))
    jobs.run_approval_report(early, first, folder)
    jobs.run_approval_report(extract, APPROVAL_RULES, folder)
    paths = jobs.run_approval_report(extract, APPROVAL_RULES, folder)
    stored = spark.read.parquet(store)
    days = {r.report_date: r["count"] for r in stored.groupBy("report_date").count().collect()}
    assert set(days) == {first.as_of, APPROVAL_RULES.as_of}
    old = stored.filter(F.col("report_date") == F.lit(first.as_of))
    assert old.filter("NOT new_entity").count() == 0
    new = stored.filter(F.col("report_date") == F.lit(APPROVAL_RULES.as_of))
    assert new.filter("NOT new_entity").count() == old.count()
    assert new.filter("approval_id < 700 AND new_entity").count() == 0
    assert new.filter("is_new_amount = 'Yes'").count() == 0
    numbers = [r.row_number for r in new.select("row_number").orderBy("row_number").collect()]
    assert numbers == list(range(1, len(numbers) + 1))
    pending = ap.pending_approvals(extract, APPROVAL_RULES)
    unknown = ap.unknown_templates(pending, APPROVAL_RULES)
    written = spark.read.parquet(paths["unknown_templates"]).filter(F.col("report_date") == F.lit(APPROVAL_RULES.as_of))
    assert sorted(r.template_id for r in written.collect()) == sorted(r.template_id for r in unknown.collect())
    cut = spark.read.parquet(paths["data_cut"]).filter(F.col("report_date") == F.lit(APPROVAL_RULES.as_of)).first()
    assert (cut.label, cut.row_count) == ("Data cut on 2001-06-20 at 09 AM", pending.count())


def test_approval_run_of_one_template_with_other_headings(spark, sf_dir, tmp_path):
    extract = view(spark, sf_dir, "fx_approvals").withColumnsRenamed({"needed_on": "Needed By"})
    paths = jobs.run_approval_report(
        extract, APPROVAL_RULES, str(tmp_path), template="eu_real_estate", names={"Needed By": "needed_on"}
    )
    found = spark.read.parquet(paths["report"]).select("template_id").distinct().collect()
    assert [r.template_id for r in found] == [APPROVAL_RULES.template_ids["eu_real_estate"]]

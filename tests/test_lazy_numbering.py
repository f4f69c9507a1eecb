"""Row numbers from counts of the leading keys: the same numbers, and no job before the caller's."""

from __future__ import annotations

import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F

from gapledger.operators.numbering import number_rows, number_rows_lazily
from gapledger.plans import approvals as ap
from gapledger.plans import issues as iss
from gapledger.plans import reconcile as rec
from gapledger.sources.fixtures import APPROVAL_RULES, ISSUE_RULES, view


def rows(spark, n=20_000):
    """A third of the rows in one cell; nulls in every sort column."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("q"), F.col("id") % 5)).alias("q"),
        F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(3))).alias("r"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5_000)) - 2_500).alias("v"), "id",
    ).repartition(6)


LEADING = {"q": Column.desc, "r": Column.asc_nulls_last}


def order():
    return [F.col("v").asc(), F.col("id").asc()]


@pytest.mark.parametrize("split,parts", [(None, 64), ("v", 64), ("v", 1), ("v", 1_000)])
def test_numbers_follow_the_order(spark, split, parts):
    df = rows(spark)
    whole = [*[sort(F.col(k)) for k, sort in LEADING.items()], *order()]
    want = {r.id: r.n for r in number_rows(df, whole, "n").collect()}
    found = number_rows_lazily(df, LEADING, order(), "n", split, parts)
    assert found.columns == [*df.columns, "n"]
    assert {r.id: r.n for r in found.collect()} == want
    assert sorted(want.values()) == list(range(1, 20_001))


def test_a_large_cell_is_cut(spark, settings):
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="32")
    df = rows(spark).withColumns({"q": F.when(F.col("id") >= 0, "one"), "r": F.when(F.col("id") >= 0, 1)})

    def per_task(found):
        return [r["count"] for r in found.filter("n > 0").groupBy(F.spark_partition_id()).count().collect()]

    cut = per_task(number_rows_lazily(df, LEADING, order(), "n", "v"))
    assert sum(cut) == 20_000 and len(cut) > 15 and max(cut) < 20_000 / 5
    assert per_task(number_rows_lazily(df, LEADING, order(), "n")) == [20_000]


def test_extreme_and_equal_values(spark):
    values = [-(2**63), 2**63 - 1, 0, 0, None, 5]
    df = spark.createDataFrame([("a", 1, v, i) for i, v in enumerate(values)], "q string, r int, v long, id long")
    found = number_rows_lazily(df, LEADING, order(), "n", "v")
    assert [r.id for r in found.orderBy("n").collect()] == [4, 0, 2, 3, 5, 1]
    assert number_rows_lazily(df.limit(0), LEADING, order(), "n", "v").collect() == []


def test_no_job_runs_while_the_reports_are_planned(spark, sf_dir):
    pending = ap.pending_approvals(view(spark, sf_dir, "fx_approvals"), APPROVAL_RULES)
    gaps = iss.bug_gap_rows(view(spark, sf_dir, "fx_issues"), view(spark, sf_dir, "fx_team"), ISSUE_RULES)
    previous = view(spark, sf_dir, "fx_previous_report")
    context = spark.sparkContext
    jobs = lambda group: len(context.statusTracker().getJobIdsForGroup(group))
    for group, lazy in (("eager", False), ("lazy", True)):
        context.setJobGroup(group, group)
        report = ap.approval_report(pending, APPROVAL_RULES, lazy=lazy)
        rec.reconcile_report(report, previous)
        to_list = iss.bug_gap_to_list(gaps, ISSUE_RULES, lazy=lazy)
        assert (jobs(group) > 0) is (not lazy)
        numbers = {r.approval_id: r.row_number for r in report.select("approval_id", "row_number").collect()}
        people = sorted(tuple(r) for r in to_list.collect())
        if lazy:
            assert (numbers, people) == before
        before = numbers, people
        assert jobs(group) > 0
    context.setLocalProperty("spark.jobGroup.id", None)

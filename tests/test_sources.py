"""Readers, snapshots, named SQL."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gapledger.plans import reconcile as rec
from gapledger.sources import extracts, snapshots, warehouse
from gapledger.sources.fixtures import view
from gapledger.sources.named_sql import query_text, run_named_query
from gapledger.staging import discarding, staged, staging_folder


def test_csv_extract(spark, tmp_path):
    text = (
        "approval_id,title,needed_on,decision,approver,status,template_id,role\n"
        '1,"EU, ""big"" site\nsecond line",12-01-2022 05:00:00,Pending,"Lead, A",Pending,7394,APPROVER\n'
        "2,plain,,,,Pending,,\n"
    )
    (tmp_path / "a.csv").write_text(text)
    rows = extracts.read_approvals_csv(spark, str(tmp_path / "a.csv"), multi_line=True).orderBy("approval_id").collect()
    assert rows[0].title == 'EU, "big" site\nsecond line' and rows[0].approver == "Lead, A"
    assert rows[0].template_id == 7394 and rows[1].decision is None and rows[1].template_id is None
    (tmp_path / "b.csv").write_text("approval_id,wrong\n1,x\n")
    with pytest.raises(Exception):
        extracts.read_approvals_csv(spark, str(tmp_path / "b.csv")).collect()
    with pytest.raises(Exception):
        extracts.read_approvals_csv(spark, str(tmp_path / "a.csv")).collect()
    slim = extracts.approval_schema(with_template=False, with_role=False)
    assert "role" not in slim.names and "template_id" not in slim.names


def test_issue_tables_from_files(spark, sf_dir, tmp_path):
    for table in warehouse.TABLES:
        view(spark, sf_dir, f"fx_{table}").write.parquet(str(tmp_path / table))
    tables = warehouse.read_issue_tables(spark, str(tmp_path))
    assert tables["issues"].count() == view(spark, sf_dir, "fx_issues").count()


def test_jdbc_options(spark):
    """No database can be started here, so only the options are tested."""
    source = warehouse.JdbcSource("jdbc:example://host/db", {"driver": "x.Driver"})
    assert source.reader_options() == {"fetchsize": "10000", "driver": "x.Driver"}
    with pytest.raises(ValueError):
        warehouse.read_jdbc(spark, source, "issues")


def test_jdbc_predicates_hold_every_row_once(spark):
    values = [None, "", "2000-12-31", "2001-01-01", "2001-06-30T10", "2002-01-01", "o'x", "z"]
    rows = spark.createDataFrame([(v,) for v in values], "d string")
    predicates = warehouse.range_predicates("d", ["2002-01-01", "2001-01-01", "o'x", "2001-01-01"])
    assert len(predicates) == 4
    parts = [[r.d for r in rows.filter(p.replace("''", "\\'")).collect()] for p in predicates]
    assert sorted(str(v) for part in parts for v in part) == sorted(map(str, values))
    with pytest.raises(ValueError):
        warehouse.range_predicates("d", [])


def test_previous_report_readers(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "1,Weekly report,,,,,\n2,Link,Region,Year,Type,Title,Amount\n"
        '3,"=HYPERLINK(""https://a.example.org/5"", 5)",EU,2001,SU,first,1.5\n'
        '4,"=HYPERLINK(""https://a.example.org/5"", 5)",NA,2001,RE,second,2.5\n'
    )
    rows = extracts.read_previous_csv(spark, str(tmp_path / "p.csv"))
    assert [tuple(r) for r in rec.previous_by_request(rows).select("approval_id", "clean_title", "amount_mm").collect()] \
        == [(5, "first", 1.5)]
    rows.drop("row_pos").coalesce(1).sortWithinPartitions("clean_title").write.parquet(str(tmp_path / "p"))
    again = extracts.read_previous_parquet(spark, str(tmp_path / "p")).orderBy("row_pos").collect()
    assert [r.row_pos for r in again] == [0, 1, 2, 3] and [r.clean_title for r in again][2:] == ["first", "second"]


def test_long_ids_of_the_previous_report_do_not_end_the_run(spark):
    report = spark.createDataFrame([(5, "t")], "approval_id int, original_title string")
    link = "=HYPERLINK(\"https://a.example.org/x\", {})"
    previous = spark.createDataFrame(
        [(link.format(5), "EU", "2001", "SU", "c", 1.0, 1), (link.format(5 + 2**40), "NA", "2001", "SU", "d", 1.0, 2)],
        rec.PREVIOUS_SCHEMA,
    )
    matched = rec.matched_report(report, previous)
    assert [(r.approval_id, r.prev_region) for r in matched.collect()] == [(5, "EU")]
    assert matched.schema["approval_id"].dataType.simpleString() == "int"
    assert rec.new_entities(report, previous).count() == 0


def test_rerun_without_rows_replaces_its_date_only(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = spark.range(5).withColumnRenamed("id", "row_number")
    days = [dt.date(2022, 11, 16), dt.date(2022, 11, 23)]
    for day in days:
        snapshots.write_snapshot(rows, path, day)
    for none in (rows.filter("row_number < 0"), spark.createDataFrame([], rows.schema)):
        snapshots.write_snapshot(none, path, days[1], "row_number")
        stored = spark.read.parquet(path)
        assert {r.report_date: r["count"] for r in stored.groupBy("report_date").count().collect()} == {days[0]: 5}
    snapshots.write_snapshot(rows.filter("row_number < 0"), str(tmp_path / "new"), days[0])
    assert spark.read.parquet(str(tmp_path / "new")).count() == 0
    snapshots.write_snapshot(rows, path, days[1])
    assert spark.read.parquet(path).count() == 10


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "report")
    days = [dt.date(2022, 11, 16), dt.date(2022, 11, 23), dt.date(2022, 12, 1)]
    for n, day in enumerate(days):
        snapshots.write_snapshot(spark.range(n + 1).withColumnRenamed("id", "row_number"), path, day, "row_number")
    snapshots.write_snapshot(spark.range(5).withColumnRenamed("id", "row_number"), path, days[1])
    stored = spark.read.parquet(path)
    counts = {r.report_date: r["count"] for r in stored.groupBy("report_date").count().collect()}
    assert counts == dict(zip(days, (1, 5, 3)))
    assert snapshots.read_snapshot(spark, path, days[2]).count() == 3
    latest = snapshots.latest_snapshot(stored, days[2])
    assert {r.report_date for r in latest.collect()} == {days[1]} and latest.count() == 5
    assert snapshots.latest_snapshot(stored, days[0]).count() == 0
    # The date test is a partition filter: other runs' files are not read.
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_date" in plan


def test_positions_for_a_report_without_them(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "t string")
    found = extracts.positioned(df, [F.col("t").asc()])
    assert sorted(tuple(r) for r in found.collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_named_query_from_a_folder(spark, tmp_path):
    (tmp_path / "big.sql").write_text("SELECT id FROM {rows} WHERE id > :least")
    found = run_named_query(spark, "big", {"least": 7}, {"rows": spark.range(10)}, tmp_path)
    assert [r.id for r in found.collect()] == [8, 9]
    assert "SELECT" in query_text("resolved_bug_gaps")


def test_staged_tables_go_with_their_block(spark):
    folder = Path(staging_folder(spark))
    before = set(folder.rglob("*"))
    with discarding(spark):
        assert staged(spark.range(3)).count() == 3
        assert len(set(folder.rglob("*.parquet")) - before) > 0
    assert set(folder.rglob("*")) == before
    with pytest.raises(RuntimeError):
        with discarding(spark):
            staged(spark.range(3))
            raise RuntimeError
    assert set(folder.rglob("*")) == before

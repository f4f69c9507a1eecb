"""Every registered query against its SQL twin, rows and types."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import duck, rows_of_duck, rows_of_spark

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE",
}


# The queries of the optional subpackage have tests of their own.
REPORTS = sorted(entry._report_queries())


def test_every_report_query_has_an_oracle():
    assert set(REPORTS) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", REPORTS)
def test_query_matches_oracle(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    sql = entry.oracle_sql()[name]
    expected_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == expected_types
    columns, rows = rows_of_spark(df)
    expected_columns, expected = rows_of_duck(con, sql)
    assert columns == expected_columns
    assert rows == expected
    assert rows


def test_entry_is_lazy_and_has_rows(spark):
    assert entry.entry(spark).count() > 0

"""Run a query on Spark and its SQL twin on DuckDB and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if (Path(sf_dir) / f"{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r))


def rows_of_spark(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _sorted_rows(df.columns, df.collect())


def rows_of_duck(con, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), _sorted_rows(columns, cursor.fetchall())

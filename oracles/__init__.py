"""Independent DuckDB SQL for every registered query."""

from __future__ import annotations


def oracle_texts() -> dict[str, str]:
    from oracles import approval_sql, issue_sql

    return issue_sql.texts() | approval_sql.texts()

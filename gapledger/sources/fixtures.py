"""Issue and approval tables derived from the star-schema test tables.

One text per view, valid in Spark SQL and in DuckDB: ``{orders}`` and the like
stand for the source tables. Every view covers its whole source table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from gapledger.config import ApprovalRules, IssueRules

AS_OF = dt.date(2001, 6, 20)
ISSUE_RULES = IssueRules(as_of=AS_OF, cutoff=dt.date(1996, 10, 1), page_rows=20)
APPROVAL_RULES = ApprovalRules(as_of_time=dt.datetime(2001, 6, 20, 9, 0))

# Two sprints a month, running from the 1st to the 12th and the 16th to the 27th.
SPRINTS = """
SELECT 'S' || CAST((y - 2001) * 24 + (m - 1) * 2 + h + 2 AS VARCHAR(9)) AS sprint_id,
       CAST(y AS VARCHAR(9)) || '-' || lpad(CAST(m AS VARCHAR(9)), 2, '0')
         || CASE h WHEN 0 THEN '-01T09:00:00' ELSE '-16T09:00:00' END AS start_date,
       CAST(y AS VARCHAR(9)) || '-' || lpad(CAST(m AS VARCHAR(9)), 2, '0')
         || CASE h WHEN 0 THEN '-12T17:00:00' ELSE '-27T17:00:00' END AS end_date
FROM (SELECT DISTINCT EXTRACT(YEAR FROM o_orderdate) AS y, EXTRACT(MONTH FROM o_orderdate) AS m,
             CASE WHEN EXTRACT(DAY FROM o_orderdate) < 16 THEN 0 ELSE 1 END AS h
      FROM {orders}) halves
"""

FOLDERS = """
SELECT 'F' || CAST(r_regionkey AS VARCHAR(9)) AS assignedfolderid,
       CASE r_regionkey WHEN 0 THEN 'BUG' WHEN 1 THEN 'Access Request' WHEN 2 THEN 'Feature Request'
                        WHEN 3 THEN 'Epic' END AS folder_roll_up
FROM {region}
"""

# Some people have two managers, who then both stand beside their issues.
TEAM = """
SELECT 'user' || CAST(c_custkey AS VARCHAR(19)) AS alias,
       CASE WHEN c_custkey % 17 = 0 THEN NULL
            WHEN c_custkey % 10 = 0 THEN 'user' || CAST(c_custkey AS VARCHAR(19))
            ELSE 'mgr' || CAST(c_nationkey AS VARCHAR(9)) END AS manager,
       CASE WHEN c_custkey % 40 = 0 THEN NULL ELSE 'srmgr' || CAST(c_custkey % 3 AS VARCHAR(9)) END AS sr_manager
FROM {customer}
UNION ALL
SELECT 'user' || CAST(c_custkey AS VARCHAR(19)), 'mgr' || CAST((c_nationkey + 1) % 25 AS VARCHAR(9)), 'srmgr1'
FROM {customer} WHERE c_custkey % 7 = 3
"""

# Dated rows, as a store of weekly reports has them.
DATED_REPORTS = """
SELECT o_orderkey AS approval_id, o_orderpriority AS region,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS report_date
FROM {orders}
"""

ISSUES = """
SELECT CAST(k AS VARCHAR(19)) AS issueid, 'Issue <' || CAST(k AS VARCHAR(19)) || '> & more' AS title,
       'https://issues.example.org/' || CAST(k AS VARCHAR(19)) AS issueurl,
       'F' || CAST(k % 7 AS VARCHAR(9)) AS assignedfolderid,
       CASE WHEN k % 11 = 0 THEN NULL
            WHEN k % 12 = 1 THEN ' kerberos:guest' || CAST(c AS VARCHAR(19))
            ELSE ' kerberos:user' || CAST(c AS VARCHAR(19)) || '@CORP.EXAMPLE' END AS assigneeidentity,
       CASE st WHEN 'F' THEN 'Resolved' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS status,
       d AS createdate,
       CASE WHEN st = 'F' OR k % 3 = 0 THEN d END AS resolveddate,
       CASE WHEN k % 4 < 2 THEN NULL ELSE d END AS estimatedcompletiondate,
       CASE WHEN k % 5 = 0 THEN NULL ELSE d END AS actualstartdate,
       CASE WHEN k % 2 = 0 THEN NULL ELSE 'customer' END AS label_customer,
       CASE WHEN k % 3 = 1 THEN NULL ELSE 'product' END AS label_product,
       CASE WHEN k % 9 = 0 THEN 'execution' END AS label_execution,
       CASE WHEN k % 8 = 0 THEN 'planning' END AS label_planning,
       CASE WHEN k % 13 = 0 THEN NULL WHEN k % 13 = 1 THEN '' WHEN k % 13 < 6 THEN 'L1,S13'
            WHEN k % 13 < 8 THEN 'S130,L1' WHEN k % 13 < 10 THEN 'S1,L2,L3' ELSE 'S7,L1,L2,L3' END AS labelids,
       CASE WHEN k % 6 = 5 THEN NULL ELSE k % 6 END AS totaleffortspent,
       CASE WHEN k % 7 < 3 THEN 'config' END AS rootcauses,
       CASE WHEN k % 10 = 0 THEN NULL ELSE k % 10 END AS conversationcount,
       CASE WHEN k % 19 = 0 THEN NULL WHEN k % 19 < 4 THEN 'robot' ELSE 'user1' END AS last_comment_author,
       CASE WHEN k % 5 = 4 THEN 'P1' END AS parenttaskids
FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st,
             CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS d FROM {orders}) o
"""


# Title parts, picked by the remainders of the request id.
_TITLE_PARTS = (
    ("[EU] ", "NA ", "JP ", "MX ", "12 IN ", "AP ", "EC ", "zz "),
    (" 2001 ", "_2002_", "FY2003 ", "2000 2001 ", "undated "),
    ("ABC1 ARS4 ABC1 ", "XYZ9 LMN2 ", "", ""),
    ("ARS450 ", "IXD TSSL ", "Sort Center ", "", "", ""),
    (
        "Startup Supplemental &ndash; ", "Full Real Estate &amp; SU ", "Construction ", "Lease Renewal RE ",
        "bulk Initiative ", "Initial Full Startup RE ", "Reallocation ",
    ),
    (
        "$5MM", "($1,5M)", "$ 250K", "$1,234,567", "$1,234,", "$1.2.3M", "$1.2.3", "$", "$0.25M", "$750 total K",
        "$3 M", "no amount",
    ),
)


def _title_of(k: str) -> str:
    parts = [
        f"split_part('{'~'.join(texts)}', '~', CAST({k} % {len(texts)} + 1 AS INTEGER))" for texts in _TITLE_PARTS
    ]
    return f"CASE WHEN {k} % 29 <> 0 THEN {' || '.join(parts)} END"


def _template_of(k: str) -> str:
    return f"CASE {k} % 9 WHEN 0 THEN 7394 WHEN 1 THEN 37508 WHEN 2 THEN 39820 WHEN 3 THEN 39171 ELSE 0 END"


TITLES = f"""
SELECT o_orderkey AS approval_id, {_title_of("o_orderkey")} AS title, {_template_of("o_orderkey")} AS template_id
FROM {{orders}}
"""

# One need-by time per request, but for the few requests where lines disagree.
APPROVALS = f"""
SELECT l_orderkey AS approval_id, {_title_of("l_orderkey")} AS title,
  lpad(CAST(1 + l_orderkey % 12 AS VARCHAR(9)), 2, '0') || '-'
    || lpad(CAST(CASE WHEN l_orderkey % 50 = 7 AND l_linenumber < 4 THEN 28 ELSE 1 + l_orderkey % 27 END AS VARCHAR(9)), 2, '0')
    || '-' || CAST(1999 + l_orderkey % 4 AS VARCHAR(9))
    || CASE WHEN l_orderkey % 3 = 0 THEN ' 05:00:00' ELSE ' 15:30:00' END AS needed_on,
  CASE l_suppkey % 6 WHEN 0 THEN 'Approved' WHEN 1 THEN 'Approved with condition' WHEN 2 THEN 'Pending'
                     WHEN 3 THEN 'Pending in future' WHEN 4 THEN 'Rejected' END AS decision,
  CASE l_linenumber WHEN 1 THEN 'Lead, A' WHEN 2 THEN 'Lead, B' WHEN 3 THEN 'Lead, C' WHEN 4 THEN 'Finance, D'
                    ELSE 'Other, ' || CAST(l_partkey % 40 AS VARCHAR(9)) END AS approver,
  CASE WHEN l_orderkey % 4 = 3 THEN 'Closed' ELSE 'Pending' END AS status,
  {_template_of("l_orderkey")} AS template_id,
  CASE WHEN l_partkey % 5 = 0 THEN 'OBSERVER' ELSE 'APPROVER' END AS role
FROM {{lineitem}}
"""

# The earlier report covers requests raised before 2000; urgent ones stand in it
# a second time, further down.
PREVIOUS_REPORT = """
SELECT CASE WHEN o_orderkey % 23 = 0 THEN 'see mail'
            ELSE '=HYPERLINK("https://approvals.example.org/' || CAST(o_orderkey AS VARCHAR(19)) || '", '
                 || CAST(o_orderkey AS VARCHAR(19)) || ')' END AS approval_link,
       'EU' AS region, '2001' AS plan_year, 'SU' AS request_type,
       'edited ' || CAST(o_orderkey AS VARCHAR(19)) AS clean_title,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 5.0E0
            WHEN o_orderkey % 5 = 2 THEN 1.25E0 ELSE 1.5E0 END AS amount_mm,
       o_orderkey + 7 AS row_pos
FROM {orders} WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
UNION ALL
SELECT '=HYPERLINK("https://approvals.example.org/' || CAST(o_orderkey AS VARCHAR(19)) || '", '
         || CAST(o_orderkey AS VARCHAR(19)) || ')', 'NA', NULL, 'RE', 'later ' || CAST(o_orderkey AS VARCHAR(19)),
       9.9E0, o_orderkey + 1000000000000
FROM {orders} WHERE o_orderpriority = '1-URGENT'
"""

VIEWS = {
    "fx_sprints": SPRINTS,
    "fx_folders": FOLDERS,
    "fx_team": TEAM,
    "fx_issues": ISSUES,
    "fx_titles": TITLES,
    "fx_approvals": APPROVALS,
    "fx_previous_report": PREVIOUS_REPORT,
    "fx_dated_reports": DATED_REPORTS,
}
SOURCES = ("orders", "region", "customer", "lineitem")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One view over the Parquet tables of a folder."""
    text = VIEWS[name]
    used = [s for s in SOURCES if f"{{{s}}}" in text]
    return spark.sql(text, **{s: spark.read.parquet(f"{sf_dir}/{s}.parquet") for s in used})


def cte(name: str) -> str:
    """The view as a common table expression over tables of the plain names."""
    return f"{name} AS ({VIEWS[name].format(**{s: s for s in SOURCES})})"

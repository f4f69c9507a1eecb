"""DuckDB twins of the issue queries."""

from __future__ import annotations

from gapledger.sources.fixtures import cte

AS_OF = "DATE '2001-06-20'"
DOMAIN = "'@example.org'"

BASE = """
base AS (
  SELECT *, trim(replace(replace(assigneeidentity, 'kerberos:', ''), '@CORP.EXAMPLE', '')) AS assignee,
         TRY_CAST(resolveddate[1:10] AS DATE) AS resolved_on,
         CASE WHEN labelids IS NULL THEN 0 ELSE length(labelids) - length(replace(labelids, ',', '')) + 1 END AS listed
  FROM fx_issues),
counted AS (
  SELECT *, CAST(listed - len(list_filter([label_customer, label_execution, label_planning, label_product],
                                     lambda x: x IS NOT NULL)) AS INTEGER) AS own_labels
  FROM base)"""

# Monday-based and Sunday-based week numbers, counted from a fixed Monday.
WEEKS = """
weeks AS (
  SELECT *, date_diff('day', resolved_on, {as_of}) AS days,
         CAST(floor(date_diff('day', DATE '1990-01-01', {as_of}) / 7.0)
            - floor(date_diff('day', DATE '1990-01-01', resolved_on) / 7.0) AS INTEGER) AS monday_weeks,
         CAST(floor((date_diff('day', DATE '1990-01-01', {as_of}) + 1) / 7.0)
            - floor((date_diff('day', DATE '1990-01-01', resolved_on) + 1) / 7.0) AS INTEGER) AS sunday_weeks
  FROM counted)""".format(as_of=AS_OF)

LABEL_GAPS = """
  CASE WHEN own_labels < 0 THEN 'No' ELSE coalesce(nullif(array_to_string(list_filter(
    [if(label_customer IS NULL, 'Customer', NULL), if(label_product IS NULL, 'Product', NULL),
     if(own_labels = 0, 'Sprint Tag', NULL)], lambda x: x IS NOT NULL), ', '), ''), 'No') END"""
DATE_GAPS = """
  coalesce(nullif(array_to_string(list_filter(
    [if(estimatedcompletiondate IS NULL, 'Estimated Completion Date', NULL),
     if(actualstartdate IS NULL, 'Actual Start Date', NULL)], lambda x: x IS NOT NULL), ', '), ''), 'No')"""

GAPS = f"""
gaps AS (
  SELECT DISTINCT * FROM (
    SELECT issueurl, title, assignee,
           if(m.alias IS NOT DISTINCT FROM m.manager, m.sr_manager, m.manager) || {DOMAIN} AS manager_email,
           {LABEL_GAPS} AS missing_labels, {DATE_GAPS} AS missing_dates,
           if(totaleffortspent = 0, 'Yes', 'No') AS missing_effort,
           if(rootcauses IS NULL, 'Yes', 'No') AS missing_root_cause,
           if(conversationcount IS NULL, 'Yes', 'No') AS missing_comments,
           CAST(days - 2 * monday_weeks AS INTEGER) AS business_days
    FROM weeks LEFT JOIN fx_team m ON m.alias = assignee
    WHERE assignedfolderid = 'F0' AND status = 'Resolved' AND last_comment_author NOT IN ('robot')
      AND resolved_on > DATE '1996-10-01')
  WHERE NOT (missing_labels = 'No' AND missing_dates = 'No' AND missing_effort = 'No'
             AND missing_root_cause = 'No' AND missing_comments = 'No'))"""

ORDER = """assignee NULLS LAST, business_days DESC, issueurl, title, manager_email NULLS FIRST, missing_labels,
  missing_dates, missing_effort, missing_root_cause, missing_comments"""

SPRINT = f"""
sprint AS (
  SELECT sprint_id, start_date, end_date FROM fx_sprints
  WHERE {AS_OF} >= CAST(start_date[1:10] AS DATE) AND {AS_OF} <= CAST(end_date[1:10] AS DATE) + 2
  ORDER BY start_date DESC, sprint_id LIMIT 1)"""


def _scope(member: str) -> str:
    return f"""
scoped AS (
  SELECT c.title, c.issueurl, c.assignee, c.label_customer IS NULL AS no_customer,
         estimatedcompletiondate IS NULL AND resolved_on IS NULL AND resolveddate IS NULL AND own_labels > 0
           AS no_completion
  FROM counted c CROSS JOIN sprint LEFT JOIN fx_folders f ON f.assignedfolderid = c.assignedfolderid
  WHERE parenttaskids IS NULL AND {member}
    AND coalesce(folder_roll_up, 'BUG') IN ('BUG', 'Access Request', 'Feature Request')),
short AS (SELECT * FROM scoped WHERE no_customer OR no_completion)"""


SUBSTRING_SCOPE = _scope("strpos(labelids, sprint_id) > 0")
EXACT_SCOPE = _scope("list_contains(string_split(labelids, ','), sprint_id)")

ISSUES = ",".join([cte("fx_issues"), BASE])
RESOLVED = ",".join([ISSUES, cte("fx_team"), WEEKS, GAPS])
SCOPED = ",".join([ISSUES, cte("fx_folders"), cte("fx_sprints"), SPRINT, SUBSTRING_SCOPE])
SCOPED_EXACT = ",".join([ISSUES, cte("fx_folders"), cte("fx_sprints"), SPRINT, EXACT_SCOPE])

MISSING_FIELDS = """
  SELECT DISTINCT title, assignee, issueurl, if(no_customer, 'Yes', 'No') AS missing_customer_label,
         if(no_completion, 'Yes', 'No') AS missing_completion_date FROM short"""


def _html(expression: str) -> str:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        expression = f"replace({expression}, '{raw}', '{entity}')"
    return expression


def _marked_cell(column: str) -> str:
    return f"if({column} = 'No', '<td>', '<td class=\"gap\">') || {_html(column)} || '</td>'"


DIGEST = f"""
  lines AS (
    SELECT manager_email, row_number() OVER (PARTITION BY manager_email ORDER BY {ORDER}) AS n,
           '<tr><td><a href="' || {_html('issueurl')} || '">' || {_html('title')} || '</a></td><td>'
             || coalesce({_html('assignee')}, '') || '</td>'
             || {_marked_cell('missing_labels')} || {_marked_cell('missing_dates')} || {_marked_cell('missing_effort')}
             || {_marked_cell('missing_root_cause')} || '<td>' || missing_comments || '</td></tr>' AS line
    FROM gaps)
  SELECT manager_email, CAST((n - 1) // 20 + 1 AS BIGINT) AS page, count(*) AS row_count,
         '<table><tr><th>Title</th><th>Assignee</th><th>Missing Label</th><th>Missing Date</th>'
         || '<th>Missing Effort Spent</th><th>Missing Root Cause</th><th>Missing Comments</th></tr>'
         || string_agg(line, '' ORDER BY n) || '</table>' AS html
  FROM lines GROUP BY manager_email, (n - 1) // 20"""


def texts() -> dict[str, str]:
    resolved = f"WITH {RESOLVED}"
    scoped = f"WITH {SCOPED}"
    issues = f"WITH {ISSUES}"
    all_gaps = f"{resolved} SELECT * FROM gaps ORDER BY {ORDER}"
    assignees = f"""{scoped} SELECT assignee, assignee || {DOMAIN} AS assignee_email
            FROM short WHERE assignee IS NOT NULL GROUP BY assignee"""
    listed = f"""{resolved}
            SELECT row_number() OVER (ORDER BY assignee) AS list_order, assignee || {DOMAIN} AS address
            FROM (SELECT DISTINCT assignee FROM gaps WHERE assignee IS NOT NULL)"""
    return {
        "resolved_bug_gaps": all_gaps,
        "named_resolved_bug_gaps": all_gaps,
        "resolved_bug_gaps_salted": all_gaps,
        "missing_mandatory_fields_salted": f"{scoped} {MISSING_FIELDS}",
        "assignee_recipients_salted": assignees,
        "current_sprint": f"""WITH {cte("fx_sprints")}, {SPRINT}
            SELECT sprint_id AS current_sprint_id, start_date AS current_sprint_start_date,
                   end_date AS current_sprint_end_date FROM sprint""",
        "missing_mandatory_fields": f"{scoped} {MISSING_FIELDS}",
        "missing_mandatory_fields_exact_label": f"WITH {SCOPED_EXACT} {MISSING_FIELDS}",
        "assignee_recipients": assignees,
        "manager_recipients": f"""{scoped}, {cte("fx_team")}
            SELECT DISTINCT CASE WHEN t.alias = t.manager THEN sr_manager ELSE t.manager END AS manager,
                   CASE WHEN t.alias = t.manager THEN sr_manager ELSE t.manager END || {DOMAIN} AS manager_email
            FROM short LEFT JOIN fx_team t ON t.alias = assignee WHERE t.manager IS NOT NULL""",
        "bug_gap_to_list": listed,
        "bug_gap_to_list_lazy": listed,
        "bug_gap_cc_list": f"""{resolved},
            sheet AS (SELECT manager_email, row_number() OVER (ORDER BY {ORDER}) AS n FROM gaps),
            listed AS (SELECT manager_email AS address, n FROM sheet WHERE manager_email IS NOT NULL
                       UNION ALL SELECT 'lead@example.org', 9000000000000000000)
            SELECT row_number() OVER (ORDER BY min(n)) AS list_order, address FROM listed GROUP BY address""",
        "bug_gap_cell_flags": f"""{resolved}
            SELECT issueurl, manager_email, missing_labels <> 'No' AS flag_missing_labels,
                   missing_dates <> 'No' AS flag_missing_dates, missing_effort <> 'No' AS flag_missing_effort,
                   missing_root_cause <> 'No' AS flag_missing_root_cause, FALSE AS flag_missing_comments FROM gaps""",
        "bug_gap_digest": f"{resolved}, {DIGEST}",
        "bug_gap_run_status": f"""{resolved}
            SELECT {AS_OF} AS as_of, count(*) AS row_count, count(*) = 0 AS is_empty FROM gaps""",
        "label_counts": f"""{issues}
            SELECT issueid, CAST(listed AS INTEGER) AS label_total, own_labels AS sprint_label_count FROM counted""",
        "missing_labels": f"{issues} SELECT issueid, {LABEL_GAPS} AS missing_labels FROM counted",
        "missing_dates": f"{issues} SELECT issueid, {DATE_GAPS} AS missing_dates FROM counted",
        "business_days": f"""{issues}, {WEEKS}
            SELECT issueid, CAST(days AS INTEGER) AS days, CAST(days - 2 * monday_weeks AS INTEGER) AS business_days,
                   CAST(days - 2 * sunday_weeks AS INTEGER) AS business_days_sunday FROM weeks""",
        "manager_rollup": f"""WITH {cte("fx_team")}
            SELECT alias, if(alias IS NOT DISTINCT FROM manager, sr_manager, manager) AS manager FROM fx_team""",
        "identity_clean": f"{issues} SELECT issueid, assignee FROM base",
    }

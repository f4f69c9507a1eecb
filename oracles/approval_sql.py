"""DuckDB twins of the approval, title and reconciliation queries."""

from __future__ import annotations

from gapledger import config
from gapledger.sources.fixtures import cte

YEARS = range(1999, 2006)


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


PENDING = """
pending_rows AS (
  SELECT * FROM fx_approvals
  WHERE status = 'Pending' AND role = 'APPROVER' AND decision IN ('Pending', 'Pending in future', 'Approved'))"""


def _people(condition: str) -> str:
    return (
        "coalesce(array_to_string(list_sort(list(DISTINCT approver) FILTER "
        f"(WHERE {condition} AND approver IS NOT NULL)), ' | '), '')"
    )


def _mark(person: str) -> str:
    return f"""CASE WHEN count(*) FILTER (WHERE approver = '{person}' AND decision LIKE 'Pending%') > 0 THEN ' '
      WHEN count(*) FILTER (WHERE approver = '{person}' AND decision LIKE 'Approved%') > 0 THEN chr(10003)
      ELSE 'NA' END"""


UTC = "try_strptime(needed_on, '%m-%d-%Y %H:%M:%S')"


# US Pacific by rule: seven hours behind UTC in summer time, else eight. Until
# 2006 summer time began on the first Sunday of April and ended on the last of
# October, at 02:00 local standard (10:00 UTC) and 02:00 summer time (09:00 UTC).
def _pacific_date(utc: str) -> str:
    april = f"make_date(CAST(year({utc}) AS INTEGER), 4, 1)"
    october = f"make_date(CAST(year({utc}) AS INTEGER), 10, 31)"
    begins = f"(CAST({april} + CAST((7 - dayofweek({april})) % 7 AS INTEGER) AS TIMESTAMP) + INTERVAL 10 HOUR)"
    ends = f"(CAST({october} - CAST(dayofweek({october}) AS INTEGER) AS TIMESTAMP) + INTERVAL 9 HOUR)"
    return f"""CAST(CASE WHEN {utc} >= {begins} AND {utc} < {ends} THEN {utc} - INTERVAL 7 HOUR
      ELSE {utc} - INTERVAL 8 HOUR END AS DATE)"""


def _rollup(keys: str = "approval_id, template_id, title") -> str:
    return f"""
requests AS (
  SELECT {keys},
         array_to_string(list_sort(list(DISTINCT needed_on)), ' | ') AS needed_by,
         count(DISTINCT needed_on) > 1 AS needed_by_conflict,
         min({UTC}) AS needed_by_utc,
         {_people("decision = 'Pending'")} AS pending,
         {_people("decision = 'Pending in future'")} AS pending_in_future,
         {_people("decision = 'Approved'")} AS approved,
         {_people("decision = 'Approved with condition'")} AS approved_with_condition,
         {_mark("Lead, A")} AS mark_a, {_mark("Lead, B")} AS mark_b, {_mark("Lead, C")} AS mark_c,
         {_mark("Finance, D")} AS mark_d
  FROM pending_rows WHERE title IS NOT NULL GROUP BY ALL),
awaited AS (
  SELECT *, if(contains(pending, 'Lead, A') OR contains(pending, 'Lead, B') OR contains(pending, 'Lead, C'),
               'VP', 'Pre-VP') AS queue
  FROM requests WHERE list_contains([mark_a, mark_b, mark_c, mark_d], ' '))"""


def _year_list(spelling: str) -> str:
    pairs = ", ".join(f"{{'y': '{y}', 'p': '{spelling.format(y)}'}}" for y in YEARS)
    found = f"list_filter([{pairs}], lambda e: contains(clean, e.p))"
    return f"nullif(array_to_string(list_transform({found}, lambda e: e.y), ', '), '')"


# Python-like number: null unless the whole text is one.
def _number(text: str) -> str:
    return (
        f"if(regexp_full_match({text}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'), "
        f"TRY_CAST({text} AS DOUBLE), NULL)"
    )


def _facts(source: str) -> str:
    """Title facts over a relation with title and template_id."""
    template_arms = " ".join(f"WHEN {t} THEN '{r}'" for t, r in config.REGION_OF_TEMPLATE.items())
    fold_arms = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in config.REGION_FOLD.items())
    rank_arms = " ".join(f"WHEN '{a}' THEN {b}" for a, b in config.REGION_RANK.items())
    return f"""
cleaned AS (
  SELECT *, replace(replace(replace(replace(title, '&ndash;', '-'), '&amp;', '&'), '[', ''), ']', '') AS clean
  FROM {source} WHERE title IS NOT NULL),
split AS (
  SELECT *, strpos(clean, '$') AS dollar,
         CASE WHEN strpos(clean, '$') > 0 THEN ltrim(clean[strpos(clean, '$') + 1:], ' ') ELSE '' END AS tail
  FROM cleaned),
tokens AS (
  SELECT *, replace(replace(string_split(tail, ' ')[1], ')', ''), '$', '') AS token FROM split),
measured AS (
  SELECT *, length(token) - strpos(reverse(token), ',') + 1 AS comma_at,
         strpos(token, ',') > 0 AS has_comma,
         if(strpos(token, ',') > 0, length(regexp_replace(string_split(token, ',')[-1], '[^0-9.]', '', 'g')), 99)
           AS after_comma
  FROM tokens),
trimmed AS (
  SELECT *, if(after_comma = 0, token[:comma_at - 1] || token[comma_at + 1:], token) AS token2 FROM measured),
repaired AS (
  SELECT *, if(after_comma < 3 AND strpos(token2, ',') > 0,
               token2[:length(token2) - strpos(reverse(token2), ',')] || '.'
                 || token2[length(token2) - strpos(reverse(token2), ',') + 2:], token2) AS amount_text
  FROM trimmed),
plain AS (
  SELECT *, {_number("replace(amount_text, ',', '')")} / 1000000 AS plain_mm FROM repaired),
amounts AS (
  SELECT *, CASE
      WHEN contains(amount_text, 'M') THEN {_number("replace(amount_text, 'M', '')")}
      WHEN contains(lower(amount_text), 'k') THEN {_number("replace(lower(amount_text), 'k', '')")} / 1000
      WHEN plain_mm < 10000 AND contains(tail, 'M') THEN plain_mm * 1000000
      WHEN plain_mm < 10000 AND contains(lower(tail), 'k') THEN plain_mm * 1000
      ELSE plain_mm END AS exact_mm
  FROM plain),
kinds AS (
  SELECT *, contains(lower(clean), 'startup') OR contains(clean, ' SU ') AS is_su,
         contains(lower(clean), 'real estate') OR contains(clean, ' RE ') AS is_re,
         coalesce(CASE template_id {template_arms} END, regexp_extract(clean, '(?s)[A-Za-z].?')) AS raw_region
  FROM amounts),
folded AS (
  SELECT *, coalesce(CASE raw_region {fold_arms} END, raw_region) AS folded_region FROM kinds),
ranked AS (
  SELECT *, if(folded_region IN ({", ".join(f"'{r}'" for r in config.REGION_RANK)}), folded_region, 'Check') AS region,
         coalesce({_year_list(" {} ")}, {_year_list("{} ")}, {_year_list("{}_")}, '') AS plan_year,
         CASE WHEN is_su THEN if(is_re, 'RE & SU', 'SU') WHEN is_re THEN 'RE'
              WHEN contains(lower(clean), 'construction') OR contains(clean, ' CN ') THEN 'RE'
              WHEN contains(lower(clean), 'initiative') THEN 'Initiative' END AS request_type,
         CAST(printf('%.1f', exact_mm) AS DOUBLE) AS amount_mm,
         array_to_string(list_filter({_list(config.BUILDING_TYPES)}, lambda b: contains(clean, b)), ' ') AS building_type,
         array_to_string(list_filter({_list(config.REQUEST_TYPES)}, lambda b: contains(clean, b)), ' and ') AS full_type,
         list_filter(regexp_extract_all(clean, '[A-Z][A-Z][A-Z][0-9]'),
                     lambda s: s[:3] NOT IN ('ARS', 'TNS')) AS site_list
  FROM folded),
facts AS (
  SELECT *, request_type IS NULL AS unrecognized,
         coalesce(CASE region {rank_arms} END, 9999) AS region_rank,
         array_to_string(list_filter(site_list, lambda s, i: list_position(site_list, s) = i), ', ') AS site,
         if(contains(lower(clean), 'bulk'), 'Bulk ', '')
           || array_to_string(list_filter(site_list, lambda s, i: list_position(site_list, s) = i), ', ')
           || ' ' || building_type || ' ' || full_type AS clean_title
  FROM ranked)"""


REPORT = f"""
dated AS (SELECT *, {_pacific_date("needed_by_utc")} AS need_by_date FROM facts),
report AS (
  SELECT row_number() OVER (ORDER BY queue DESC, request_type NULLS LAST, region_rank, plan_year, template_id,
                            approval_id, title) AS row_number,
         queue, region, plan_year, request_type, clean_title, amount_mm,
         strftime(need_by_date, '%d-%b, %Y') AS need_by, need_by_date, approval_id,
         '=HYPERLINK("https://approvals.example.org/' || approval_id || '", ' || approval_id || ')' AS approval_link,
         template_id, mark_a, mark_b, mark_c, mark_d, pending, pending_in_future, approved, approved_with_condition,
         site, building_type, full_type, unrecognized,
         TIMESTAMP '2001-06-20 09:00:00' > CAST(need_by_date AS TIMESTAMP) AS past_due,
         needed_by_conflict, clean AS original_title
  FROM dated)"""

PREVIOUS = """
linked AS (
  SELECT *, CAST(regexp_extract(approval_link, ', ([0-9]+)[)]', 1) AS BIGINT) AS request
  FROM fx_previous_report WHERE contains(approval_link, 'HYPERLINK')),
first_rows AS (
  SELECT * FROM linked l WHERE row_pos = (SELECT min(row_pos) FROM linked o WHERE o.request = l.request))"""

REPORT_COLUMNS = """row_number, queue, region, plan_year, request_type, clean_title, amount_mm, need_by, approval_id,
  approval_link, template_id, mark_a, mark_b, mark_c, mark_d, pending, pending_in_future, approved,
  approved_with_condition, site, building_type, full_type, unrecognized, past_due, needed_by_conflict,
  original_title"""

CHANGED = "CAST(printf('%.1f', r.amount_mm) AS DOUBLE) <> CAST(printf('%.1f', p.amount_mm) AS DOUBLE)"

APPROVALS = ",".join([cte("fx_approvals"), PENDING])
GROUPED = ",".join([APPROVALS, _rollup()])
REPORTED = ",".join([GROUPED, _facts("awaited"), REPORT])
RECONCILED = ",".join([REPORTED, cte("fx_previous_report"), PREVIOUS])
TITLED = ",".join([cte("fx_titles"), _facts("fx_titles")])


def _title_fact(column: str, alias: str | None = None) -> str:
    return f"WITH {TITLED} SELECT approval_id, {column} AS {alias or column} FROM facts"


def texts() -> dict[str, str]:
    grouped = f"WITH {GROUPED}"
    keys = "approval_id, template_id, title"
    need_by = _pacific_date(UTC)
    reconciled = f"WITH {RECONCILED}"
    everything = ", ".join(
        f"{_people_any(c)} AS {c}" for c in ("decision", "approver", "status", "role")
    )
    whole = f"""{reconciled}
        SELECT r.* EXCLUDE (region, plan_year, request_type, clean_title, amount_mm, need_by, need_by_date),
               r.need_by_date AS need_by,
               if(p.request IS NULL, r.region, p.region) AS region,
               if(p.request IS NULL, r.plan_year, p.plan_year) AS plan_year,
               if(p.request IS NULL, r.request_type, p.request_type) AS request_type,
               if(p.request IS NULL, r.clean_title, p.clean_title) AS clean_title,
               if(p.request IS NULL, r.amount_mm, p.amount_mm) AS amount_mm,
               p.request IS NULL AS new_entity,
               if(coalesce({CHANGED}, FALSE), 'Yes', 'No') AS is_new_amount, r.amount_mm AS new_amount_mm
        FROM report r LEFT JOIN first_rows p ON p.request = r.approval_id"""
    return {
        "pending_approvals": f"WITH {APPROVALS} SELECT * FROM pending_rows",
        "pending_approvals_renamed": f"WITH {APPROVALS} SELECT * FROM pending_rows",
        "latest_snapshot": f"""WITH {cte("fx_dated_reports")}
            SELECT * FROM fx_dated_reports WHERE report_date = (
              SELECT max(report_date) FROM fx_dated_reports WHERE report_date < DATE '2001-06-20')""",
        "pending_approvals_one_template": f"WITH {APPROVALS} SELECT * FROM pending_rows WHERE template_id = 37508",
        "pending_approvals_without_role": f"""WITH {cte("fx_approvals")}
            SELECT approval_id, title, needed_on, decision, approver, status, 0 AS template_id FROM fx_approvals
            WHERE status = 'Pending' AND decision IN ('Pending', 'Pending in future', 'Approved')""",
        "needed_by_rollup": f"{grouped} SELECT {keys}, needed_by FROM requests",
        "actions_pivot": f"""{grouped} SELECT {keys}, pending, pending_in_future, approved, approved_with_condition
            FROM requests""",
        "approval_rollup": f"""{grouped} SELECT {keys}, needed_by, needed_by_conflict, pending, pending_in_future,
            approved, approved_with_condition FROM requests""",
        "approver_checklist": f"{grouped} SELECT {keys}, mark_a, mark_b, mark_c, mark_d, queue FROM awaited",
        "approval_queue": f"{grouped} SELECT {keys}, queue, pending FROM awaited",
        "unknown_templates": f"""{grouped} SELECT DISTINCT template_id FROM awaited
            WHERE template_id NOT IN ({", ".join(str(t) for t in config.KNOWN_TEMPLATES)})""",
        "distinct_join_count": f"""WITH {cte("fx_approvals")}
            SELECT approval_id, {everything}, count(*) AS count FROM fx_approvals GROUP BY approval_id""",
        "distinct_join_by_decision": f"""WITH {cte("fx_approvals")}
            SELECT decision, {", ".join(f"{_people_any(c)} AS {c}" for c in ("approver", "needed_on", "title"))},
                   count(*) AS count FROM fx_approvals GROUP BY decision""",
        "actions_merged": _actions_merged(keys),
        "approval_report": f"WITH {REPORTED} SELECT {REPORT_COLUMNS} FROM report",
        "approval_report_lazy": f"WITH {REPORTED} SELECT {REPORT_COLUMNS} FROM report",
        "title_clean": _title_fact("clean"),
        "title_sites": _title_fact("site"),
        "title_building_types": _title_fact("building_type"),
        "title_request_types": _title_fact("full_type"),
        "title_classifier": _title_fact("request_type"),
        "title_region": _title_fact("region"),
        "title_plan_years": _title_fact("plan_year"),
        "title_amount": _title_fact("amount_mm"),
        "title_facts": f"""WITH {TITLED} SELECT approval_id, title, template_id, region, plan_year, request_type,
            amount_mm, unrecognized, building_type, site, full_type, clean_title FROM facts""",
        "need_by_display": f"""WITH {cte("fx_approvals")}
            SELECT approval_id, needed_on, strftime({need_by}, '%d-%b, %Y') AS need_by FROM fx_approvals""",
        "past_due": f"""WITH {cte("fx_approvals")}
            SELECT approval_id, needed_on, {need_by} <= DATE '2001-06-20' AS past_due FROM fx_approvals""",
        "data_cut_label": f"""WITH {APPROVALS}
            SELECT 'Data cut on ' || strftime(TIMESTAMP '2001-06-20 09:00:00', '%Y-%m-%d at %I %p') AS label,
                   count(*) AS row_count FROM pending_rows""",
        "region_rank_sort": f"""WITH {TITLED} SELECT approval_id, region, region_rank FROM facts
            ORDER BY region_rank, approval_id""",
        "first_match_lookup": f"""WITH {cte("fx_previous_report")}, {PREVIOUS}
            SELECT approval_link, region, plan_year, request_type, clean_title, amount_mm, row_pos,
                   request AS approval_id FROM first_rows""",
        "new_entities": f"""{reconciled} SELECT approval_id, template_id, original_title FROM report
            WHERE approval_id NOT IN (SELECT request FROM linked)""",
        "amount_changes": f"""{reconciled}
            SELECT r.approval_id, r.template_id, r.original_title, r.amount_mm, p.amount_mm AS previous_amount_mm,
                   coalesce({CHANGED}, FALSE) AS is_new_amount
            FROM report r JOIN first_rows p ON p.request = r.approval_id""",
        "reconcile_report": whole,
        "reconcile_report_lazy": whole,
    }


def _actions_merged(keys: str) -> str:
    """One grouped frame per action and one of need-by texts, joined by full outer joins."""
    actions = {"pending": "Pending", "pending_in_future": "Pending in future", "approved": "Approved",
               "approved_with_condition": "Approved with condition"}
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    frames = [
        f"""{column} AS (SELECT {keys}, count(DISTINCT approver) AS {column}_people,
              min(needed_on) AS {column}_first_needed_on FROM pending_rows
              WHERE decision = '{action}' AND {known} GROUP BY ALL)"""
        for column, action in actions.items()
    ]
    needed = f"""needed AS (SELECT {keys}, coalesce(array_to_string(list_sort(list(DISTINCT needed_on)
              FILTER (WHERE needed_on IS NOT NULL)), ' | '), '') AS needed_by FROM pending_rows
              WHERE {known} GROUP BY ALL)"""
    shown = ", ".join(f"{c}_people, {c}_first_needed_on, {c}_people IS NOT NULL AS in_{c}" for c in actions)
    joins = " ".join(f"FULL JOIN {c} USING ({keys})" for c in [*list(actions)[1:], "needed"])
    return f"""WITH {APPROVALS}, {", ".join(frames)}, {needed}
            SELECT {keys}, {shown}, needed_by, needed_by IS NOT NULL AS in_needed FROM pending {joins}"""


def _people_any(column: str) -> str:
    return (
        f"coalesce(array_to_string(list_sort(list(DISTINCT {column}) FILTER (WHERE {column} IS NOT NULL)), ','), '')"
    )

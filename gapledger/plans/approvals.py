"""Approval reports: clean extract, roll-up, checklist, title facts, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger.config import ACTION_COLUMNS, REGION_RANK_FALLBACK, ApprovalRules
from gapledger.functions import dates, titles
from gapledger.functions.amounts import with_amount
from gapledger.operators.columns import renamed, with_default
from gapledger.operators.grouping import distinct_join, values_not_in
from gapledger.operators.numbering import number_rows, number_rows_lazily
from gapledger.sources.extracts import approval_link
from gapledger.staging import staged

# The id comes first: it tells most groups apart when keys are compared.
REQUEST_KEYS = ("approval_id", "template_id", "title")
DIVIDER = " | "
PENDING_ACTIONS = ("Pending", "Pending in future")
APPROVED_ACTIONS = ("Approved", "Approved with condition")


def pending_approvals(
    extract: DataFrame, rules: ApprovalRules, template: str | None = None, names: dict[str, str] | None = None
) -> DataFrame:
    """Rows of pending requests whose decision counts.

    ``names`` maps an extract's own headings to the names used here. With a role
    column only approvers stay, without one every row with a decision. ``template``
    limits the report to one named template.
    """
    rows = renamed(extract, names or {})
    rows = with_default(rows, "template_id", 0, "int").filter(F.col("status") == "Pending")
    if "role" in rows.columns:
        rows = rows.filter(F.col("role") == "APPROVER")
    else:
        rows = rows.filter(F.col("decision").isNotNull())
    rows = rows.filter(F.col("decision").isin(list(rules.accepted_decisions)))
    if template is not None:
        rows = rows.filter(F.col("template_id") == rules.template_ids[template])
    return rows


def _keyed(pending: DataFrame) -> DataFrame:
    """Rows with a null in the request key belong to no request."""
    return pending.dropna(subset=list(REQUEST_KEYS))


def _approver_if(action: str) -> Column:
    return F.when(F.col("decision") == action, F.col("approver"))


def needed_by_rollup(pending: DataFrame) -> DataFrame:
    """Distinct need-by texts per request."""
    return _keyed(pending).groupBy(*REQUEST_KEYS).agg(
        distinct_join(F.col("needed_on"), DIVIDER).alias("needed_by")
    )


def actions_pivot(pending: DataFrame) -> DataFrame:
    """Distinct approvers per request, one column per action, empty when nobody
    took it. Conditional sets over one grouping need one shuffle."""
    return _keyed(pending).groupBy(*REQUEST_KEYS).agg(*[
        distinct_join(_approver_if(action), DIVIDER).alias(column) for action, column in ACTION_COLUMNS.items()
    ])


def request_groups(pending: DataFrame, rules: ApprovalRules) -> DataFrame:
    """One row per request, in one shuffle: approver sets by action, the marks of
    the tracked approvers, the queue and the need-by time.

    Marks and queue are plain boolean aggregates, so their state stays constant
    per request. Who took which action is one set, as each set of an aggregate is packed
    and unpacked for every row that is shuffled; it is cut by action afterwards. Columns that
    a caller does not select are pruned from the aggregate.
    """
    acted = F.col("decision").isin(list(ACTION_COLUMNS)) & F.col("approver").isNotNull()
    actors = F.collect_set(F.when(acted, F.struct("decision", "approver"))).alias("_actors")
    is_pending = F.col("decision").isin(list(PENDING_ACTIONS))
    is_approved = F.col("decision").isin(list(APPROVED_ACTIONS))

    def ever(condition: Column) -> Column:
        return F.coalesce(F.bool_or(condition), F.lit(False))

    marks = [
        F.when(ever(is_pending & (F.col("approver") == name)), rules.pending_mark)
        .when(ever(is_approved & (F.col("approver") == name)), rules.approved_mark)
        .otherwise(rules.default_mark)
        .alias(f"mark_{key}")
        for key, name in rules.tracked.items()
    ]
    queued = F.lit(False)
    for key in rules.queue_approvers:
        queued = queued | F.contains(F.col("approver"), F.lit(rules.tracked[key]))
    groups = _keyed(pending).groupBy(*REQUEST_KEYS).agg(
        distinct_join(F.col("needed_on"), DIVIDER).alias("needed_by"),
        F.min(dates.needed_by_utc(F.col("needed_on"))).alias("needed_by_utc"),
        (F.min("needed_on") != F.max("needed_on")).alias("needed_by_conflict"),
        actors,
        *marks,
        F.when(ever((F.col("decision") == "Pending") & queued), "VP").otherwise("Pre-VP").alias("queue"),
    )

    def people(action: str) -> Column:
        taken = F.filter("_actors", lambda x: x["decision"] == action)
        return F.array_sort(F.transform(taken, lambda x: x["approver"]))

    return groups.withColumns({column: people(a) for a, column in ACTION_COLUMNS.items()}).drop("_actors")


def _as_text(columns: list[str]) -> dict[str, Column]:
    return {c: F.array_join(c, DIVIDER) for c in columns}


def approval_rollup(pending: DataFrame, rules: ApprovalRules) -> DataFrame:
    """Need-by texts and approvers by action of every request."""
    actions = list(ACTION_COLUMNS.values())
    return (
        request_groups(pending, rules)
        .select(*REQUEST_KEYS, "needed_by", "needed_by_conflict", *actions)
        .withColumns(_as_text(actions))
    )


def _awaited(rules: ApprovalRules) -> Column:
    """Any tracked approver still has to decide, now or later."""
    awaited = F.lit(False)
    for key in rules.tracked:
        awaited = awaited | (F.col(f"mark_{key}") == rules.pending_mark)
    return awaited


def awaited_requests(pending: DataFrame, rules: ApprovalRules) -> DataFrame:
    return request_groups(pending, rules).filter(_awaited(rules))


def approver_checklist(pending: DataFrame, rules: ApprovalRules) -> DataFrame:
    """Marks of the tracked approvers and queue of every awaited request."""
    return awaited_requests(pending, rules).select(
        *REQUEST_KEYS, *[f"mark_{key}" for key in rules.tracked], "queue"
    )


def approval_queue(pending: DataFrame, rules: ApprovalRules) -> DataFrame:
    return awaited_requests(pending, rules).select(*REQUEST_KEYS, "queue", F.array_join("pending", DIVIDER).alias("pending"))


def unknown_templates(pending: DataFrame, rules: ApprovalRules) -> DataFrame:
    """Templates among the awaited requests that are not known yet."""
    return values_not_in(awaited_requests(pending, rules), "template_id", rules.known_templates)


def with_sort_facts(requests: DataFrame, rules: ApprovalRules) -> DataFrame:
    """Titled requests with the clean title text (``original_title``) and the
    facts the report is sorted by."""
    text = F.col("original_title")
    titled = (
        requests.filter(F.col("title").isNotNull())
        .withColumn("original_title", titles.clean_title(F.col("title")))
        .withColumn("_lowered", F.lower(text))
        .withColumns({
            "region": titles.region(text, F.col("template_id"), rules),
            "request_type": titles.request_type(text, F.col("_lowered")),
        })
        .drop("_lowered")
    )
    return dates.with_plan_years(titled, "original_title", rules.as_of, "plan_year")


def with_other_facts(requests: DataFrame, rules: ApprovalRules) -> DataFrame:
    """The facts that only show, from the clean title text."""
    text = F.col("original_title")
    bulk = F.when(text.rlike("(?i)bulk"), "Bulk ").otherwise("")
    tagged = with_amount(requests, "original_title", "amount_mm").withColumns({
        "unrecognized": F.col("request_type").isNull(),
        "building_type": titles.keyword_tags(text, rules.building_types, " "),
        "site": titles.site_codes(text, rules.site_stems_excluded),
        "full_type": titles.keyword_tags(text, rules.request_types, " and "),
    })
    return tagged.withColumn(
        "clean_title", F.concat(bulk, "site", F.lit(" "), "building_type", F.lit(" "), "full_type")
    )


def title_facts(requests: DataFrame, rules: ApprovalRules) -> DataFrame:
    """All facts of every titled request beside its other columns."""
    return with_other_facts(with_sort_facts(requests, rules), rules)


def report_order() -> list[Column]:
    """VP queue first, then request type, region rank and plan year; the request
    key breaks ties."""
    return [
        F.col("queue").desc(), F.col("request_type").asc_nulls_last(), F.col("region_rank").asc(),
        F.col("plan_year").asc(), F.col("template_id").asc(), F.col("approval_id").asc(), F.col("title").asc(),
    ]


def _shown(requests: DataFrame, rules: ApprovalRules) -> DataFrame:
    """Everything the report shows but its number and sort facts."""
    need_by = dates.local_date(F.col("needed_by_utc"), rules.need_by_zone)
    shown = with_other_facts(requests, rules).withColumn("_need_by", need_by)
    return shown.withColumns({
        "need_by": dates.display_date(F.col("_need_by")),
        "past_due": dates.past_due(F.col("_need_by"), rules.as_of_time),
        "approval_link": approval_link(F.col("approval_id"), rules.link_prefix),
        **_as_text(list(ACTION_COLUMNS.values())),
    })


def _report_columns(rules: ApprovalRules) -> list[str]:
    return [
        "queue", "region", "plan_year", "request_type", "clean_title", "amount_mm", "need_by", "approval_id",
        "approval_link", "template_id", *[f"mark_{key}" for key in rules.tracked], *ACTION_COLUMNS.values(),
        "site", "building_type", "full_type", "unrecognized", "past_due", "needed_by_conflict", "original_title",
    ]


def unnumbered_report(pending: DataFrame, rules: ApprovalRules) -> DataFrame:
    """The report without order and numbers, for uses that need neither."""
    sorted_by = with_sort_facts(awaited_requests(pending, rules), rules)
    return _shown(sorted_by, rules).select(*_report_columns(rules))


# The columns of ``report_order`` that have few values.
_LEADING = {
    "queue": Column.desc, "request_type": Column.asc_nulls_last, "region_rank": Column.asc, "plan_year": Column.asc,
    "template_id": Column.asc,
}


def approval_report(pending: DataFrame, rules: ApprovalRules, lazy: bool = False) -> DataFrame:
    """The numbered report. Write it ordered by ``row_number``.

    Only what the order needs is worked out before the sort, which reads its
    input twice (once to sample it) and so gets it from a table; the rest follows on the
    numbered rows. That sort is an action, unless ``lazy``: the plan then runs nothing by itself and reads more often.
    """
    requests = with_sort_facts(awaited_requests(pending, rules), rules).withColumn(
        "region_rank", titles.region_rank(F.col("region"), rules, REGION_RANK_FALLBACK)
    )
    if lazy:
        numbered = number_rows_lazily(requests, _LEADING, report_order()[len(_LEADING):], "row_number", "approval_id")
    else:
        numbered = number_rows(staged(requests), report_order(), "row_number")
    return _shown(numbered, rules).select("row_number", *_report_columns(rules))

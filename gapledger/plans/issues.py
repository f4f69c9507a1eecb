"""Issue reports: current sprint, missing fields, recipients, digest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapledger.config import IssueRules
from gapledger.functions import dates, identity, labels
from gapledger.operators.digest import cell_flags, digest_pages
from gapledger.operators.grouping import first_seen
from gapledger.operators.joins import lookup_left
from gapledger.operators.numbering import number_rows, number_rows_lazily

METRICS = (
    "missing_labels", "missing_dates", "missing_effort", "missing_root_cause", "missing_comments",
)
GAP_COLUMNS = ("issueurl", "title", "assignee", "manager_email", *METRICS, "business_days")


def _assignee(rules: IssueRules) -> Column:
    return identity.clean_identity(F.col("assigneeidentity"), rules.realm_prefix, rules.realm_suffix)


def _sprint_labels() -> Column:
    return labels.sprint_label_count(
        F.col("labelids"),
        F.col("label_customer"), F.col("label_execution"), F.col("label_planning"), F.col("label_product"),
    )


# --- sprint scope ---------------------------------------------------------


def active_sprints(sprints: DataFrame, rules: IssueRules) -> DataFrame:
    """Sprints running on the report day, the days of grace included."""
    starts = dates.text_date(F.col("start_date"))
    ends = F.date_add(dates.text_date(F.col("end_date")), rules.sprint_grace_days)
    return sprints.filter(F.lit(rules.as_of).between(starts, ends))


def current_sprint(sprints: DataFrame, rules: IssueRules) -> DataFrame:
    """At most one row. Grace days let sprints overlap: the latest start wins,
    then the lowest id."""
    return (
        active_sprints(sprints, rules)
        .orderBy(F.col("start_date").desc(), "sprint_id")
        .limit(1)
        .select(
            F.col("sprint_id").alias("current_sprint_id"),
            F.col("start_date").alias("current_sprint_start_date"),
            F.col("end_date").alias("current_sprint_end_date"),
        )
    )


def sprint_gaps(issues: DataFrame, sprints: DataFrame, rules: IssueRules) -> DataFrame:
    """Top-level issues of the current sprint that lack the customer label or a
    completion date. No active sprint: no rows."""
    sprint_id = current_sprint(sprints, rules).select("current_sprint_id").scalar()
    days = dates.days_since(dates.text_date(F.col("resolveddate")), rules.as_of)
    no_finish = F.col("estimatedcompletiondate").isNull() & F.col("resolveddate").isNull()
    # No finish date implies no resolve date, so the day test cannot fail here.
    no_completion = no_finish & (_sprint_labels() > 0) & (days.isNull() | (days < rules.recent_days))
    return (
        issues.filter(F.col("parenttaskids").isNull())
        .filter(F.col("label_customer").isNull() | no_finish)
        .filter(labels.in_sprint(F.col("labelids"), sprint_id, rules.exact_sprint_label))
        .select(
            "title", "issueurl", "assignedfolderid",
            _assignee(rules).alias("assignee"),
            F.col("label_customer").isNull().alias("no_customer"),
            no_completion.alias("no_completion"),
        )
        .filter("no_customer OR no_completion")
    )


def in_kept_folders(gaps: DataFrame, folders: DataFrame, rules: IssueRules, spread_by: str) -> DataFrame:
    """Rows whose folder rolls up to a reported kind or to none at all."""
    # Copies in a lookup would only multiply rows that become distinct later.
    rollups = folders.select(F.col("assignedfolderid").alias("_folder"), "folder_roll_up").distinct()
    joined = lookup_left(gaps, rollups, "assignedfolderid", "_folder", spread_by, rules.lookup_salts)
    kept = F.col("folder_roll_up").isin(list(rules.kept_rollups)) | F.col("folder_roll_up").isNull()
    return joined.filter(kept).drop("_folder", "folder_roll_up")


def missing_mandatory_fields(
    issues: DataFrame, folders: DataFrame, sprints: DataFrame, rules: IssueRules
) -> DataFrame:
    # The team table adds no column here and duplicates collapse below, so it is
    # not joined.
    return (
        in_kept_folders(sprint_gaps(issues, sprints, rules), folders, rules, "issueurl")
        .select(
            "title", "assignee", "issueurl",
            labels.yes_no(F.col("no_customer")).alias("missing_customer_label"),
            labels.yes_no(F.col("no_completion")).alias("missing_completion_date"),
        )
        .distinct()
    )


def _gap_assignees(issues: DataFrame, folders: DataFrame, sprints: DataFrame, rules: IssueRules) -> DataFrame:
    """Distinct assignees. Reduced to distinct (assignee, folder) pairs before the
    folder join, which takes hot assignees and folders out of it."""
    pairs = (
        sprint_gaps(issues, sprints, rules)
        .filter(F.col("assignee").isNotNull())
        .select("assignee", "assignedfolderid")
        .distinct()
    )
    return in_kept_folders(pairs, folders, rules, "assignee").select("assignee").distinct()


def assignee_recipients(
    issues: DataFrame, folders: DataFrame, sprints: DataFrame, rules: IssueRules
) -> DataFrame:
    return _gap_assignees(issues, folders, sprints, rules).select(
        "assignee", identity.address(F.col("assignee"), rules.mail_domain).alias("assignee_email")
    )


def manager_recipients(
    issues: DataFrame, folders: DataFrame, team: DataFrame, sprints: DataFrame, rules: IssueRules
) -> DataFrame:
    """Managers of the assignees. Only the team's own manager column has to be
    set: somebody who is their own manager and has no senior gives a null row."""
    assignees = _gap_assignees(issues, folders, sprints, rules)
    members = team.filter(F.col("manager").isNotNull()).select("alias", "manager", "sr_manager").distinct()
    responsible = identity.responsible_manager(F.col("alias"), F.col("manager"), F.col("sr_manager"))
    return (
        assignees.join(members, F.col("assignee") == F.col("alias"))
        .select(responsible.alias("manager"))
        .distinct()
        .select("manager", identity.address(F.col("manager"), rules.mail_domain).alias("manager_email"))
    )


# --- resolved bugs --------------------------------------------------------


def resolved_bugs(issues: DataFrame, rules: IssueRules) -> DataFrame:
    """Bugs resolved by people after the cut-off. A null last author is dropped
    like the bot.

    The test on the raw text keeps all that the test on the date keeps, as such texts
    begin with the date; unlike the latter it reaches the scan.
    """
    resolved_on = dates.text_date(F.col("resolveddate"))
    return issues.filter(
        (F.col("assignedfolderid") == rules.bug_folder)
        & (F.col("status") == rules.resolved_status)
        & (F.col("last_comment_author") != rules.bot_author)
        & (F.col("resolveddate") > rules.cutoff.isoformat())
        & (resolved_on > F.lit(rules.cutoff))
    )


def bug_gap_rows(issues: DataFrame, team: DataFrame, rules: IssueRules) -> DataFrame:
    """Resolved bugs with any gap, unsorted: distinct rows, one per issue and distinct
    team match."""
    resolved_on = dates.text_date(F.col("resolveddate"))
    measured = resolved_bugs(issues, rules).select(
        "issueurl", "title",
        _assignee(rules).alias("assignee"),
        labels.missing_labels(F.col("label_customer"), F.col("label_product"), _sprint_labels())
        .alias("missing_labels"),
        labels.missing_dates(F.col("estimatedcompletiondate"), F.col("actualstartdate")).alias("missing_dates"),
        labels.yes_no(F.col("totaleffortspent") == 0).alias("missing_effort"),
        labels.yes_no(F.col("rootcauses").isNull()).alias("missing_root_cause"),
        labels.yes_no(F.col("conversationcount").isNull()).alias("missing_comments"),
        dates.business_days_since(resolved_on, rules.as_of, rules.week_start).alias("business_days"),
    )
    any_gap = F.lit(False)
    for metric in METRICS:
        any_gap = any_gap | (F.col(metric) != "No")
    responsible = identity.responsible_manager(F.col("alias"), F.col("manager"), F.col("sr_manager"))
    return (
        lookup_left(
            measured.filter(any_gap), team.select("alias", "manager", "sr_manager"),
            "assignee", "alias", "issueurl", rules.lookup_salts,
        )
        .withColumn("manager_email", identity.address(responsible, rules.mail_domain))
        .select(*GAP_COLUMNS)
        .distinct()
    )


def report_order() -> list[Column]:
    """Assignee, longest wait first. The other columns break ties, which also
    lets a range sort split an assignee with very many rows."""
    return [
        F.col("assignee").asc_nulls_last(), F.col("business_days").desc_nulls_first(),
        *[F.col(c).asc() for c in ("issueurl", "title", "manager_email", *METRICS)],
    ]


def resolved_bug_gaps(issues: DataFrame, team: DataFrame, rules: IssueRules) -> DataFrame:
    return bug_gap_rows(issues, team, rules).orderBy(*report_order())


def bug_gap_to_list(gap_rows: DataFrame, rules: IssueRules, lazy: bool = False) -> DataFrame:
    """Assignee addresses in order of appearance, which is assignee order. ``lazy``: no job
    runs while the plan is built; names are then numbered by their first three characters."""
    people = gap_rows.filter(F.col("assignee").isNotNull()).select("assignee").distinct()
    addressed = people.select(identity.address(F.col("assignee"), rules.mail_domain).alias("address"), "assignee")
    if lazy:
        begun = addressed.withColumn("begin", F.left("assignee", F.lit(3)))
        numbered = number_rows_lazily(begun, {"begin": Column.asc}, [F.col("assignee").asc()], "list_order")
    else:
        numbered = number_rows(addressed, [F.col("assignee").asc()], "list_order")
    return numbered.select("list_order", "address")


def bug_gap_cc_list(gap_rows: DataFrame, rules: IssueRules) -> DataFrame:
    """Manager addresses in order of appearance, then the always-copied ones
    that are not among them. Managers who appear on the same issue first come in
    address order, as in the report."""
    place = F.struct(
        F.lit(0).alias("part"),
        F.col("assignee").isNull().alias("unassigned"), "assignee",
        (-F.col("business_days")).alias("wait"), "issueurl", "title",
    )
    managers = first_seen(gap_rows, "manager_email", place).withColumnRenamed("manager_email", "address")
    # A handful of configured addresses.
    spark = gap_rows.sparkSession
    fixed = spark.createDataFrame(
        [(a, i) for i, a in enumerate(rules.always_copied)], "address string, place int"
    ).select(
        "address",
        F.struct(
            F.lit(1).alias("part"), F.lit(False).alias("unassigned"),
            F.lit(None).cast("string").alias("assignee"), F.col("place").alias("wait"),
            F.lit(None).cast("string").alias("issueurl"), F.lit(None).cast("string").alias("title"),
        ).alias("first_seen"),
    )
    everyone = managers.unionByName(fixed).groupBy("address").agg(F.min("first_seen").alias("first_seen"))
    return number_rows(everyone, [F.col("first_seen").asc(), F.col("address").asc()], "list_order").select("list_order", "address")


def bug_gap_cell_flags(gap_rows: DataFrame, rules: IssueRules) -> DataFrame:
    flags = cell_flags(METRICS, rules.flagged_columns)
    return gap_rows.select("issueurl", "manager_email", *[c.alias(n) for n, c in flags.items()])


def bug_gap_digest(gap_rows: DataFrame, rules: IssueRules, recipient: str = "manager_email") -> DataFrame:
    """HTML pages per manager, or per ``assignee``; rows without one go to pages with a
    null recipient, which are for the always-copied addresses."""
    return digest_pages(gap_rows, recipient, report_order(), rules.flagged_columns, rules.page_rows)


def bug_gap_run_status(gap_rows: DataFrame, rules: IssueRules) -> DataFrame:
    """One row saying whether there is anything to send."""
    return gap_rows.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(rules.as_of).alias("as_of"), "row_count", (F.col("row_count") == 0).alias("is_empty")
    )

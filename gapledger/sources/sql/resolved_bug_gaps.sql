-- Resolved bugs with missing fields, as one statement.
-- Tables: issues, team. Parameters: as_of, cutoff, bug_folder,
-- resolved_status, bot_author, realm_prefix, realm_suffix, mail_domain,
-- week_start (monday or sunday).
WITH bugs AS (
  SELECT issueurl,
         title,
         trim(replace(replace(assigneeidentity, :realm_prefix, ''), :realm_suffix, '')) AS assignee,
         CASE WHEN resolveddate RLIKE '^[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]'
              THEN try_cast(left(resolveddate, 10) AS DATE) END AS resolved_on,
         coalesce(length(labelids) - length(replace(labelids, ',', '')) + 1, 0)
           - int(label_customer IS NOT NULL) - int(label_execution IS NOT NULL)
           - int(label_planning IS NOT NULL) - int(label_product IS NOT NULL) AS sprint_labels,
         concat_ws(', ', if(label_customer IS NULL, 'Customer', NULL),
                         if(label_product IS NULL, 'Product', NULL)) AS fixed_label_gaps,
         concat_ws(', ', if(estimatedcompletiondate IS NULL, 'Estimated Completion Date', NULL),
                         if(actualstartdate IS NULL, 'Actual Start Date', NULL)) AS date_gaps,
         if(totaleffortspent = 0, 'Yes', 'No') AS missing_effort,
         if(rootcauses IS NULL, 'Yes', 'No') AS missing_root_cause,
         if(conversationcount IS NULL, 'Yes', 'No') AS missing_comments
  FROM {issues}
  WHERE assignedfolderid = :bug_folder
    AND status = :resolved_status
    AND last_comment_author <> :bot_author
    AND resolveddate > string(:cutoff)
),
-- Issues without assignee match nobody; hashed by their link they do not meet in one task.
spread_bugs AS (
  SELECT *, xxhash64(coalesce(assignee, issueurl)) AS spread FROM bugs WHERE resolved_on > :cutoff
),
spread_team AS (
  SELECT alias, manager, sr_manager, xxhash64(alias) AS spread FROM {team}
),
worded AS (
  SELECT b.issueurl, b.title, b.assignee,
         CASE WHEN t.manager = t.alias THEN t.sr_manager ELSE t.manager END || :mail_domain AS manager_email,
         CASE WHEN sprint_labels < 0 THEN 'No'
              ELSE coalesce(nullif(concat_ws(', ', nullif(fixed_label_gaps, ''),
                                             if(sprint_labels = 0, 'Sprint Tag', NULL)), ''), 'No')
         END AS missing_labels,
         coalesce(nullif(date_gaps, ''), 'No') AS missing_dates,
         missing_effort, missing_root_cause, missing_comments,
         datediff(:as_of, resolved_on)
           - 2 * int(datediff(trunc(date_add(:as_of, int(:week_start = 'sunday')), 'week'),
                              trunc(date_add(resolved_on, int(:week_start = 'sunday')), 'week')) / 7) AS business_days
  FROM spread_bugs b LEFT JOIN spread_team t ON b.assignee = t.alias AND b.spread = t.spread
)
SELECT DISTINCT *
FROM worded
WHERE missing_labels <> 'No' OR missing_dates <> 'No' OR missing_comments <> 'No'
   OR missing_effort <> 'No' OR missing_root_cause <> 'No'
ORDER BY assignee ASC NULLS LAST, business_days DESC NULLS FIRST, issueurl, title, manager_email,
         missing_labels, missing_dates, missing_effort, missing_root_cause, missing_comments

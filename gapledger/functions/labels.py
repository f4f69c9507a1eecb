"""Label lists, sprint membership and missing-field wording."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_total(labelids: Column) -> Column:
    """Elements of a comma list: null has none, an empty text has one."""
    commas = F.length(labelids) - F.length(F.replace(labelids, F.lit(","), F.lit("")))
    return F.coalesce(commas + 1, F.lit(0))


def sprint_label_count(labelids: Column, *known_labels: Column) -> Column:
    """Labels left after the known ones; negative when the list is shorter than
    the known labels claim."""
    count = label_total(labelids)
    for label in known_labels:
        count = count - label.isNotNull().cast("int")
    return count


def in_sprint(labelids: Column, sprint_id: Column, exact: bool = False) -> Column:
    """Whether a label list names the sprint. Null sprint or list: not a member."""
    hit = F.array_contains(F.split(labelids, ","), sprint_id) if exact else F.contains(labelids, sprint_id)
    return F.coalesce(hit, F.lit(False))


def _named_gaps(*gaps: Column) -> Column:
    """Comma list of the gaps that apply (null = does not apply), else 'No'."""
    listed = F.concat_ws(", ", *gaps)
    return F.when(listed == "", "No").otherwise(listed)


def missing_labels(customer: Column, product: Column, sprint_labels: Column) -> Column:
    """Which labels are missing. A negative sprint label count reports 'No'."""
    named = _named_gaps(
        F.when(customer.isNull(), "Customer"),
        F.when(product.isNull(), "Product"),
        F.when(sprint_labels == 0, "Sprint Tag"),
    )
    return F.when(sprint_labels < 0, "No").otherwise(named)


def missing_dates(estimated_completion: Column, actual_start: Column) -> Column:
    """Which dates are missing."""
    return _named_gaps(
        F.when(estimated_completion.isNull(), "Estimated Completion Date"),
        F.when(actual_start.isNull(), "Actual Start Date"),
    )


def yes_no(condition: Column) -> Column:
    """'Yes' when the condition holds, 'No' when it is false or unknown."""
    return F.when(condition, "Yes").otherwise("No")

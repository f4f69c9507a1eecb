"""Parameters of the reports.

Nothing reads an ambient clock: "today" is always ``as_of`` / ``as_of_time``.
Addresses, people, folders and link hosts are placeholders to be replaced by
the caller.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# The wording and codes below have to match the reports they feed.
KEPT_FOLDER_ROLLUPS = ("BUG", "Access Request", "Feature Request")

ACTIONS = ("Pending", "Pending in future", "Approved", "Approved with condition")
ACCEPTED_DECISIONS = ("Pending", "Pending in future", "Approved")

BUILDING_TYPES = (
    "ARS", "ARS450", "TNS", "TNS80", "Kariba", "Hazmat", "Sort Center", "IXD",
    "Mixed Sort", "SFC Retrofit", "TSSL", "IPC", "3PL",
)
REQUEST_TYPES = (
    "Initial Full Startup", "Final Full Startup", "Startup Supplemental",
    "Supplemental Startup", "Construction", "Full Real Estate", "Lease Renewal",
    "Reallocation",
)
SITE_STEMS_EXCLUDED = ("ARS", "TNS")

REGION_RANK = {"EU": 0, "AP": 1, "IN": 2, "EC": 3, "NA": 4, "Check": 5}
REGION_RANK_FALLBACK = 9999
REGION_FOLD = {"JP": "AP", "IN": "AP", "AU": "EC", "MX": "EC", "BR": "EC"}
REGION_OF_TEMPLATE = {
    7394: "EC", 30143: "NA", 35306: "NA", 35476: "NA", 36470: "NA", 37155: "NA",
    37156: "NA", 37158: "NA", 37508: "EU", 39802: "NA", 39818: "NA", 39820: "NA",
}
KNOWN_TEMPLATES = (
    39820, 39818, 39802, 37508, 37158, 37156, 37155, 36470, 35476, 35306, 30143,
    7394, 7393,
)
TEMPLATE_IDS = {
    "na_startup": 7360,
    "mx_startup": 7394,
    "na_ixd_initiative": 39171,
    "na_ar_sortable_initiative": 39172,
    "na_traditional_initiative": 39174,
    "na_non_sort_initiative": 39175,
    "transport_initiative": 39176,
    "eu_real_estate": 37508,
}
# End of fixed values.

ACTION_COLUMNS = {action: action.lower().replace(" ", "_") for action in ACTIONS}


@dataclass(frozen=True)
class IssueRules:
    """Parameters of the issue reports."""

    as_of: dt.date
    cutoff: dt.date = dt.date(2022, 10, 1)
    bug_folder: str = "F0"
    resolved_status: str = "Resolved"
    bot_author: str = "robot"
    realm_prefix: str = "kerberos:"
    realm_suffix: str = "@CORP.EXAMPLE"
    mail_domain: str = "@example.org"
    always_copied: tuple[str, ...] = ("lead@example.org",)
    kept_rollups: tuple[str, ...] = KEPT_FOLDER_ROLLUPS
    sprint_grace_days: int = 2
    recent_days: int = 15
    # False: an id counts as present when it is a substring of the label list,
    # so S1 also hits S13. True: it must be a whole element of the list.
    exact_sprint_label: bool = False
    # First weekday of a week when week boundaries are counted.
    week_start: str = "monday"
    # Metrics whose cells are marked; comments are left out by default.
    flagged_columns: tuple[str, ...] = (
        "missing_labels", "missing_dates", "missing_effort", "missing_root_cause",
    )
    # Rows per digest page; further rows go to further pages.
    page_rows: int = 200
    # Salts that hot assignees and folders are dealt to in lookups that are not broadcast;
    # 0 leaves them to adaptive execution. Salting reads the facts' keys twice.
    lookup_salts: int = 0


@dataclass(frozen=True)
class ApprovalRules:
    """Parameters of the approval reports."""

    as_of_time: dt.datetime
    accepted_decisions: tuple[str, ...] = ACCEPTED_DECISIONS
    # Report column suffix -> approver as spelled in the extract.
    tracked: dict[str, str] = field(default_factory=lambda: {
        "a": "Lead, A", "b": "Lead, B", "c": "Lead, C", "d": "Finance, D",
    })
    queue_approvers: tuple[str, ...] = ("a", "b", "c")
    pending_mark: str = " "
    approved_mark: str = "✓"
    default_mark: str = "NA"
    link_prefix: str = "https://approvals.example.org/"
    need_by_zone: str = "America/Los_Angeles"
    building_types: tuple[str, ...] = BUILDING_TYPES
    request_types: tuple[str, ...] = REQUEST_TYPES
    site_stems_excluded: tuple[str, ...] = SITE_STEMS_EXCLUDED
    region_rank: dict[str, int] = field(default_factory=lambda: dict(REGION_RANK))
    region_fold: dict[str, str] = field(default_factory=lambda: dict(REGION_FOLD))
    region_of_template: dict[int, str] = field(default_factory=lambda: dict(REGION_OF_TEMPLATE))
    template_ids: dict[str, int] = field(default_factory=lambda: dict(TEMPLATE_IDS))
    known_templates: tuple[int, ...] = KNOWN_TEMPLATES

    @property
    def as_of(self) -> dt.date:
        return self.as_of_time.date()

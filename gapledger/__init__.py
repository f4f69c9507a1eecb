"""gapledger: work-tracking analytics expressed as Spark DataFrame plans."""

from gapledger.config import ApprovalRules, IssueRules

__all__ = ["ApprovalRules", "IssueRules"]

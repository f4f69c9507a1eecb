"""The reports: issue gaps, approval requests, reconciliation."""

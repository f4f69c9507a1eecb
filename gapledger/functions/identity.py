"""People: aliases out of identities, addresses, who manages whom."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_identity(identity: Column, realm_prefix: str, realm_suffix: str) -> Column:
    """``realm:alias@DOMAIN`` -> ``alias``; null stays null."""
    bare = F.replace(F.replace(identity, F.lit(realm_prefix), F.lit("")), F.lit(realm_suffix), F.lit(""))
    return F.trim(bare)


def address(alias: Column, domain: str) -> Column:
    """Mail address, null when the alias is null."""
    return F.concat(alias, F.lit(domain))


def responsible_manager(alias: Column, manager: Column, sr_manager: Column) -> Column:
    """The manager, or the senior manager of somebody who is their own manager.

    A null manager or alias takes the manager branch, which yields null or the
    manager as it stands.
    """
    return F.when(manager == alias, sr_manager).otherwise(manager)

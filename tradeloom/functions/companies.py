"""Company naming."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical group -> names that belong to it.
COMPANY_GROUPS: dict[str, tuple[str, ...]] = {
    "COMPANY_GROUP_002": ("COMPANY_045", "COMPANY_GROUP_002"),
    "COMPANY_GROUP_001": ("COMPANY_001", "COMPANY_070", "COMPANY_GROUP_001"),
}


def join_key(column: Column) -> Column:
    """Case- and space-insensitive comparison key."""
    return F.upper(F.trim(column))


def canonical_company(
    column: Column, groups: Mapping[str, Sequence[str]] = COMPANY_GROUPS
) -> Column:
    """Trim and upper-case a company name and fold group members into their group."""
    name = join_key(column.cast("string"))
    members = {member: group for group, names in groups.items() for member in names}
    if not members:
        return name
    lookup = F.create_map(*[F.lit(part) for pair in members.items() for part in pair])
    return F.coalesce(F.try_element_at(lookup, name), name)


def company_from_landing_name(table_name: str) -> str:
    """Company named by a landing table, e.g. ``landing_company_040`` -> ``COMPANY_040``."""
    return table_name.removeprefix("landing_").upper()

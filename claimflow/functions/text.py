"""Text predicates on benefit names and the supplement merge key.

Pattern tests are null-safe: a missing name matches nothing (it is never
null itself), so a negated test keeps rows with a missing name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The benefit-name fragments the reports classify on.
INCOME_PROTECTION = "Income Protection"
SUPER_CONTRIBUTION = "Super Contribution"
ADDITIONAL_SUPER_CONTRIBUTION = "Additional Super Contribution"
ADDITIONAL = "Additional"


def grepl(c: Column, pattern: str) -> Column:
    """Regex match that is false, not null, on a missing value."""
    return F.coalesce(c.rlike(pattern), F.lit(False))


def contains(c: Column, text: str) -> Column:
    return F.coalesce(c.contains(text), F.lit(False))


def starts(c: Column, text: str) -> Column:
    return F.coalesce(c.startswith(text), F.lit(False))


def is_income_protection(name: Column) -> Column:
    return contains(name, INCOME_PROTECTION)


def is_super_contribution(name: Column) -> Column:
    """Name starts with 'Super Contribution'."""
    return starts(name, SUPER_CONTRIBUTION)


def mentions_super_contribution(name: Column) -> Column:
    """Name contains 'Super Contribution' anywhere."""
    return contains(name, SUPER_CONTRIBUTION)


def is_additional_super_contribution(name: Column) -> Column:
    """Name contains 'Additional Super Contribution'."""
    return contains(name, ADDITIONAL_SUPER_CONTRIBUTION)


def starts_additional(name: Column) -> Column:
    """Name starts with 'Additional' (no space required)."""
    return starts(name, ADDITIONAL)


def is_additional_benefit(name: Column) -> Column:
    """'Additional ' followed by anything but 'Super Contribution'.

    The same set as the regex ``^Additional (?!(Super Contribution))``,
    written with prefix tests so it stays a cheap codegen'd comparison.
    """
    return starts(name, ADDITIONAL + " ") & ~starts(name, ADDITIONAL_SUPER_CONTRIBUTION)


def is_primary_benefit(name: Column) -> Column:
    """Neither a super contribution of any kind nor an 'Additional...' benefit."""
    return ~mentions_super_contribution(name) & ~starts_additional(name)


def add_aux(name: Column) -> Column:
    """'add' when the name contains 'Additional', else 'nonadd'."""
    return F.when(contains(name, ADDITIONAL), "add").otherwise("nonadd")


def merge_key(claim: Column, date_incurred: Column, category: Column) -> Column:
    """``claim-date-category``; a missing part prints as ``NA`` so missing parts
    match each other, as the key is compared as text."""
    na = F.lit("NA")
    return F.concat_ws(
        "-",
        F.coalesce(claim, na),
        F.coalesce(date_incurred.cast("string"), na),
        F.coalesce(category, na),
    )

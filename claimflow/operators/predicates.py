"""Row predicates of the extracts and reports.

Extract predicates follow relationship-query semantics: ``<>`` keeps rows
whose field is missing and ``= ''`` also matches a missing field.  Report
predicates follow the data-frame semantics: a condition that evaluates to
null drops the row, exactly as a Spark ``filter`` does.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the extract filters.
GROUP_BUSINESS = "Group"
CLAIM_TYPES_IN_SCOPE = ("Claim", "Post Claim")
INCOMPLETE_CLAIM = "Incomplete"
SUSPENDED_BENEFIT = "Suspended"
EXCLUDED_CLOSED_REASONS = (
    "Duplicate Claim in the Administration System",
    "Not a Legitimate Benefit",
)
PROCESSED_PAYMENT = "Processed"
DIAGNOSIS_TYPES = ("Primary", "Cause of Death")
CLOSED_STATUS = "Closed"


def is_group_business(business_type: Column) -> Column:
    return business_type == GROUP_BUSINESS


def claim_type_in_scope(claim_type: Column) -> Column:
    return claim_type.isin(*CLAIM_TYPES_IN_SCOPE)


def differs_from(c: Column, value: str) -> Column:
    """Extract-side ``<>``: a missing field counts as different."""
    return ~c.eqNullSafe(F.lit(value))


def reported_by(rep_end: dt.date, *dates: Column) -> Column:
    """Any of the dates on or before ``rep_end`` (missing dates do not count)."""
    cond = None
    for d in dates:
        term = d <= F.lit(rep_end)
        cond = term if cond is None else cond | term
    return cond


def closed_reason_in_scope(reason: Column) -> Column:
    """Not one of the excluded reasons; a blank or missing reason is kept."""
    return reason.isNull() | (reason == "") | ~reason.isin(*EXCLUDED_CLOSED_REASONS)


def open_at(status: Column, closure: Column, rep_end: dt.date) -> Column:
    """Not closed, or closed without a closure date, or closed after ``rep_end``.

    Three-valued: a missing status with a past closure date is dropped.
    """
    return (status != CLOSED_STATUS) | closure.isNull() | (closure > F.lit(rep_end))


def released_from(release: Column, rep_start: dt.date,
                  release_month: Column | None = None) -> Column:
    """Released on or after ``rep_start``.  With ``release_month`` (the first
    day of the release month, a partition column of the extract) the implied
    month bound is added so whole month folders are pruned before reading; a
    source that does not fill the month loses no row by it."""
    cond = release >= F.lit(rep_start)
    if release_month is not None:
        cond = cond & (release_month.isNull() | (release_month >= F.lit(rep_start.replace(day=1))))
    return cond


def processed_by(status: Column, release: Column, rep_end: dt.date,
                 release_month: Column | None = None) -> Column:
    """Processed and released on or before ``rep_end`` (month bound as in
    :func:`released_from`)."""
    cond = (status == PROCESSED_PAYMENT) & (release <= F.lit(rep_end))
    if release_month is not None:
        cond = cond & (release_month.isNull() | (release_month <= F.lit(rep_end.replace(day=1))))
    return cond


def diagnosis_type_in_scope(kind: Column) -> Column:
    return kind.isin(*DIAGNOSIS_TYPES)

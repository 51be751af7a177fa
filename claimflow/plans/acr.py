"""Payments report: every payment contribution of in-scope claims released
from the period start, with its claim context and latest diagnosis."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..operators.audit import StageTaps, no_tap
from ..operators.relate import rename_select
from ..sources.sinks import write_report
from ..functions.casts import as_date, as_number, as_text
from ..sources.extracts import acr_base
from .lookups import diagnosis_fields, with_latest_diagnosis

# Report columns in output order -> internal column.
ACR_COLUMNS = (
    ("Policy", "policy_name"),
    ("Product", "product_name"),
    ("Scheme Number", "scheme_number"),
    ("Scheme Name", "scheme_name"),
    ("Organisation", "organisation"),
    ("Case Number", "claim_name"),
    ("Legacy PAS Member Number", "legacy_member_number"),
    ("Super Fund Member Number", "member_number"),
    ("PAS Member Number", "pas_member_id"),
    ("First Name", "first_name"),
    ("Last Name", "last_name"),
    ("Date Of Birth", "birthdate"),
    ("Benefit Category", "benefit_category"),
    ("Gender", "gender"),
    ("Date Incurred", "date_incurred"),
    ("Super/Non Super", "in_super"),
    ("Waiting Period", "waiting_period"),
    ("Waiting Units", "waiting_units"),
    ("Annual Sum Insured", "annual_sum_insured"),
    ("Payment Contribution", "contribution_name"),
    ("PAYG Amount", "amount"),
    ("Payment Status", "payment_status"),
    ("PAS Reference Number", "payment_pas_reference"),
    ("Payment Processed Date", "payment_release"),
    ("Payment Date: From", "payment_start"),
    ("Payment Start", "start"),
    ("Payment End", "through"),
    ("System Closure Date", "closure_date"),
    ("Source of Claim", "source_of_claim"),
    ("Date Notified of Claim", "notification_date"),
    ("GSC Benefit Period", "benefit_period"),
    ("Expected Closure Date", "expected_closure"),
    ("End of Benefit Period", "end_of_benefit_period"),
    ("ICD10", "medical_code"),
)
# Columns the report leaves as extract text.
ACR_TEXT_COLUMNS = ("date_of_disability", "payment_release", "start", "through", "closure_date")


def acr_frame(tables: Mapping[str, DataFrame], rep_start: dt.date,
              tap: Callable = no_tap) -> DataFrame:
    """ACR rows with internal column names (casts, diagnosis and measures applied)."""
    t = with_latest_diagnosis(tables)
    df = acr_base(t, rep_start, extra=diagnosis_fields("benefit_claimed.claim"))
    df = tap("acr_base", df, no_diagnosis=F.count_if(
        F.coalesce(F.col("description"), F.col("duration_factor"),
                   F.col("medical_code")).isNull()))
    df = as_date(df, ["notification_date"])
    df = as_number(df, ["waiting_period", "amount", "coverage_amount"])
    df = df.withColumns({c: as_text(F.col(c)) for c in ACR_TEXT_COLUMNS})
    return df.withColumns({
        "annual_sum_insured": M.annual_sum_insured(F.col("coverage_amount"),
                                                   F.col("benefit_name")),
        "source_of_claim": M.source_of_claim(F.col("description"), F.col("duration_factor"),
                                             F.col("medical_code")),
        "date_incurred": F.col("date_of_disability"),
    })


def acr_report(tables: Mapping[str, DataFrame], rep_start: dt.date,
               rep_end: dt.date | None = None, tap: Callable = no_tap) -> DataFrame:
    """The 34-column payments report.  ``rep_end`` only names the output file."""
    return rename_select(acr_frame(tables, rep_start, tap), ACR_COLUMNS)


def run_acr(tables: Mapping[str, DataFrame], rep_start: dt.date, rep_end: dt.date,
            targets: Sequence[str]) -> list[tuple[str, str, int]]:
    """Write the payments report to every target; return the stage audit."""
    taps = StageTaps()
    rows = write_report(acr_report(tables, rep_start, rep_end, taps), targets)
    return taps.results() + [("acr_report", "rows", rows)]

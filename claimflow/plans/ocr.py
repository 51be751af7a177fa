"""Open-claims report: open benefits claimed at the period end, supplementary
benefits folded into their primary benefit, orphans kept."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..operators.relate import rename_select
from ..functions.casts import as_date, as_number, date_column
from ..functions.text import merge_key
from ..operators import predicates as P
from ..operators.audit import StageTaps, no_tap
from ..operators.supplements import fold, heavy_keys, orphans
from ..session import materialize, staging_scope
from ..sources.sinks import write_report
from ..sources.extracts import benefits_in_scope, ocr_base
from ..operators.rollup import measure_columns
from .lookups import diagnosis_fields, payment_states_by_name, with_latest_diagnosis

# Report columns in output order -> internal column.
OCR_COLUMNS = (
    ("Product Variant", "product_name"),
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
    ("Date Joined Fund", "date_joined_fund"),
    ("Benefit Name", "benefit_name"),
    ("Benefit Category", "benefit_category"),
    ("Case Status", "claim_status"),
    ("BC Status", "status"),
    ("Closed Reason", "closed_reason"),
    ("Closed Reason Category", "benefit_status_recorded"),
    ("Gender", "gender"),
    ("Date Incurred", "date_incurred"),
    ("Waiting Period", "waiting_period"),
    ("Waiting Period Extension", "waiting_period_extension"),
    ("Waiting Period Total", "waiting_period_total"),
    ("Waiting Units", "waiting_units"),
    ("Total PAYG", "total_paid"),
    ("Total Claim Start Day (GSC)", "gsc_start"),
    ("Total Claim End Day (GSC)", "gsc_end"),
    ("No. of Days on Claim (GSC)", "gsc_days"),
    ("Effective Date of Latest Payment", "eff_date_last_payment"),
    ("Latest payment amount", "last_amount"),
    ("Sum Insured", "sum_insured"),
    ("BenefitAdd", "benefit_add"),
    ("BenefitSC", "benefit_sc"),
    ("BenefitSCAdd", "benefit_sc_add"),
    ("Sum Insured Combined", "sum_insured_combined"),
    ("Claim Assessor", "claim_owner"),
    ("Source of Claim", "source_of_claim"),
    ("Date Notified of Claim", "notification_date"),
    ("Date Received", "notification_date"),
    ("GSC Benefit Period", "benefit_period"),
    ("Next Indexation Date", "indexation_date"),
    ("Possible Reopened Claim", "reopened"),
    ("Expected Closure Date", "expected_closure"),
    ("Last Touched User", "last_modified_by"),
    ("End of Benefit Period", "end_of_benefit_period"),
    ("report run date", "report_run_date"),
    ("Policy", "policy_name"),
    ("BC", "name"),
    ("BenefitClaimedClosureDate__c", "closure_date"),
    ("ReopenedDate__c", "reopened_date"),
    ("Reoccurrence Date", "date_of_reoccurrence"),
    ("Reopened Reason", "reopened_reason"),
    ("ICD10", "medical_code"),
    ("CaseOwnerTeam", "claim_team"),
)


def ocr_typed(tables: Mapping[str, DataFrame], rep_end: dt.date,
              rows: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """OCR extract with casts, derived key columns, and the latest diagnosis; columns
    of ``rows`` beyond the benefit's own stay if they are in ``keep``."""
    t = with_latest_diagnosis(tables)
    df = ocr_base(t, rep_end, extra={**diagnosis_fields("claim"), **{c: c for c in keep}}, rows=rows)
    df = as_date(df, ["reopened_date", "date_of_disability", "notification_date"])
    df = as_date(df, ["closure_date", "reopened_date", "date_of_reoccurrence"])
    df = as_number(df, ["waiting_period", "waiting_period_extension", "coverage_amount"])
    df = df.withColumns({
        "date_incurred": F.col("date_of_disability"),
        "waiting_period_total": M.waiting_period_total(F.col("waiting_period"),
                                                       F.col("waiting_period_extension")),
    })
    return df.withColumn("sc_key", merge_key(F.col("claim_name"), F.col("date_incurred"),
                                             F.col("benefit_category")))


def ocr_open(tables: Mapping[str, DataFrame], rep_end: dt.date,
             tap: Callable = no_tap) -> DataFrame:
    """Open rows.  Scope and openness are tested (and counted) on the benefit rows
    with the claim's tested fields alone; only open rows meet the wide parents."""
    rows = tap("ocr_base", benefits_in_scope(tables, rep_end))
    rows = tap("open_at", rows.filter(P.open_at(F.col("status"), date_column(rows, "closure_date"),
                                                rep_end)))
    return ocr_typed(tables, rep_end, rows)


def ocr_clean(tables: Mapping[str, DataFrame], rep_end: dt.date,
              tap: Callable = no_tap, states: DataFrame | None = None) -> DataFrame:
    """Open benefits with their payment rollup (and latest diagnosis), joined by
    benefit-claimed name; a missing name meets the rollup of the missing name."""
    return with_payments(tables, rep_end, ocr_open(tables, rep_end, tap), tap, states)


def with_payments(tables: Mapping[str, DataFrame], rep_end: dt.date, df: DataFrame,
                  tap: Callable = no_tap, states: DataFrame | None = None) -> DataFrame:
    """Open benefits with the rollup of their name; ``states``: the rollup, staged before."""
    states = payment_states_by_name(tables, rep_end) if states is None else states
    joined = df.join(states, df["name"].eqNullSafe(states["benefit_claimed_name"]), "left")
    clean = joined.select(*[df[c] for c in df.columns], *measure_columns())
    return tap("ocr_with_payments", clean,
               unmatched=F.count_if(F.col("eff_date_last_payment").isNull()))


def apply_measures(df: DataFrame, rep_end: dt.date) -> DataFrame:
    """Report measures, in dependency order: the combined sum insured reads the
    already IP-flagged super-contribution cover, so it is a separate step."""
    name = F.col("benefit_name")
    df = df.withColumn("benefit_sc", M.sc_cover_for_income_protection(F.col("benefit_sc"), name))
    df = df.withColumns({
        "sum_insured": F.col("coverage_amount"),
        "sum_insured_combined": M.sum_insured_combined(
            F.col("coverage_amount"), F.col("benefit_add"), F.col("benefit_sc"),
            F.col("benefit_sc_add"), name),
    })
    df = df.withColumn("total_paid", M.total_payg(F.col("total_paid"), F.col("total_paid_sc")))
    return df.withColumns({
        "source_of_claim": M.source_of_claim(F.col("description"), F.col("duration_factor"),
                                             F.col("medical_code")),
        "gsc_start": M.income_protection_only(F.col("first_payment"), name),
        "gsc_end": M.income_protection_only(F.col("last_payment"), name),
        "gsc_days": M.days_on_claim(F.col("first_payment"), F.col("last_payment"), name),
        "report_run_date": F.lit(rep_end),
    })


def ocr_frame(tables: Mapping[str, DataFrame], rep_end: dt.date,
              tap: Callable = no_tap) -> DataFrame:
    """Folded + orphan rows with measures, internal column names.

    The open-claims frame feeds eleven branches of the fold (lefts, lookups,
    the orphan test), so it is materialized once (a staged parquet table)
    instead of being recomputed, joins and rollups included, per branch.  So is the
    rollup, before it: the payments' shuffle files are gone when the wide joins begin.
    """
    states = materialize(payment_states_by_name(tables, rep_end), "ocr_rollup")
    clean = materialize(ocr_clean(tables, rep_end, tap, states), "ocr_open_claims")
    primary, other = heavy_keys(clean)
    folded = tap("supplement_fold", fold(clean, heavy=primary))
    orphan_rows = tap("orphan_supplements", orphans(clean, heavy=other))
    return apply_measures(folded.unionByName(orphan_rows), rep_end)


def ocr_report(tables: Mapping[str, DataFrame], rep_end: dt.date,
               tap: Callable = no_tap) -> DataFrame:
    """The 54-column open-claims report."""
    return rename_select(ocr_frame(tables, rep_end, tap), OCR_COLUMNS)


def run_ocr(tables: Mapping[str, DataFrame], rep_end: dt.date,
            targets: Sequence[str]) -> list[tuple[str, str, int]]:
    """Write the open-claims report to every target; return the stage audit
    ``(stage, metric, value)`` gathered during the run (no extra jobs).
    The staged open-claims table is deleted once the report is written."""
    taps = StageTaps()
    spark = tables["claim"].sparkSession
    with staging_scope(spark):
        rows = write_report(ocr_report(tables, rep_end, taps), targets)
    return taps.results() + [("ocr_report", "rows", rows)]

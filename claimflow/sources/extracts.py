"""The four extracts: relationship paths + extract predicates + projection.

Each extract is the flat frame a relationship query returns: fields named by
their path from the fact object, filtered server-side.  Here the filters are
ordinary DataFrame filters over :func:`relate`'s left joins; Catalyst pushes
fact-side predicates into the fact scan, pushes parent-side predicates into
the parent, and turns a left join whose parent column is tested (e.g. the
claim's business type) into an inner join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import as_date, as_number, date_column
from ..operators import predicates as P
from ..operators.relate import relate

PAYMENT_FIELDS = {
    "benefit_claimed_name": "benefit_claimed.name",
    "contribution_name": "name",
    "amount": "amount",
    "start": "start",
    "through": "through",
    "release": "payment.release",
    "claim_name": "benefit_claimed.claim.name",
    "line_number": "line_number",
}

DIAGNOSIS_FIELDS = {
    "name": "name",
    "medical_code": "medical_code",
    "description": "description",
    "duration_factor": "duration_factor",
    "type": "type",
    "claim_name": "journal.claim.name",
    "start": "start",
    "created": "created",
}

OCR_FIELDS = {
    "product_name": "product_name",
    "scheme_number": "claim.policy.scheme.number",
    "scheme_name": "claim.policy.scheme.name",
    "organisation": "claim.policy.scheme.organisation.name",
    "legacy_member_number": "claim.policy.legacy_member_number",
    "policy_name": "claim.policy.name",
    "member_number": "claim.policy.member_number",
    "pas_member_id": "claim.policy.pas_member_id",
    "first_name": "claim.claimant.first_name",
    "last_name": "claim.claimant.last_name",
    "birthdate": "claim.claimant.birthdate",
    "date_joined_fund": "claim.policy.date_joined_fund",
    "benefit_category": "benefit.category",
    "gender": "claim.claimant.gender",
    "date_of_disability": "date_of_disability",
    "waiting_period": "waiting_period",
    "waiting_period_extension": "waiting_period_extension",
    "waiting_units": "waiting_units",
    "coverage_amount": "coverage_amount",
    "benefit_status_recorded": "benefit_status_recorded",
    "status": "status",
    "closed_reason": "closed_reason",
    "claim_status": "claim.status",
    "claim_owner": "claim.owner.name",
    "notification_date": "notification_date",
    "benefit_period": "benefit_period",
    "indexation_date": "indexation_date",
    "reopened": "reopened",
    "expected_closure": "expected_closure",
    "last_modified_by": "modified_by.name",
    "end_of_benefit_period": "end_of_benefit_period",
    "name": "name",
    "claim_name": "claim.name",
    "reopened_reason": "reopened_reason",
    "closure_date": "closure_date",
    "reopened_date": "reopened_date",
    "benefit_name": "benefit.name",
    "date_of_reoccurrence": "date_of_reoccurrence",
    "claim_team": "claim.team",
}

ACR_FIELDS = {
    "product_name": "benefit_claimed.product_name",
    "scheme_number": "benefit_claimed.claim.policy.scheme.number",
    "scheme_name": "benefit_claimed.claim.policy.scheme.name",
    "organisation": "benefit_claimed.claim.policy.scheme.organisation.name",
    "legacy_member_number": "benefit_claimed.claim.policy.legacy_member_number",
    "policy_name": "benefit_claimed.claim.policy.name",
    "member_number": "benefit_claimed.claim.policy.member_number",
    "pas_member_id": "benefit_claimed.claim.policy.pas_member_id",
    "first_name": "benefit_claimed.claim.claimant.first_name",
    "last_name": "benefit_claimed.claim.claimant.last_name",
    "birthdate": "benefit_claimed.claim.claimant.birthdate",
    "benefit_category": "benefit_claimed.benefit.category",
    "gender": "benefit_claimed.claim.claimant.gender",
    "date_of_disability": "benefit_claimed.date_of_disability",
    "waiting_period": "benefit_claimed.waiting_period",
    "waiting_units": "benefit_claimed.waiting_units",
    "coverage_amount": "benefit_claimed.coverage_amount",
    "notification_date": "benefit_claimed.notification_date",
    "benefit_period": "benefit_claimed.benefit_period",
    "expected_closure": "benefit_claimed.expected_closure",
    "end_of_benefit_period": "benefit_claimed.end_of_benefit_period",
    "closure_date": "benefit_claimed.closure_date",
    "in_super": "benefit_claimed.claim.policy.in_super",
    "claim_name": "benefit_claimed.claim.name",
    "benefit_name": "benefit_claimed.benefit.name",
    "contribution_name": "name",
    "amount": "amount",
    "start": "start",
    "through": "through",
    "payment_start": "payment.start",
    "payment_release": "payment.release",
    "payment_status": "payment.status",
    "payment_pas_reference": "payment.pas_reference",
}


def _hidden(fields: Mapping[str, str]) -> dict[str, str]:
    return {"_" + k: v for k, v in fields.items()}


def payments_extract(tables: Mapping[str, DataFrame], rep_end: dt.date) -> DataFrame:
    """Processed payments of group claims released up to ``rep_end`` (all history)."""
    df = relate(tables, "payment_contribution", {**PAYMENT_FIELDS, **_hidden({
        "business_type": "benefit_claimed.claim.business_type",
        "payment_status": "payment.status",
        "release_month": "payment.release_month"})})
    df = as_date(as_number(df, ["amount"]), ["start", "through", "release"])
    df = df.filter(P.is_group_business(F.col("_business_type"))
                   & P.processed_by(F.col("_payment_status"), F.col("release"), rep_end,
                                    F.col("_release_month")))
    return df.drop("_business_type", "_payment_status", "_release_month")


def diagnosis_extract(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Primary / cause-of-death diagnoses of group claims."""
    df = relate(tables, "diagnosis", {**DIAGNOSIS_FIELDS, **_hidden({
        "business_type": "journal.claim.business_type"})})
    df = df.filter(P.diagnosis_type_in_scope(F.col("type"))
                   & P.is_group_business(F.col("_business_type"))).drop("_business_type")
    return as_date(df, ["start", "created"])


OCR_SCOPE_FIELDS = {
    "business_type": "claim.business_type",
    "claim_type": "claim.claim_type",
    "scope_claim_status": "claim.status",
    "form_received": "claim.form_received",
}


def benefits_in_scope(tables: Mapping[str, DataFrame], rep_end: dt.date) -> DataFrame:
    """The benefit-claimed rows of the open-claims extract, their own columns only.

    Reads of the parents just the claim fields that are tested, so that whatever
    is filtered next is filtered before the wide parents are joined.
    """
    own = {c: c for c in tables["benefit_claimed"].columns}
    df = relate(tables, "benefit_claimed", {**own, **_hidden(OCR_SCOPE_FIELDS)})
    df = df.filter(
        P.is_group_business(F.col("_business_type"))
        & P.claim_type_in_scope(F.col("_claim_type"))
        & P.differs_from(F.col("_scope_claim_status"), P.INCOMPLETE_CLAIM)
        & P.differs_from(F.col("status"), P.SUSPENDED_BENEFIT)
        & P.reported_by(rep_end, date_column(df, "_form_received"),
                        date_column(df, "initial_under_assessment"),
                        date_column(df, "notification_date"))
        & P.closed_reason_in_scope(F.col("closed_reason")))
    return df.drop(*_hidden(OCR_SCOPE_FIELDS))


def ocr_base(tables: Mapping[str, DataFrame], rep_end: dt.date,
             extra: Mapping[str, str] | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Benefits claimed of in-scope group claims, reported by ``rep_end``.

    ``rows`` are :func:`benefits_in_scope`, already filtered further.
    """
    fact = benefits_in_scope(tables, rep_end) if rows is None else rows
    return relate(tables, "benefit_claimed", {**OCR_FIELDS, **(extra or {})}, fact=fact)


def acr_base(tables: Mapping[str, DataFrame], rep_start: dt.date,
             extra: Mapping[str, str] | None = None) -> DataFrame:
    """Payment contributions of in-scope group claims released from ``rep_start``
    (open-ended: there is no upper bound on the release date)."""
    df = relate(tables, "payment_contribution", {**ACR_FIELDS, **(extra or {}), **_hidden({
        "business_type": "benefit_claimed.claim.business_type",
        "claim_type": "benefit_claimed.claim.claim_type",
        "claim_status": "benefit_claimed.claim.status",
        "release_month": "payment.release_month"})})
    df = df.filter(
        P.is_group_business(F.col("_business_type"))
        & P.claim_type_in_scope(F.col("_claim_type"))
        & P.differs_from(F.col("_claim_status"), P.INCOMPLETE_CLAIM)
        & P.released_from(date_column(df, "payment_release"), rep_start, F.col("_release_month")))
    return df.drop("_business_type", "_claim_type", "_claim_status", "_release_month")

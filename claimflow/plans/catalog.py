"""Registered queries: one per operator group, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables under ``sf_dir`` (through the fixture
mapping) in full; none samples, caps or subsets rows.  Those that read payments once join
them as they lie: writing a store (:mod:`claimflow.sources.store`) for one read moves more
than the join.  The queries of whole relationships read such a store.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.casts import as_date, as_number, prior_month_end
from ..operators import predicates as P
from ..operators.integrity import hop_integrity
from ..operators.relate import relate
from ..operators.supplements import SUPPLEMENT_COLUMNS, fold, fold_with_orphans, orphans
from ..session import delete_path, materialize, once, scratch_path, staging_scope
from ..sources import extracts as X
from ..sources.fixtures import (REP_END, REP_START, broken_entities, entities, payment_text_extract,
                                read_driver_table, stored_entities, text_entities)
from ..sources.months import write_months
from ..sources.rejects import rejects, staged_with_rejects
from ..sources.sinks import read_csv, write_report
from . import acr, ocr, stages
from .lookups import latest_diagnosis, payment_rollup
from .months import MonthStates, rollup_of_months

Query = Callable[[SparkSession, str], DataFrame]

RELATE_FIELDS = {
    "contribution_name": "name",
    "payment_name": "payment.name",
    "benefit_claimed_name": "benefit_claimed.name",
    "claim_name": "benefit_claimed.claim.name",
    "policy_name": "benefit_claimed.claim.policy.name",
    "scheme_number": "benefit_claimed.claim.policy.scheme.number",
    "organisation": "benefit_claimed.claim.policy.scheme.organisation.name",
    "benefit_name": "benefit_claimed.benefit.name",
    "claimant_last_name": "benefit_claimed.claim.claimant.last_name",
    "claim_owner": "benefit_claimed.claim.owner.name",
}


def _measured(spark: SparkSession, sf: str) -> DataFrame:
    return ocr.ocr_frame(entities(spark, sf), REP_END)


def relate_paths(spark, sf):
    return relate(stored_entities(spark, sf), "payment_contribution", RELATE_FIELDS)


def payments_extract(spark, sf):
    return X.payments_extract(entities(spark, sf), REP_END)


def diagnosis_extract(spark, sf):
    return X.diagnosis_extract(entities(spark, sf))


def ocr_base(spark, sf):
    return X.ocr_base(entities(spark, sf), REP_END)


def acr_base(spark, sf):
    return X.acr_base(entities(spark, sf), REP_START)


def typed_casts(spark, sf):
    df = payment_text_extract(entities(spark, sf))
    df = df.withColumns({"amount": F.col("amount_text"), "release": F.col("release_text")})
    df = as_date(as_number(df, ["amount"]), ["release"])
    return df.select("contribution_name", "line_number", "amount_text", "amount",
                     "release_text", "release")


def prior_month_end_q(spark, sf):
    orders = read_driver_table(spark, sf, "orders")
    d = F.col("o_orderdate").cast("date")
    return orders.select("o_orderkey", d.alias("order_date"),
                         prior_month_end(d).alias("prior_month_end"))


def reported_by(spark, sf):
    df = relate(entities(spark, sf), "benefit_claimed", {
        "name": "name", "form_received": "claim.form_received",
        "initial_under_assessment": "initial_under_assessment",
        "notification_date": "notification_date"})
    return df.filter(P.reported_by(REP_END, F.col("form_received"),
                                   F.col("initial_under_assessment"),
                                   F.col("notification_date")))


def closed_reason(spark, sf):
    bc = entities(spark, sf)["benefit_claimed"]
    return bc.filter(P.closed_reason_in_scope(F.col("closed_reason"))).select(
        "name", "closed_reason")


def open_at(spark, sf):
    return ocr.ocr_open(entities(spark, sf), REP_END).select("name", "status", "closure_date")


def benefit_class(spark, sf):
    df = relate(entities(spark, sf), "benefit_claimed",
                {"name": "name", "benefit_name": "benefit.name"})
    n = F.col("benefit_name")
    return df.select(
        "name", "benefit_name",
        text.is_primary_benefit(n).alias("is_primary"),
        text.is_super_contribution(n).alias("is_super_contribution"),
        text.is_additional_super_contribution(n).alias("is_additional_super_contribution"),
        text.is_additional_benefit(n).alias("is_additional_benefit"),
        text.starts_additional(n).alias("starts_additional"),
        text.is_income_protection(n).alias("is_income_protection"),
        text.add_aux(n).alias("add_aux"))


def merge_key(spark, sf):
    return ocr.ocr_typed(entities(spark, sf), REP_END).select("name", "sc_key")


def payment_rollup_q(spark, sf):
    return payment_rollup(entities(spark, sf), REP_END)


def payment_rollup_months(spark, sf):
    """The rollup from kept month states: all months once, then two months that were loaded again."""
    t = entities(spark, sf)
    source, root = scratch_path(spark, "months"), scratch_path(spark, "month-states")
    try:
        write_months(t, source)
        kept = MonthStates(spark, root, source)
        months = kept.update()
        write_months(t, source, months[-2:])
        kept.update()
        return once(rollup_of_months(t, kept, REP_END), "payment_rollup_months")
    finally:
        delete_path(spark, source)
        delete_path(spark, root)


def ocr_with_payments(spark, sf):
    return ocr.ocr_clean(entities(spark, sf), REP_END).select(
        "name", "total_paid", "first_payment", "last_payment", "last_amount",
        "eff_date_last_payment")


def latest_diagnosis_q(spark, sf):
    return latest_diagnosis(entities(spark, sf))


def latest_diagnosis_join(spark, sf):
    return acr.acr_frame(entities(spark, sf), REP_START).select(
        "contribution_name", "claim_name", "medical_code", "description", "duration_factor")


def source_of_claim(spark, sf):
    return acr.acr_frame(entities(spark, sf), REP_START).select(
        "contribution_name", "source_of_claim")


def waiting_total(spark, sf):
    return ocr.ocr_typed(entities(spark, sf), REP_END).select(
        "name", "waiting_period", "waiting_period_extension", "waiting_period_total")


def annual_sum_insured(spark, sf):
    return acr.acr_frame(entities(spark, sf), REP_START).select(
        "contribution_name", "benefit_name", "coverage_amount", "annual_sum_insured")


def supplement_fold(spark, sf):
    clean = ocr.ocr_clean(entities(spark, sf), REP_END)
    return fold(clean).select("name", "sc_key", *SUPPLEMENT_COLUMNS)


def orphan_supplements(spark, sf):
    clean = ocr.ocr_clean(entities(spark, sf), REP_END)
    return orphans(clean).select("name", "sc_key", "claim_name", "benefit_name",
                                 *SUPPLEMENT_COLUMNS)


def sum_insured(spark, sf):
    return _measured(spark, sf).select("name", "benefit_name", "sum_insured", "benefit_sc",
                                       "sum_insured_combined")


def total_payg(spark, sf):
    return _measured(spark, sf).select("name", F.col("total_paid").alias("total_payg"))


def gsc_days(spark, sf):
    return _measured(spark, sf).select("name", "gsc_start", "gsc_end", "gsc_days")


def stage_audit(spark, sf):
    t = entities(spark, sf)
    with staging_scope(spark):
        joined = materialize(stages.paid_contributions(t), "audit_contributions")
        return once(stages.stage_audit(t, REP_START, REP_END, payment_text_extract(t, joined), joined), "stage_audit")


def cast_rejects(spark, sf):
    """What the casts of text extracts lose, from the scan that the report reads."""
    with staging_scope(spark):
        return once(rejects(staged_with_rejects(text_entities(entities(spark, sf)))), "cast_rejects")


def hop_integrity_q(spark, sf):
    """Null and dangling keys per relationship, in a fixture that has some."""
    return hop_integrity(broken_entities(stored_entities(spark, sf)))


def csv_roundtrip(spark, sf):
    """ACR report written as CSV to the shared scratch folder and read back."""
    report = acr.acr_report(entities(spark, sf), REP_START, REP_END)
    path = scratch_path(spark, "csv_roundtrip")
    write_report(report, [path])
    return read_csv(spark, path, report.schema)


def acr_report(spark, sf):
    return acr.acr_report(entities(spark, sf), REP_START, REP_END)


def ocr_report(spark, sf):
    return ocr.ocr_report(entities(spark, sf), REP_END)


QUERIES: dict[str, Query] = {
    "relate_paths": relate_paths,
    "payments_extract": payments_extract,
    "diagnosis_extract": diagnosis_extract,
    "ocr_base": ocr_base,
    "acr_base": acr_base,
    "typed_casts": typed_casts,
    "prior_month_end": prior_month_end_q,
    "reported_by": reported_by,
    "closed_reason": closed_reason,
    "open_at": open_at,
    "benefit_class": benefit_class,
    "merge_key": merge_key,
    "payment_rollup": payment_rollup_q,
    "payment_rollup_months": payment_rollup_months,
    "ocr_with_payments": ocr_with_payments,
    "latest_diagnosis": latest_diagnosis_q,
    "latest_diagnosis_join": latest_diagnosis_join,
    "source_of_claim": source_of_claim,
    "waiting_total": waiting_total,
    "annual_sum_insured": annual_sum_insured,
    "supplement_fold": supplement_fold,
    "orphan_supplements": orphan_supplements,
    "sum_insured": sum_insured,
    "total_payg": total_payg,
    "gsc_days": gsc_days,
    "stage_audit": stage_audit,
    "cast_rejects": cast_rejects,
    "hop_integrity": hop_integrity_q,
    "csv_roundtrip": csv_roundtrip,
    "acr_report": acr_report,
    "ocr_report": ocr_report,
}

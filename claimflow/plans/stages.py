"""The stage audit: rows in and out, unmatched rows, lost casts and fan-out of every stage.

Payments are read once: contributions are numbered, joined to their payments and staged.
The text extract and the rollup read that table, and it meets its other parents as flags
alone; the flags that the extract, the rollup and the payments report test are staged,
and all their metrics come from that narrow table.  Of the open-claims frame the columns
that further stages read are staged, and each of them is one pass over it.  Every staged
table is a write of its own, so that the run holds the shuffle files of one at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import as_date, date_column, lost
from ..operators import audit as A
from ..operators import predicates as P
from ..operators.relate import relate
from ..operators.supplements import SUPPLEMENT_COLUMNS, fold, orphans
from ..session import materialize
from ..sources import extracts as X
from .lookups import DIAGNOSIS_PAYLOAD, diagnosis_fields, latest_diagnosis, payment_states_by_name, with_latest_diagnosis
from .ocr import ocr_typed, with_payments

# Of an open claim, what the fold, the orphans and the counts read.
OPEN_COLUMNS = ("claim_name", "sc_key", "benefit_name", "coverage_amount", "total_paid", "eff_date_last_payment")


def _lost(df: DataFrame, **kinds: tuple[str, ...]):
    """How many casts of a row lose their value."""
    flags = [lost(df, c, kind).isNotNull().cast("int") for kind, columns in kinds.items() for c in columns]
    return sum(flags[1:], flags[0])


def paid_contributions(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per numbered contribution and payment, with the payment's fields that stages test."""
    t = {**tables, "payment": tables["payment"].withColumn("found", F.lit(True))}
    own = (A.ROW, "name", "line_number", "amount", "start", "through", "benefit_claimed_id")
    return relate(t, "payment_contribution", {**{c: c for c in own}, **{
        c: f"payment.{c}" for c in ("status", "release", "release_month", "found")}}, fact=A.numbered(t["payment_contribution"]))


def payments_frame(tables: Mapping[str, DataFrame], rep_start: dt.date, rep_end: dt.date,
                   joined: DataFrame | None = None) -> DataFrame:
    """One row per contribution and parents, with what the stages of both reports test;
    ``joined``: :func:`paid_contributions`, staged before."""
    t = with_latest_diagnosis(tables)
    paid = paid_contributions(tables) if joined is None else joined
    claim, release = "benefit_claimed.claim", date_column(paid, "release")
    own = {"no_payment": F.col("found").isNull(), "processed": P.processed_by(F.col("status"), release, rep_end),
           "released": P.released_from(release, rep_start),
           "lost": _lost(paid, number=("amount",), date=("start", "through", "release"))}
    df = relate(t, "payment_contribution", {
        A.ROW: A.ROW, **{c: c for c in own}, "name": "benefit_claimed.name", "benefit": "benefit_claimed.id",
        "business_type": f"{claim}.business_type", "claim_type": f"{claim}.claim_type",
        "claim_status": f"{claim}.status", **diagnosis_fields(claim)},
        fact=paid.select(A.ROW, "benefit_claimed_id", *[c.alias(n) for n, c in own.items()]))
    group = P.is_group_business(F.col("business_type"))
    return df.select(
        A.ROW, "name", (F.col("no_payment") | F.col("benefit").isNull()).alias("unmatched"),
        F.coalesce(group & F.col("processed"), F.lit(False)).alias("extracted"),
        F.coalesce(group & P.claim_type_in_scope(F.col("claim_type"))
                   & P.differs_from(F.col("claim_status"), P.INCOMPLETE_CLAIM)
                   & F.col("released"), F.lit(False)).alias("reported"),
        F.coalesce(*[F.col(c) for c in DIAGNOSIS_PAYLOAD]).isNull().alias("no_diagnosis"), "lost")


def stage_audit(tables: Mapping[str, DataFrame], rep_start: dt.date, rep_end: dt.date,
                text_rows: DataFrame, joined: DataFrame | None = None) -> DataFrame:
    """(stage, metric, value) of both reports' stages; ``text_rows``: a text extract of payments
    (contribution_name, amount_text, release_text); ``joined``: :func:`paid_contributions`, if it is staged."""
    joined = materialize(paid_contributions(tables), "audit_contributions") if joined is None else joined
    paid = materialize(payments_frame(tables, rep_start, rep_end, joined), "audit_payments")
    states = materialize(payment_states_by_name(tables, rep_end, joined), "audit_rollup")
    extracted, reported = F.col("extracted"), F.col("reported")
    scoped = X.benefits_in_scope(tables, rep_end)
    is_open = P.open_at(F.col("status"), date_column(scoped, "closure_date"), rep_end)
    rows = A.numbered(scoped.filter(is_open))
    clean = with_payments(tables, rep_end, ocr_typed(tables, rep_end, rows, keep=[A.ROW]), states=states)
    clean = materialize(clean.select(A.ROW, *OPEN_COLUMNS), "audit_open_claims")
    dx = relate(tables, "diagnosis", {A.ROW: A.ROW, "type": "type", "journal": "journal.id", "start": "start", "created": "created",
                                      "business_type": "journal.claim.business_type"}, fact=A.numbered(tables["diagnosis"]))
    in_scope = F.coalesce(P.diagnosis_type_in_scope(F.col("type")) & P.is_group_business(F.col("business_type")), F.lit(False))
    diagnoses = materialize(dx.select(A.ROW, F.col("journal").isNull().alias("unmatched"), in_scope.alias("kept"),
                                      _lost(dx, date=("start", "created")).alias("lost")), "audit_diagnoses")
    alone = F.coalesce(*[F.col(c) for c in SUPPLEMENT_COLUMNS]).isNull()
    # both parts of the report, numbered alike, in one pass each
    both = materialize(fold(clean).select(A.ROW, F.lit(False).alias("orphan"), alone.alias("alone")).unionByName(
        orphans(clean).select(A.ROW, F.lit(True).alias("orphan"), alone.alias("alone"))), "audit_rows")
    return A.audit([
        A.counted("typed_casts", text_rows, amount_cast_nulls=lost(text_rows, "amount_text", "number").isNotNull(),
                  release_cast_nulls=lost(text_rows, "release_text", "date").isNotNull()),
        A.matched("payments_extract", paid, extracted, unmatched=F.col("unmatched"), cast_nulls=F.col("lost") > 0),
        A.counted("payment_rollup", paid.filter(extracted).groupBy("name").agg(F.count(F.lit(1)).alias("n"))),
        A.matched("acr_report", paid, reported, no_diagnosis=reported & F.col("no_diagnosis")),
        A.counted("benefit_claimed", tables["benefit_claimed"]),
        A.counted("ocr_base", scoped, cast_nulls=_lost(scoped, number=("coverage_amount", "waiting_period"), date=(
            "date_of_disability", "notification_date", "closure_date")) > 0),
        A.counted("open_at", scoped.filter(is_open)),
        A.matched("ocr_with_payments", clean, unmatched=F.col("eff_date_last_payment").isNull()),
        A.matched("diagnosis_extract", diagnoses, F.col("kept"), unmatched=F.col("unmatched"), cast_nulls=F.col("lost") > 0),
        A.counted("latest_diagnosis", latest_diagnosis(tables)),
        A.matched("supplement_fold", both.filter(~F.col("orphan")), unmatched=F.col("alone")),
        A.matched("orphan_supplements", both.filter("orphan"), unmatched=F.col("alone")),
        A.counted("ocr_report", both),
    ])

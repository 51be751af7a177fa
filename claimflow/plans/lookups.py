"""The two per-key lookups both reports join: payment rollup and latest diagnosis.

Both are aggregated *before* their join to the parent objects: payments are
dealt and reduced per benefit-claimed foreign key and diagnoses per journal foreign key
(map-side combinable states), the small state frames are joined to their
parents to get the grouping name and apply the group-business filter, and the
states are merged per name.  Of the big fact tables only the few columns that the
lookups read are shuffled.  Of the diagnoses only (journal, day) is reduced; texts are fetched for the latest day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import as_date, as_number
from ..operators import predicates as P
from ..operators.latest import attach_lookup, first_of_tied, latest_day
from ..operators.relate import relate
from ..operators.rollup import finish, merged, states

YEAR = "_year"
DIAGNOSIS_PAYLOAD = ("medical_code", "description", "duration_factor")


def _group_parents(tables: Mapping[str, DataFrame], entity: str, name_path: str,
                   business_path: str, name_as: str) -> DataFrame:
    df = relate(tables, entity, {"_id": "id", name_as: name_path, "_bt": business_path})
    return df.filter(P.is_group_business(F.col("_bt"))).drop("_bt")


def _processed(payments: DataFrame, rep_end: dt.date) -> DataFrame:
    payments = as_date(payments, ["release"])
    return payments.filter(P.processed_by(F.col("status"), F.col("release"), rep_end, F.col("release_month")))


def payment_states(tables: Mapping[str, DataFrame], rep_end: dt.date, joined: DataFrame | None = None) -> DataFrame:
    """Partial rollup states of processed payments, one row per benefit-claimed id.

    The payments are filtered and pruned to their release date first and joined
    to the contributions once.  The contributions are then dealt once, as narrow rows, by
    benefit and year: the first step of the rollup needs no other exchange, the second one
    gets a state or two per benefit, and a hot benefit is the work of as many tasks as it has
    years.  ``joined``: contributions with the fields of their payments, where a run has them.
    """
    if joined is None:
        paid = _processed(tables["payment"], rep_end).select(F.col("id").alias("_payment"), "release")
        pc = tables["payment_contribution"].select("benefit_claimed_id", "payment_id", "line_number", "amount", "start", "through")
        # merged at every size: what a run needs grows with the payments and not in steps, and no
        # task holds them all
        pc = pc.join(paid.hint("merge"), pc["payment_id"] == paid["_payment"])
    else:
        pc = _processed(joined, rep_end)
    pc = as_date(as_number(pc, ["amount"]), ["start", "through"])
    dealt = pc.select("benefit_claimed_id", F.year("release").alias(YEAR), "line_number", "amount", "start", "through",
                      "release").repartition("benefit_claimed_id", YEAR)
    return states(dealt, ["benefit_claimed_id"], F.col("amount"), F.col("start"), F.col("through"),
                  F.col("release"), F.col("line_number"), dealt=[YEAR])


def payment_states_by_name(tables: Mapping[str, DataFrame], rep_end: dt.date, joined: DataFrame | None = None) -> DataFrame:
    """:func:`payment_states` merged per benefit-claimed name (one state row per
    name, a missing name included): the payments extract groups by name."""
    per_id = payment_states(tables, rep_end, joined)
    parents = _group_parents(tables, "benefit_claimed", "name", "claim.business_type",
                             "benefit_claimed_name")
    joined = per_id.join(parents, per_id["benefit_claimed_id"] == parents["_id"])
    return merged(joined, ["benefit_claimed_name"])


def payment_rollup(tables: Mapping[str, DataFrame], rep_end: dt.date) -> DataFrame:
    """Rollup of the payments extract per benefit-claimed name."""
    return finish(payment_states_by_name(tables, rep_end), "benefit_claimed_name")


def latest_diagnosis(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Latest primary / cause-of-death diagnosis per group claim name.

    Order: ``coalesce(start, created)`` newest first, then diagnosis name.
    The latest day is found per journal and then per claim, on ids and days alone;
    only the diagnoses of that day are read with their texts.
    """
    dx = tables["diagnosis"].filter(P.diagnosis_type_in_scope(F.col("type")))
    dx = as_date(dx, ["start", "created"])
    dx = dx.select("journal_id", F.coalesce(F.col("start"), F.col("created")).alias("_day"), "name",
                   *DIAGNOSIS_PAYLOAD)
    parents = _group_parents(tables, "journal", "claim.name", "claim.business_type",
                             "claim_name")
    journals = latest_day(dx, "journal_id", "_day").join(parents, F.col("journal_id") == F.col("_id"))
    claims = latest_day(journals, "claim_name", "_day").toDF("_claim", "_last")
    winners = journals.join(claims, journals["claim_name"].eqNullSafe(claims["_claim"])
                            & (journals["_day"] == claims["_last"])) \
        .select(F.col("_id").alias("_journal"), "claim_name", "_last")
    tied = dx.join(winners, (dx["journal_id"] == winners["_journal"]) & (dx["_day"] == winners["_last"]))
    return first_of_tied(tied, "claim_name", "name", DIAGNOSIS_PAYLOAD)


def with_latest_diagnosis(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """``tables`` with the claim object carrying its latest diagnosis as
    ``dx_*`` fields.

    Joining the lookup (unique per claim name) to the claim *dimension* is the
    same as joining it to every fact row by the claim's name, but the large
    fact is then shuffled once (to its direct parent) instead of twice.
    """
    latest = latest_diagnosis(tables).select(
        F.col("claim_name").alias("_dx_claim"),
        *[F.col(c).alias("dx_" + c) for c in DIAGNOSIS_PAYLOAD])
    claim = attach_lookup(tables["claim"], latest, "name", "_dx_claim")
    return {**tables, "claim": claim}


def diagnosis_fields(claim_path: str) -> dict[str, str]:
    """relate() fields reading the attached diagnosis through ``claim_path``."""
    return {c: f"{claim_path}.dx_{c}" for c in DIAGNOSIS_PAYLOAD}

"""The values that the reports' casts lose: a rejects table beside the report.

A text extract delivers numbers and dates that do not parse; the reports read them as
missing.  :func:`with_rejects` keeps such values beside the row that had them, so an
object staged with them is scanned once: the report reads its columns, :func:`rejects`
the list (object, id, column, raw).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import lost
from ..session import materialize

# What the reports cast, by object.
CASTS: dict[str, dict[str, tuple[str, ...]]] = {
    "claim": {"date": ("form_received",)},
    "benefit_claimed": {
        "number": ("waiting_period", "waiting_period_extension", "coverage_amount"),
        "date": ("date_of_disability", "notification_date", "initial_under_assessment", "closure_date",
                 "reopened_date", "date_of_reoccurrence")},
    "payment_contribution": {"number": ("amount",), "date": ("start", "through")},
    "payment": {"date": ("release",)},
    "diagnosis": {"date": ("start", "created")},
}
REJECTS = "_rejects"


def with_rejects(df: DataFrame, name: str) -> DataFrame:
    """``df`` of object ``name`` with the column ``_rejects``: (column, raw) of what its casts lose."""
    found = [F.struct(F.lit(c).alias("column"), lost(df, c, kind).alias("raw"))
             for kind, columns in CASTS.get(name, {}).items() for c in columns]
    none = F.array().cast("array<struct<column:string,raw:string>>")
    kept = F.filter(F.array(*found), lambda r: r["raw"].isNotNull()) if found else none
    return df.withColumn(REJECTS, kept)


def staged_with_rejects(tables: Mapping[str, DataFrame], names: Iterable[str] = tuple(CASTS)) -> dict[str, DataFrame]:
    """``tables`` whose objects ``names`` were read once, into staged tables that carry their rejects."""
    return {**tables, **{n: materialize(with_rejects(tables[n], n), f"staged_{n}") for n in names}}


def rejects(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(object, id, column, raw) of all objects that carry their rejects; repeated rows count each.

    ``id`` is the object's id, or its name where it has none.
    """
    out = None
    for name, df in tables.items():
        if REJECTS not in df.columns:
            continue
        key = F.col("id" if "id" in df.columns else "name")
        rows = df.select(F.lit(name).alias("object"), key.alias("id"), F.explode(REJECTS).alias("r")).select(
            "object", "id", "r.column", "r.raw")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError("no object carries its rejects")
    return out

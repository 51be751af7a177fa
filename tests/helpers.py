"""Hand-made object tables with the declared schemas."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.operators.supplements import _lookup, _orphan_classes
from claimflow.sources.entities import SCHEMAS

D = dt.date.fromisoformat

# The driver's tables: smallest, and the size that the driver compares at.
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def make_tables(spark, **rows):
    """``make_tables(spark, claim=[{...}], ...)``; every object gets a table
    (empty when not given) and missing fields are null."""
    rows = {name: [dict(r) for r in rs] for name, rs in rows.items()}
    for k, r in enumerate(rows.get("payment_contribution", [])):
        # ``payment_*`` fields of a contribution stand for a payment of its own
        paid = {f.removeprefix("payment_"): r.pop(f) for f in list(r)
                if f.startswith("payment_") and f != "payment_id"}
        if paid:
            r["payment_id"] = f"P{k}"
            rows.setdefault("payment", []).append({"id": f"P{k}", **paid})
    out = {}
    for name, schema in SCHEMAS.items():
        data = [tuple(str(v) if isinstance(f.dataType, T.StringType) and isinstance(v, int) else v
                      for f in schema.fields for v in [r.get(f.name)])
                for r in rows.get(name, [])]
        out[name] = spark.createDataFrame(data, schema)
    return out


def clean_rows(spark, rows):
    """A minimal open-claims frame for the supplement fold and the measures."""
    cols = ["name", "claim_name", "sc_key", "benefit_name", "coverage_amount", "total_paid",
            "first_payment", "last_payment", "description", "duration_factor", "medical_code"]
    schema = ("name string, claim_name string, sc_key string, benefit_name string, "
              "coverage_amount double, total_paid double, first_payment date, "
              "last_payment date, description string, duration_factor string, "
              "medical_code string")
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)


def orphan_branches(clean):
    """The three orphan branches stacked, before the per-claim test: the definition
    that ``orphans`` is tested against."""
    stacked = None
    for left, right, cover_as, paid_as in _orphan_classes(F.col("benefit_name")):
        branch = clean.filter(left).join(
            _lookup(clean, right, "sc_key", "coverage_amount", "total_paid", cover_as, paid_as),
            "sc_key", "left")
        stacked = branch if stacked is None else stacked.unionByName(branch, allowMissingColumns=True)
    return stacked

"""Declared schemas of the CRM objects and their production reader.

One fixed ``StructType`` per object: a column that is entirely missing in an
extract is still present (all null) and no inference pass runs over the
data.  Extracts are folders of parquet (or CSV) files per object.  Ids are text;
date-like fields that the reports never cast are kept as text, as delivered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import parse_date

_S, _D, _F, _I = T.StringType(), T.DateType(), T.DoubleType(), T.IntegerType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "organisation": _schema(("id", _S), ("name", _S)),
    "scheme": _schema(("id", _S), ("number", _S), ("name", _S), ("organisation_id", _S)),
    "user": _schema(("id", _S), ("name", _S)),
    "policy": _schema(("id", _S), ("name", _S), ("legacy_member_number", _S),
                      ("member_number", _S), ("pas_member_id", _S), ("date_joined_fund", _S),
                      ("in_super", _S), ("scheme_id", _S)),
    "claimant": _schema(("id", _S), ("first_name", _S), ("last_name", _S), ("birthdate", _S),
                        ("gender", _S)),
    "claim": _schema(("id", _S), ("name", _S), ("status", _S), ("claim_type", _S),
                     ("business_type", _S), ("form_received", _D), ("team", _S),
                     ("policy_id", _S), ("claimant_id", _S), ("owner_id", _S)),
    "benefit": _schema(("id", _S), ("name", _S), ("category", _S)),
    "benefit_claimed": _schema(
        ("id", _S), ("name", _S), ("product_name", _S), ("status", _S), ("closed_reason", _S),
        ("benefit_status_recorded", _S), ("date_of_disability", _D), ("notification_date", _D),
        ("initial_under_assessment", _D), ("closure_date", _D), ("reopened_date", _D),
        ("date_of_reoccurrence", _D), ("waiting_period", _F), ("waiting_period_extension", _F),
        ("waiting_units", _S), ("coverage_amount", _F), ("benefit_period", _S),
        ("indexation_date", _S), ("reopened", _S), ("reopened_reason", _S),
        ("expected_closure", _S), ("end_of_benefit_period", _S), ("claim_id", _S),
        ("benefit_id", _S), ("modified_by_id", _S)),
    "payment_contribution": _schema(
        ("name", _S), ("line_number", _I), ("amount", _F), ("start", _D), ("through", _D),
        ("benefit_claimed_id", _S), ("payment_id", _S)),
    "payment": _schema(
        ("id", _S), ("name", _S), ("status", _S), ("release", _D), ("start", _S),
        ("pas_reference", _S), ("release_month", _D)),
    "journal": _schema(("id", _S), ("claim_id", _S)),
    "diagnosis": _schema(("name", _S), ("medical_code", _S), ("description", _S),
                         ("duration_factor", _S), ("type", _S), ("start", _D), ("created", _D),
                         ("journal_id", _S)),
}


# Columns without which an object's rows cannot be joined.
KEYS: dict[str, tuple[str, ...]] = {
    name: tuple(f.name for f in schema.fields if f.name == "id" or f.name.endswith("_id"))
    for name, schema in SCHEMAS.items()}
KEYS["policy"] = ("id", "scheme_id")  # pas_member_id is a field, no key

# Objects stored in one folder per value of a partition column.
PARTITION_COLUMNS = {"payment": "release_month"}

TEXT_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true", "enforceSchema": "false",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_entities(tables: dict[str, DataFrame], root: str, mode: str = "errorifexists") -> None:
    """Write every object to ``{root}/{object}`` as parquet; payments go to one
    folder per release month (derived from the release date, whatever the source
    filled in), so the extract predicates on the release date prune whole folders."""
    for name, df in tables.items():
        if name == "payment":
            df = df.withColumn("release_month", F.trunc(F.col("release"), "month"))
        writer = df.write.mode(mode)
        if name in PARTITION_COLUMNS:
            writer = writer.partitionBy(PARTITION_COLUMNS[name])
        writer.parquet(f"{root.rstrip('/')}/{name}")


def from_text(df: DataFrame, name: str) -> DataFrame:
    """An all-text extract as the object's columns, bound by header name.

    A column that the extract lacks (an all-empty one may be dropped on delivery) is
    null; a missing key column is an error, since nothing could be joined.  Dates and
    amounts stay text: the reports parse what they cast, with the tolerant parsers,
    and pass on the rest as delivered.  Integers that do not parse become null.
    """
    lost = [k for k in KEYS[name] if k not in df.columns]
    if lost:
        raise ValueError(f"{name} lacks the key columns {', '.join(lost)}")
    cols = []
    for f in SCHEMAS[name].fields:
        if f.name not in df.columns:
            c = F.lit(None).cast("string")
        else:
            c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.IntegerType):
            c = c.try_cast("int")
        elif f.name == PARTITION_COLUMNS.get(name):
            c = parse_date(c)
        cols.append(c.alias(f.name))
    return df.select(cols)


def read_entities(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read every object from ``{root}/{object}``.

    Parquet extracts have the declared schema: scans get column pruning, filter
    pushdown from the extract predicates and partition pruning on
    :data:`PARTITION_COLUMNS`.  CSV extracts are text as delivered, bound by their
    header (see :func:`from_text`); files of one object must agree in their header,
    which Spark checks.
    """
    out = {}
    for name, schema in SCHEMAS.items():
        path = f"{root.rstrip('/')}/{name}"
        if fmt == "csv":
            out[name] = from_text(spark.read.options(**TEXT_OPTIONS).csv(path), name)
        else:
            out[name] = spark.read.schema(schema).format(fmt).load(path)
    return out

"""Map the driver's TPC-H-like tables onto the claims object model.

The production inputs are CRM object extracts (see :mod:`claimflow.sources.entities`).
For tests, benchmarks and the DuckDB oracle the same objects are derived from the
driver's parquet tables; ``fixture_sql.py`` holds the SQL twin of every
expression below.  The mapped source columns contain no nulls, so nulls are
injected by key modulus; every ``timestamp_ntz`` is cast to a date.

=================  ==========================================================
object             derived from
=================  ==========================================================
organisation       region
scheme, user       nation
policy, claimant,  customer (1:1 with the claim)
claim, journal
benefit            distinct customer segments x the five order priorities
benefit_claimed    orders (+ the customer's segment for the benefit id)
payment_contrib.   lineitem, with a few amounts missing, NaN, below a cent or huge
payment            lineitem, 1:1 with the line; some release months not filled
diagnosis          events
=================  ==========================================================
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.predicates import EXCLUDED_CLOSED_REASONS
from ..operators.relate import relate
from ..session import scratch_path
from .store import store_facts

# Fixed values of the fixture mapping (not taken from any source system).
# Reporting period used by every registered query.
REP_START = dt.date(1999, 1, 1)
REP_END = dt.date(2000, 12, 31)
# Order priority -> benefit name, in priority order.
BENEFIT_BY_PRIORITY = (
    ("1-URGENT", "Income Protection"),
    ("2-HIGH", "Super Contribution"),
    ("3-MEDIUM", "Additional Super Contribution"),
    ("4-NOT SPECIFIED", "Additional Income Protection"),
    ("5-LOW", "Total and Permanent Disablement"),
)

DRIVER_TABLES = ("region", "nation", "customer", "orders", "lineitem", "events")


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _days(start: Column | str, n: Column) -> Column:
    """``start + n`` days, ``n`` an integral column."""
    start = F.lit(dt.date.fromisoformat(start)) if isinstance(start, str) else start
    return F.date_add(start, n.cast("int"))


def _s(c: Column) -> Column:
    return c.cast("string")


_ENTITY_CACHE: dict[tuple[str, str], dict[str, DataFrame]] = {}


def entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All claims objects derived from the driver tables under ``sf_dir``.

    The frames are lazy plan definitions (no data is held), so they are built
    once per Spark application and directory and shared by every query.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _ENTITY_CACHE:
        _ENTITY_CACHE[key] = _build_entities(spark, sf_dir)
    return dict(_ENTITY_CACHE[key])


_STORED: dict[tuple[str, str, str], dict[str, DataFrame]] = {}


def stored_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """:func:`entities` with the two payment objects in a store of their own.

    Written once per Spark application and state of the driver's files, as a monthly
    load would be: the queries that join payments read them from there.
    """
    files = read_driver_table(spark, sf_dir, "lineitem").select(
        "_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size").distinct()
    state = files.agg(F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()[0]
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), str(state))
    if key not in _STORED:
        _STORED[key] = store_facts(entities(spark, sf_dir), scratch_path(spark, "facts"))
    return dict(_STORED[key])


def _build_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = {n: read_driver_table(spark, sf_dir, n) for n in DRIVER_TABLES}
    region, nation, customer = t["region"], t["nation"], t["customer"]
    orders, lineitem, events = t["orders"], t["lineitem"], t["events"]
    ck = F.col("c_custkey")
    ok = F.col("o_orderkey")
    odate = F.col("o_orderdate").cast("date")
    ship = F.col("l_shipdate").cast("date")
    eid = F.col("event_id")

    organisation = region.select(
        _s(F.col("r_regionkey").cast("bigint")).alias("id"), F.col("r_name").alias("name")
    )
    scheme = nation.select(
        _s(F.col("n_nationkey").cast("bigint")).alias("id"),
        F.concat(F.lit("SCH"), F.lpad(_s(F.col("n_nationkey")), 5, "0")).alias("number"),
        F.col("n_name").alias("name"),
        _s(F.col("n_regionkey").cast("bigint")).alias("organisation_id"),
    )
    user = nation.select(
        _s(F.col("n_nationkey").cast("bigint")).alias("id"),
        F.concat(F.lit("User "), F.col("n_name")).alias("name"),
    )
    policy = customer.select(
        _s(ck).alias("id"),
        F.concat(F.lit("POL"), F.lpad(_s(ck), 9, "0")).alias("name"),
        F.when(ck % 3 != 0, F.concat(F.lit("L"), _s(ck))).alias("legacy_member_number"),
        F.concat(F.lit("M"), _s(ck)).alias("member_number"),
        F.concat(F.lit("P"), _s(ck)).alias("pas_member_id"),
        _s(_days("1990-01-01", ck % 3650)).alias("date_joined_fund"),
        F.when(F.col("c_acctbal") >= 0, "Yes").otherwise("No").alias("in_super"),
        _s(F.col("c_nationkey").cast("bigint")).alias("scheme_id"),
    )
    claimant = customer.select(
        _s(ck).alias("id"),
        F.concat(F.lit("First"), _s(ck)).alias("first_name"),
        F.concat(F.lit("Last"), _s(ck)).alias("last_name"),
        _s(_days("1950-01-01", (ck * 37) % 15000)).alias("birthdate"),
        F.when(ck % 2 == 0, "Female").otherwise("Male").alias("gender"),
    )
    claim = customer.select(
        _s(ck).alias("id"),
        F.col("c_name").alias("name"),
        F.when(ck % 20 == 5, "Incomplete").when(ck % 20 == 6, None).otherwise("Open")
        .alias("status"),
        F.when(ck % 10 == 0, "Enquiry").when(ck % 10 == 1, "Post Claim").otherwise("Claim")
        .alias("claim_type"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Retail").otherwise("Group")
        .alias("business_type"),
        F.when(ck % 7 != 0, _days("1995-01-01", ck % 2500)).alias("form_received"),
        F.concat(F.lit("Team "), _s(ck % 4 + 1)).alias("team"),
        _s(ck).alias("policy_id"),
        _s(ck).alias("claimant_id"),
        _s(ck % 25).alias("owner_id"),
    )
    # 5 priorities per distinct segment: a generator, not a join.
    prio_name = F.lit(None).cast("string")
    for prio, name in reversed(BENEFIT_BY_PRIORITY):
        prio_name = F.when(F.col("prio") == prio, name).otherwise(prio_name)
    benefit = (
        customer.select(F.col("c_mktsegment").alias("seg")).distinct()
        .select("seg", F.explode(F.array(*[F.lit(p) for p, _ in BENEFIT_BY_PRIORITY]))
                .alias("prio"))
        .select(
            F.concat(F.col("prio"), F.lit("|"), F.col("seg")).alias("id"),
            prio_name.alias("name"),
            F.col("seg").alias("category"),
        )
    )
    o = orders.alias("o").join(
        customer.select("c_custkey", "c_mktsegment").alias("c"),
        F.col("c.c_custkey") == F.col("o.o_custkey"),
        "left",
    )
    status = F.col("o_orderstatus")
    benefit_claimed = o.select(
        _s(ok).alias("id"),
        F.when(ok % 101 == 5, F.concat(F.lit("Shared "), _s(ok % 13)))
        .when(ok % 103 != 7, _s(ok)).alias("name"),
        F.concat(F.lit("Variant "), _s(ok % 7)).alias("product_name"),
        F.when(ok % 50 == 7, "Suspended").when(ok % 50 == 8, None)
        .when(status == "F", "Closed").when(status == "P", "Open")
        .when(status == "O", "Approved").alias("status"),
        F.when(ok % 25 == 3, EXCLUDED_CLOSED_REASONS[0])
        .when(ok % 25 == 4, EXCLUDED_CLOSED_REASONS[1])
        .when(ok % 25 == 5, "")
        .when(ok % 25 == 6, "Withdrawn").alias("closed_reason"),
        F.when(status == "F", "Finalised").otherwise("Active").alias("benefit_status_recorded"),
        F.when(ok % 40 != 9, F.trunc(odate, "year")).alias("date_of_disability"),
        F.date_add(odate, 10).alias("notification_date"),
        F.when(ok % 4 != 0, F.date_add(odate, 20)).alias("initial_under_assessment"),
        F.when(ok % 3 != 0, F.date_add(odate, 400)).alias("closure_date"),
        F.when(ok % 11 == 0, F.date_add(odate, 200)).alias("reopened_date"),
        F.when(ok % 17 == 0, F.date_add(odate, 300)).alias("date_of_reoccurrence"),
        ((ok % 4) * 30).cast("double").alias("waiting_period"),
        F.when(ok % 6 != 1, ((ok % 3) * 15).cast("double")).alias("waiting_period_extension"),
        F.lit("Days").alias("waiting_units"),
        F.when(ok % 60 != 11, F.col("o_totalprice")).alias("coverage_amount"),
        F.when(ok % 3 == 0, "2 Years").when(ok % 3 == 1, "5 Years").otherwise("To Age 65")
        .alias("benefit_period"),
        _s(F.date_add(odate, 365)).alias("indexation_date"),
        F.when(ok % 11 == 0, "true").otherwise("false").alias("reopened"),
        F.when(ok % 11 == 0, "Data Update").alias("reopened_reason"),
        _s(F.date_add(odate, 730)).alias("expected_closure"),
        _s(F.date_add(odate, 1825)).alias("end_of_benefit_period"),
        _s(F.col("o_custkey")).alias("claim_id"),
        F.concat(F.col("o_orderpriority"), F.lit("|"), F.col("c_mktsegment")).alias("benefit_id"),
        _s(ok % 25).alias("modified_by_id"),
    )
    lk, ln = F.col("l_orderkey"), F.col("l_linenumber")
    # order and line numbers repeat; with part, supplier and day the line is unique
    pay_id = F.concat_ws("-", F.lit("P"), _s(lk), _s(ln), _s(F.col("l_partkey")),
                         _s(F.col("l_suppkey")), F.date_format(ship, "yyyyMMdd"))
    payment_contribution = lineitem.select(
        F.concat(F.lit("PC-"), _s(lk), F.lit("-"), _s(ln)).alias("name"),
        ln.alias("line_number"),
        F.when(F.col("l_partkey") % 500 == 1, None)
        .when(lk % 997 == 3, F.lit(float("nan")))
        .when((lk % 1009 == 4) & (ln == 1), F.lit(1e17))
        .when(lk % 211 == 6, F.lit(0.005))
        .otherwise(F.col("l_extendedprice")).alias("amount"),
        F.when(ln != 1, F.date_sub(ship, 30)).alias("start"),
        F.when(ln != 2, F.date_sub(ship, 1)).alias("through"),
        _s(lk).alias("benefit_claimed_id"),
        pay_id.alias("payment_id"),
    )
    payment = lineitem.select(
        pay_id.alias("id"),
        F.concat(F.lit("PAY-"), _s(lk), F.lit("-"), F.date_format(ship, "yyyyMMdd"))
        .alias("name"),
        F.when(F.col("l_returnflag") == "N", "Pending").otherwise("Processed").alias("status"),
        ship.alias("release"),
        _s(F.date_sub(ship, 30)).alias("start"),
        F.concat(F.lit("PAS"), F.lpad(_s(F.col("l_suppkey")), 8, "0")).alias("pas_reference"),
        F.when(lk % 10 != 2, F.trunc(ship, "month")).alias("release_month"),
    )
    journal = customer.select(_s(ck).alias("id"), _s(ck).alias("claim_id"))
    code = F.get_json_object(F.col("props"), "$.k")
    created = F.col("ts").cast("date")
    etype = F.col("event_type")
    diagnosis = events.select(
        F.concat(F.lit("DX-"), F.lpad(_s(eid), 12, "0")).alias("name"),
        code.alias("medical_code"),
        F.when(eid % 5 != 0, F.concat(F.lit("Condition "), code)).alias("description"),
        F.when(eid % 4 != 0, F.concat(F.lit("Factor "), _s(eid % 7))).alias("duration_factor"),
        F.when(etype == "purchase", "Primary").when(etype == "signup", "Cause of Death")
        .otherwise("Secondary").alias("type"),
        F.when(eid % 3 != 0, F.date_sub(created, (eid % 90).cast("int"))).alias("start"),
        created.alias("created"),
        _s(F.col("user_id")).alias("journal_id"),
    )
    return {
        "organisation": organisation,
        "scheme": scheme,
        "user": user,
        "policy": policy,
        "claimant": claimant,
        "claim": claim,
        "benefit": benefit,
        "benefit_claimed": benefit_claimed,
        "payment_contribution": payment_contribution,
        "payment": payment,
        "journal": journal,
        "diagnosis": diagnosis,
    }


def payment_text_extract(tables: dict[str, DataFrame], joined: DataFrame | None = None) -> DataFrame:
    """Payments as an untyped extract would deliver them: amounts and release
    dates as text, in rotating date formats, with junk and blanks mixed in.
    ``joined``: contributions with the fields of their payments, where a run has them."""
    pc = relate(tables, "payment_contribution", {
        "name": "name", "line_number": "line_number", "amount": "amount",
        "benefit_claimed_id": "benefit_claimed_id", "release": "payment.release"}) if joined is None else joined
    k, rel = F.col("benefit_claimed_id").cast("bigint"), F.col("release")
    fmt = (k + F.col("line_number")) % 6
    amount_text = (F.when(F.col("amount").isNull(), None)
                   .when(k % 7 == 0, "abc").when(k % 7 == 1, "").when(k % 7 == 2, "12d")
                   .when(k % 7 == 3, "NaN").when(k % 7 == 4, " 1.5e3 ")
                   .otherwise(F.col("amount").try_cast("decimal(28,2)").cast("string")))
    release_text = (F.when(fmt == 0, F.date_format(rel, "yyyy-MM-dd"))
                    .when(fmt == 1, F.date_format(rel, "yyyy/MM/dd"))
                    .when(fmt == 2, F.date_format(rel, "yyyyMMdd"))
                    .when(fmt == 3, F.concat(F.date_format(rel, "yyyy-MM-dd"),
                                             F.lit("T23:30:00.000Z")))
                    .when(fmt == 4, "junk"))
    return pc.select(F.col("name").alias("contribution_name"), "line_number",
                     amount_text.alias("amount_text"), release_text.alias("release_text"))


def text_entities(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Objects as a text extract would deliver them, with junk in dates and amounts."""
    k, lines, days = F.col("benefit_claimed_id").cast("bigint"), F.col("line_number"), F.dayofmonth("release")
    number = F.col("id").cast("bigint")
    amount = F.when(F.isnan("amount"), "NaN").otherwise(F.col("amount").try_cast("decimal(28,2)").cast("string"))
    contribution = tables["payment_contribution"].withColumns({
        "amount": F.when(k % 7 == 0, "abc").when(k % 7 == 1, "").when(k % 7 == 2, "12d").otherwise(amount),
        "start": F.when((k + lines) % 11 == 0, "2020-13-45").otherwise(_s(F.col("start"))),
        "through": F.when((k + lines) % 13 == 0, "  ").otherwise(_s(F.col("through")))})
    payment = tables["payment"].withColumn("release", F.when(days == 7, "junk").when(
        days == 8, F.date_format("release", "yyyyMMdd")).when(days == 9, F.date_format("release", "dd/MM/yyyy"))
        .otherwise(_s(F.col("release"))))
    benefit = tables["benefit_claimed"].withColumns({
        "coverage_amount": F.when(number % 17 == 3, "1,000.00").otherwise(
            F.col("coverage_amount").try_cast("decimal(28,2)").cast("string")),
        "closure_date": F.when(number % 19 == 4, "open").otherwise(_s(F.col("closure_date")))})
    return {**tables, "payment_contribution": contribution, "payment": payment, "benefit_claimed": benefit}


def broken_entities(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Objects with keys that are missing, lead nowhere or to several parents."""
    k = F.col("id").cast("bigint")
    lines = F.col("line_number")
    contribution = tables["payment_contribution"].withColumn("benefit_claimed_id", F.when(
        lines == 6, None).when(lines == 7, F.concat(F.lit("X"), F.col("benefit_claimed_id"))).otherwise(F.col("benefit_claimed_id")))
    benefit = tables["benefit_claimed"].withColumn("claim_id", F.when(k % 31 == 3, None).when(
        k % 37 == 4, F.lit("nowhere")).otherwise(F.col("claim_id")))
    scheme = tables["scheme"].filter(k % 5 != 2)
    policy_twice = tables["policy"].unionByName(tables["policy"].filter(k % 40 == 7))
    payment = tables["payment"].filter(F.dayofmonth("release") != 13)
    return {**tables, "payment_contribution": contribution, "benefit_claimed": benefit, "scheme": scheme,
            "policy": policy_twice, "payment": payment}

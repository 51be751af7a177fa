"""Skew, partition independence and plan-shape checks."""

from collections import Counter

from pyspark.sql import functions as F

from claimflow.functions import text
from claimflow.operators.latest import latest_per_group
from claimflow.operators.supplements import fold, fold_with_orphans
from claimflow.plans.lookups import payment_states
from claimflow.plans.ocr import ocr_clean
from helpers import D, clean_rows

REP_END = D("2000-12-31")


def _rows(df):
    return Counter(map(repr, df.collect()))


def test_fold_hot_key_is_partition_independent(spark):
    """One merge key holding most rows: the fan-out is exact at any partitioning."""
    rows = [{"name": f"P{i}", "claim_name": "HOT", "sc_key": "HOT-NA-X",
             "benefit_name": "Income Protection", "coverage_amount": float(i),
             "total_paid": 1.0} for i in range(1500)]
    rows += [{"name": f"S{i}", "claim_name": "HOT", "sc_key": "HOT-NA-X",
              "benefit_name": "Super Contribution", "coverage_amount": 10.0 + i,
              "total_paid": 2.0} for i in range(3)]
    rows += [{"name": f"Q{i}", "claim_name": f"C{i}", "sc_key": f"C{i}-NA-X",
              "benefit_name": "Total and Permanent Disablement", "coverage_amount": 1.0,
              "total_paid": 1.0} for i in range(200)]
    clean = clean_rows(spark, rows)
    a = _rows(fold_with_orphans(clean.repartition(1)))
    b = _rows(fold_with_orphans(clean.repartition(29, "name")))
    assert a == b
    assert sum(a.values()) == 1500 * 3 + 200


def test_latest_hot_group_matches_brute_force(spark):
    data = [("HOT", f"DX-{i:05d}", D("2020-01-01") if i % 7 else D("2021-06-01"), f"c{i}")
            for i in range(4000)]
    data += [(f"K{i}", f"DX-9{i:04d}", D("2019-01-01"), f"k{i}") for i in range(100)]
    df = spark.createDataFrame(data, "claim string, name string, d date, code string")
    best = {}
    for claim, name, d, code in data:
        key = (-d.toordinal(), name)
        if claim not in best or key < best[claim][0]:
            best[claim] = (key, code)
    want = {c: v[1] for c, v in best.items()}
    for parts in (1, 17):
        got = latest_per_group(df.repartition(parts), "claim", F.col("d"), F.col("name"),
                               ["code"]).collect()
        assert {r.claim: r.code for r in got} == want


def test_fold_fan_out_equals_product_of_matches(spark, fixture_tables):
    """Brute force on the small fixture: each primary row yields
    max(1, #SC) * max(1, #SCAdd) * max(1, #Add) rows for its key."""
    clean = ocr_clean(fixture_tables, REP_END).select("name", "sc_key", "benefit_name")
    pdf = clean.toPandas()
    n = pdf["benefit_name"].fillna("")
    sc = n.str.startswith("Super Contribution")
    scadd = n.str.contains("Additional Super Contribution", regex=False)
    add = n.str.startswith("Additional ") & ~n.str.startswith("Additional Super Contribution")
    primary = ~n.str.contains("Super Contribution", regex=False) & ~n.str.startswith("Additional")
    counts = {cls: Counter(pdf.loc[mask, "sc_key"]) for cls, mask in
              (("sc", sc), ("scadd", scadd), ("add", add))}
    expected = sum(max(1, counts["sc"][k]) * max(1, counts["scadd"][k]) * max(1, counts["add"][k])
                   for k in pdf.loc[primary, "sc_key"])
    got = fold(ocr_clean(fixture_tables, REP_END)).count()
    assert got == expected > 0


def test_orphans_never_share_a_claim_with_primary_rows(fixture_tables):
    from claimflow.operators.supplements import orphans

    clean = ocr_clean(fixture_tables, REP_END)
    prim = {r[0] for r in clean.filter(text.is_primary_benefit(F.col("benefit_name")))
            .select("claim_name").collect()}
    orph = {r[0] for r in orphans(clean).select("claim_name").collect()}
    assert orph and not (orph & prim)


def test_payment_states_aggregate_partially_before_the_shuffle(fixture_tables):
    plan = payment_states(fixture_tables, REP_END)._jdf.queryExecution().executedPlan() \
        .toString()
    assert "partial_sum" in plan and "partial_min_by" in plan
    assert "SortAggregate" not in plan
    first, last = plan.index("HashAggregate(keys"), plan.rindex("HashAggregate(keys")
    assert "partial_" in plan[last:] and "Exchange" in plan[first:last]


LARGE_DATA_PATHS = {
    # no broadcasts: every join is a shuffled sort-merge join, as at 100 TB
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    # skew handling on with tiny thresholds; AQE splits a partition only by ranges
    # of map outputs, so single-file fixtures (one map task) are rarely split
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.shuffle.partitions": "16",
}


def test_reports_unchanged_on_large_data_join_paths(spark, fixture_tables):
    """With broadcasts off, every join is a shuffled sort-merge join (null-safe
    keys included), as at 100 TB; the reports must not change."""
    from claimflow.plans.acr import acr_report
    from claimflow.plans.ocr import ocr_report
    from claimflow.sources.fixtures import REP_START

    builds = (lambda: ocr_report(fixture_tables, REP_END),
              lambda: acr_report(fixture_tables, REP_START))
    expected = [_rows(b()) for b in builds]
    saved = {k: spark.conf.get(k, None) for k in LARGE_DATA_PATHS}
    try:
        for k, v in LARGE_DATA_PATHS.items():
            spark.conf.set(k, v)
        df = builds[1]()
        got = [_rows(b()) for b in builds[:1]] + [_rows(df)]
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == expected
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_hot_merge_key_is_split_by_aqe(spark):
    """A merge key holding 80% of the rows, spread over many map tasks: with
    broadcasts off, AQE splits the hot partition of the fold joins across
    tasks (by ranges of map outputs), and the folded rows do not change."""
    import contextlib
    import io

    i = F.col("id")
    clean = spark.range(0, 20000, numPartitions=20).select(
        F.when(i % 10 < 8, F.lit("HOT-NA-NA"))
        .otherwise(F.concat(F.lit("K"), (i % 997).cast("string"))).alias("sc_key"),
        F.when(i % 2000 == 0, "Super Contribution")
        .when(i % 2000 == 1, "Additional Income Protection")
        .otherwise("Income Protection").alias("benefit_name"),
        (i % 100).cast("double").alias("coverage_amount"),
        (i % 7).cast("double").alias("total_paid"),
        i.alias("row"))

    def summary(df):  # row count and an order-free checksum of every column
        return df.agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.xxhash64(*df.columns) % 1000003).alias("h"))

    expected = summary(fold(clean)).collect()
    saved = {k: spark.conf.get(k, None) for k in LARGE_DATA_PATHS}
    try:
        for k, v in LARGE_DATA_PATHS.items():
            spark.conf.set(k, v)
        df = summary(fold(clean))
        got = df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()  # the final adaptive plan of the action above
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == expected and got[0]["n"] > 1_000_000
    plan = buf.getvalue()
    assert "isFinalPlan=true" in plan and "SortMergeJoin(skew=true)" in plan


def _hot_clean(spark):
    i = F.col("id")
    return spark.range(0, 20000, numPartitions=20).select(
        F.when(i % 10 < 8, F.lit("HOT-NA-NA")).when(i % 10 == 8, F.lit("LONE-NA-NA"))
        .otherwise(F.concat(F.lit("K"), (i % 997).cast("string"))).alias("sc_key"),
        F.when(i % 10 == 8, F.lit("LONE")).otherwise(F.lit("HOT")).alias("claim_name"),
        F.when((i % 10 == 8) & (i % 4 == 0), "Additional Super Contribution").when(i % 10 == 8, "Super Contribution")
        .when(i % 2000 == 0, "Super Contribution").when(i % 2000 == 1, "Additional Income Protection")
        .otherwise("Income Protection").alias("benefit_name"),
        (i % 100).cast("double").alias("coverage_amount"), (i % 7).cast("double").alias("total_paid"), i.alias("row"))


def test_heavy_merge_keys_are_dealt_without_aqe(spark):
    """Heavy keys are found by an aggregate and dealt over parts: no partition of the join holds
    a large share, adaptive execution off, and the rows are those of the plain joins."""
    from claimflow.operators.supplements import heavy_keys, orphans

    clean = _hot_clean(spark)
    primary, other = heavy_keys(clean, share=16, least=100)
    assert set(primary) == {"HOT-NA-NA"} and primary["HOT-NA-NA"] >= 12 and set(other) == {"LONE-NA-NA"}
    assert heavy_keys(clean) == ({"HOT-NA-NA": 2}, {})      # 10,000 rows at least
    assert heavy_keys(clean.limit(0)) == ({}, {})

    def checksum(df):
        return df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias("h")).collect()

    saved = {k: spark.conf.get(k, None) for k in {**LARGE_DATA_PATHS, "spark.sql.adaptive.enabled": ""}}
    try:
        for k, v in {**LARGE_DATA_PATHS, "spark.sql.adaptive.enabled": "false",
                     "spark.sql.shuffle.partitions": "64"}.items():
            spark.conf.set(k, v)
        for plain, dealt in ((fold(clean), fold(clean, heavy=primary)),
                             (orphans(clean.filter("row < 3000")), orphans(clean.filter("row < 3000"), heavy=other))):
            assert dealt.columns == plain.columns
            assert checksum(plain) == checksum(dealt)
        largest = {}
        for kind, df in (("plain", fold(clean)), ("dealt", fold(clean, heavy=primary))):
            rows = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
            largest[kind] = max(r["count"] for r in rows) / sum(r["count"] for r in rows)
        assert largest["plain"] > 0.75 and largest["dealt"] < 0.3, largest
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_payments_meet_their_contributions_by_merge_at_every_size(fixture_tables):
    """Payments are never broadcast, so what the join moves is in proportion to them."""
    plan = payment_states(fixture_tables, REP_END)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [payment_id#" in plan and "BroadcastExchange" not in plan

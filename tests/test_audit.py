"""Audit of stages with duplicate parents and lost casts, rejects, key integrity."""

import glob
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimflow.operators import audit as A
from claimflow.operators.integrity import dangling_keys, hop_integrity
from claimflow.operators.relate import relate
from claimflow.plans.stages import payments_frame
from claimflow.session import checkpoint_dir, materialize, scratch_path, staging_scope
from claimflow.sources.rejects import rejects, staged_with_rejects, with_rejects
from claimflow.sources.sinks import put_in_place, read_csv, row_digest, write_report, write_targets
from helpers import D, make_tables


def _tables(spark):
    claim = {"id": 1, "name": "C", "claim_type": "Claim", "business_type": "Group"}
    paid = dict(status="Processed", release=D("2020-02-01"))
    return make_tables(
        spark, claim=[claim], benefit_claimed=[{"id": 1, "name": "B", "claim_id": 1}, {"id": 2, "name": "N"}],
        payment=[{"id": 1, **paid}, {"id": 2, **paid}, {"id": 2, **paid}, {"id": 2, **paid}, {"id": None, **paid}],
        payment_contribution=[{"name": "a", "benefit_claimed_id": 1, "payment_id": 1}, {"name": "b", "benefit_claimed_id": 1, "payment_id": 2},
                              {"name": "c", "benefit_claimed_id": 2, "payment_id": 9}, {"name": "d"}, {"name": "d"}])


def _values(df):
    return {r["metric"]: r["value"] for r in df.collect()}


def test_fan_out_unmatched_and_lost_casts(spark):
    t = _tables(spark)
    raw = F.when(F.col("name") == "a", "12d").when(F.col("name") == "b", " ").when(F.col("name") == "c", "7")
    t["payment_contribution"] = t["payment_contribution"].withColumn("amount", raw)
    paid = materialize(payments_frame(t, D("2020-01-01"), D("2020-12-31")), "audited")
    got = _values(A.matched("payments", paid, F.col("extracted"), unmatched=F.col("unmatched"), cast_nulls=F.col("lost") > 0))
    assert got == {"rows_in": 5, "fan_out": 3, "rows": 4, "unmatched": 3, "cast_nulls": 1}
    assert _values(A.matched("none", paid.limit(0), unmatched=F.col("unmatched"))) == {
        "rows_in": 0, "fan_out": 0, "rows": 0, "unmatched": 0}
    assert _values(A.counted("all", paid, lost=F.col("lost") > 0)) == {"rows": 7, "lost": 1}


def test_rejects_come_from_the_scan_of_the_report(spark):
    t = _tables(spark)
    amount = F.when(F.col("name") == "a", "1e5x").when(F.col("name") == "b", "").otherwise(" 5 ")
    t["payment_contribution"] = t["payment_contribution"].withColumns({"amount": amount, "start": F.lit("31/12/2020")})
    t["payment"] = t["payment"].withColumn("release", F.when(F.col("id") == "2", "soon").otherwise("20200201"))
    with staging_scope(spark):
        staged = staged_with_rejects(t)
        got = Counter(map(tuple, rejects(staged).collect()))
        assert got == Counter({("payment_contribution", "a", "amount", "1e5x"): 1, ("payment", "2", "release", "soon"): 3,
                               **{("payment_contribution", n, "start", "31/12/2020"): 2 if n == "d" else 1 for n in "abcd"}})
        # both read the staged table, none the source
        for df in (rejects(staged), relate(staged, "payment_contribution", {"a": "amount", "r": "payment.release"})):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            assert "LogicalRDD" not in plan and "LocalRelation" not in plan
        assert rejects({"claim": with_rejects(t["claim"], "claim")}).count() == 0     # typed: nothing can be lost
        assert rejects({"user": with_rejects(t["user"], "user")}).count() == 0
    with pytest.raises(ValueError):
        rejects(t)


def test_hop_integrity_counts_null_dangling_and_ambiguous_keys(spark):
    t = _tables(spark)
    got = {(r["object"], r["relationship"]): tuple(r)[3:] for r in hop_integrity(t).collect()}
    assert got["payment_contribution", "payment"] == (5, 2, 1, 1, 1)
    assert got["payment_contribution", "benefit_claimed"] == (5, 2, 0, 0, 0)
    assert got["benefit_claimed", "claim"] == (2, 1, 0, 0, 0)
    assert ("journal", "claim") not in got      # no rows, no line
    assert [tuple(r) for r in dangling_keys(t, "payment_contribution", "payment").collect()] == [("9", 1)]
    # each object is read once
    plan = hop_integrity({k: v.filter(F.lit(k) != "") for k, v in t.items()})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("benefit_claimed_id#") > 0 and "CartesianProduct" not in plan


def _report(spark, n=50):
    return spark.range(n).select(F.col("id").cast("string").alias("A b"), (F.col("id") / 7).alias("x"),
                                 F.when(F.col("id") % 3 == 0, "t").alias("maybe"))


def _folder(path):
    return path.removeprefix("file:")


def test_targets_are_written_all_or_none(spark, tmp_path):
    one, two = (scratch_path(spark, "target") for _ in range(2))
    first = write_targets(_report(spark), [one, two])
    assert first.rows == 50
    back = [read_csv(spark, p, _report(spark).schema) for p in (one, two)]
    digests = {b.toDF("c0", "c1", "c2").agg(row_digest(b.toDF("c0", "c1", "c2"))).first()[0] for b in back}
    assert {int(d) for d in digests} == {first.digest}
    # the digest holds for any order and partitioning, and tells other rows apart
    assert write_targets(_report(spark).repartition(7).orderBy(F.desc("x")), [one]) == first
    assert write_targets(_report(spark).withColumn("maybe", F.lit(None).cast("string")), [two]).digest != first.digest
    write_report(_report(spark), [one, two])
    # the second target cannot be made: its parent is a file
    blocked = tmp_path / "file"
    blocked.write_text("x")
    with pytest.raises(Exception):
        write_targets(_report(spark, 9), [one, f"file://{blocked}/report"])
    assert read_csv(spark, one, _report(spark).schema).count() == 50
    root = checkpoint_dir(spark).removeprefix("file:")
    assert not glob.glob(f"{root}/*.writing-*") and not glob.glob(f"{root}/*.old-*")
    with pytest.raises(ValueError):
        write_targets(_report(spark), [one, one])


def test_a_failed_rename_brings_everything_back(spark):
    base = scratch_path(spark, "swap")
    paths = {n: f"{base}/{n}" for n in ("new1", "new2", "old1", "old2")}
    for n in ("new1", "old1", "old2"):
        spark.range(1 if n == "new1" else 5).write.parquet(paths[n])
    with pytest.raises(Exception):      # new2 was never written
        put_in_place(spark, [(paths["new1"], paths["old1"]), (paths["new2"], paths["old2"])])
    assert [spark.read.parquet(paths[n]).count() for n in ("new1", "old1", "old2")] == [1, 5, 5]
    put_in_place(spark, [(paths["new1"], paths["old1"])])
    assert spark.read.parquet(paths["old1"]).count() == 1
    assert len(glob.glob(_folder(base) + "/*")) == 2

"""Month states: only changed months are read, equal rollup, repeated and broken runs."""

import datetime as dt
import glob
from collections import Counter

from pyspark.sql import functions as F

from claimflow.plans.lookups import payment_rollup
from claimflow.plans.months import MonthStates, rollup_of_months, states_of_months
from claimflow.session import scratch_path
from claimflow.sources.fixtures import REP_END
from claimflow.sources.months import MONTH, read_months, signatures, write_months
from helpers import D, make_tables


def _rows(df):
    return Counter(map(repr, df.collect()))


def test_second_run_reads_only_changed_months(spark, fixture_tables):
    t = dict(fixture_tables)
    source, root = scratch_path(spark, "months"), scratch_path(spark, "states")
    write_months(t, source)
    kept = MonthStates(spark, root, source)
    first = kept.update()
    assert len(first) > 50 and first == sorted(signatures(spark, source))
    assert kept.update() == []                                         # nothing changed: nothing is read
    assert _rows(rollup_of_months(t, kept, REP_END)) == _rows(payment_rollup(t, REP_END))
    # a month is delivered again with other amounts, and one loses its last payment
    month = D("1999-03-01")
    t["payment_contribution"] = t["payment_contribution"].join(
        t["payment"].select(F.col("id").alias("payment_id"), F.trunc("release", "month").alias("_m")), "payment_id", "left") \
        .withColumn("amount", F.when(F.col("_m") == month, F.col("amount") + 1).otherwise(F.col("amount"))) \
        .select(*fixture_tables["payment_contribution"].columns)
    write_months(t, source, [month])
    assert kept.update() == [month]
    assert _rows(rollup_of_months(t, kept, REP_END)) == _rows(payment_rollup(t, REP_END))
    cut = D("1999-03-17")                                              # a period that ends within a month
    assert _rows(rollup_of_months(t, kept, cut)) == _rows(payment_rollup(t, cut))
    # one manifest, and no folder that it does not name
    names = {p.rsplit("/", 1)[1] for p in glob.glob(root.removeprefix("file:") + "/*")}
    assert {n for n in names if n.startswith("manifest")} == {"manifest-2"}
    assert {n for n in names if n.startswith("states")} == {f for _, f in kept.manifest()[1].values()}


def test_changed_months_prune_both_objects(spark, fixture_tables):
    source = scratch_path(spark, "months")
    write_months(fixture_tables, source)
    plan = states_of_months(read_months(spark, source), [D("1999-03-01")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(release_month") == 2


def test_a_run_that_dies_changes_nothing(spark, fixture_tables):
    source, root = scratch_path(spark, "months"), scratch_path(spark, "states")
    write_months(fixture_tables, source)
    kept = MonthStates(spark, root, source)
    months = sorted(signatures(spark, source))
    # states and a manifest without its end, as a run leaves them that dies while it writes
    states_of_months(read_months(spark, source), months[:2]).write.partitionBy(MONTH).parquet(f"{root}/states-dead")
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/manifest-1")
    assert kept.manifest() == (0, {})
    assert kept.update() == months
    assert _rows(rollup_of_months(fixture_tables, kept, REP_END)) == _rows(payment_rollup(fixture_tables, REP_END))
    assert not glob.glob(root.removeprefix("file:") + "/states-dead")


def test_months_that_go_and_payments_without_a_date(spark):
    t = make_tables(spark, claim=[{"id": 1, "name": "C", "business_type": "Group"}],
                    benefit_claimed=[{"id": 1, "name": "B", "claim_id": 1}],
                    payment=[{"id": 1, "status": "Processed", "release": D("2020-01-31")}, {"id": 2, "status": "Processed"},
                             {"id": 3, "status": "Pending", "release": D("2020-02-01")}],
                    payment_contribution=[{"name": str(k), "payment_id": k, "benefit_claimed_id": 1, "amount": float(k)}
                                          for k in (1, 2, 3, 4)])
    source, root = scratch_path(spark, "months"), scratch_path(spark, "states")
    write_months(t, source)
    kept = MonthStates(spark, root, source)
    assert kept.update() == [D("2020-01-01"), D("2020-02-01")]
    for end in (D("2020-12-31"), D("2020-01-30"), D("2019-01-01")):
        assert _rows(rollup_of_months(t, kept, end)) == _rows(payment_rollup(t, end))
    t["payment"] = t["payment"].filter("id <> '3'")
    write_months(t, source)
    assert kept.update() in ([D("2020-01-01")], []) and set(kept.manifest()[1]) == {D("2020-01-01")}
    assert isinstance(next(iter(kept.manifest()[1])), dt.date)


def test_states_of_months_are_dealt_once(spark, fixture_tables):
    """Behind the join one exchange, of payments and not of their states, serves both steps and the files."""
    source = scratch_path(spark, "months")
    write_months(fixture_tables, source)
    months = sorted(signatures(spark, source))[:3]
    plan = states_of_months(read_months(spark, source), months)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, x in enumerate(lines) if "Join" in x and "payment_id#" in x)
    above = [x for x in lines[:join] if "Exchange" in x]
    assert len(above) == 1 and "REPARTITION" in above[0], above


def test_writing_months_deals_payments_by_id_once(spark, fixture_tables, monkeypatch):
    from pyspark.sql import DataFrameWriter

    plans = []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (
        plans.append(self._df._jdf.queryExecution().executedPlan().toString()), write(self, *a, **k))[1])
    write_months(fixture_tables, scratch_path(spark, "months"))
    assert len(plans) == 2 and sum("Exchange hashpartitioning" in x and "_payment#" in x for x in plans[1].splitlines()) == 1

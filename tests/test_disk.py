"""What runs of several writes hold on disk: shuffle files of one write, payments joined and dealt once."""

import re
import time
from collections import Counter

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as E
from claimflow.operators.rollup import finish, rollup_payments
from claimflow.plans.lookups import payment_states
from claimflow.plans.months import MonthStates, rollup_of_months
from claimflow.session import SHUFFLE_CLEANUP, materialize, scratch_path
from claimflow.sources.months import write_months
from helpers import D, SF_SMALL, make_tables

END = D("2020-12-31")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.length()))
    return {n for n in names if n.startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files that are still there; they are removed in the background."""
    for _ in range(50):
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


@pytest.fixture
def written(monkeypatch):
    """Plans of the tables that are written, in order."""
    plans = []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (plans.append(_plan(self._df)), write(self, *a, **k))[1])
    return plans


def _joins_of_payments(plan):
    return len(re.findall(r"Join \[payment_id#", plan))


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before, setting = _shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert materialize(counts, "counts").agg(F.sum("count")).first()[0] == 1000
    assert materialize(counts, "counts").count() == 7          # the same frame again
    spark.range(9).repartition(3).write.format("noop").mode("overwrite").save()
    kept = _shuffle_files(spark)
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting and kept - before       # other queries keep theirs
    before = _shuffle_files(spark)
    materialize(counts, "counts")
    assert not _left(spark, before)
    with pytest.raises(Exception):
        materialize(spark.range(3).select(F.raise_error(F.lit("no"))), "fails")
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting


def test_the_audit_joins_payments_once(spark, written):
    E.queries()["stage_audit"](spark, SF_SMALL)
    assert [_joins_of_payments(p) for p in written if _joins_of_payments(p)] == [1]


def test_the_report_stages_the_rollup_before_the_wide_joins(spark, written):
    E.queries()["ocr_report"](spark, SF_SMALL)
    assert [_joins_of_payments(p) for p in written] == [1, 0]


def test_months_leave_no_shuffle_files(spark, fixture_tables):
    source, root, before = scratch_path(spark, "months"), scratch_path(spark, "states"), _shuffle_files(spark)
    write_months(fixture_tables, source)
    assert not _left(spark, before)
    states = MonthStates(spark, root, source)
    states.update()
    assert not [f for f in _left(spark, before) if f.endswith(".data")]
    plan = _plan(rollup_of_months(fixture_tables, states, END))
    # the months of a benefit become one state where they are dealt, before the join by id
    join = next(i for i, x in enumerate(plan.splitlines()) if "Join [benefit_claimed_id#" in x)
    below = "\n".join(plan.splitlines()[join:])
    assert "HashAggregate(keys=[benefit_claimed_id#" in below
    assert len(re.findall(r"Exchange hashpartitioning\(benefit_claimed_id#", below)) == 1


def _payments(spark):
    """Two benefits over several years, with equal days and lines, missing values and a hot one."""
    rows = [{"name": f"a{i}", "benefit_claimed_id": 1, "line_number": i % 3, "amount": None if i == 77 else i / 100,
             "start": None if i % 2 else D("2015-01-01"), "payment_status": "Processed",
             "payment_release": D(f"20{10 + i % 11}-0{1 + i % 9}-15")} for i in range(200)]
    rows += [{"name": f"b{i}", "benefit_claimed_id": 2, "line_number": 1, "amount": float(a), "payment_status": s,
              "payment_release": D(day)} for i, (a, s, day) in enumerate(
                  ((5, "Processed", "2019-12-31"), (4, "Processed", "2020-01-01"), (3, "Processed", "2020-01-01"),
                   (9, "Pending", "2020-02-01"), (8, "Processed", "2021-01-01")))]
    rows += [{"name": "c", "benefit_claimed_id": 3, "line_number": 1, "amount": float("nan"), "payment_status": "Processed",
              "payment_release": D("2001-05-05")}, {"name": "d", "benefit_claimed_id": 3}]
    return make_tables(spark, payment_contribution=rows)


def test_payments_are_dealt_once_and_a_benefit_goes_on_as_a_state_a_year(spark):
    t = _payments(spark)
    states = payment_states(t, END)
    got = Counter(map(repr, finish(states, "benefit_claimed_id").collect()))
    paid = t["payment"].filter((F.col("status") == "Processed") & (F.col("release") <= END)).select(F.col("id").alias("payment_id"), "release")
    flat = t["payment_contribution"].join(paid, "payment_id")
    assert got == Counter(map(repr, rollup_payments(flat, "benefit_claimed_id").collect())) and len(got) == 3
    lines = _plan(states).splitlines()
    join = next(i for i, x in enumerate(lines) if "Join [payment_id#" in x)
    exchanges = [i for i, x in enumerate(lines[:join]) if "Exchange" in x]
    # nearest to the join: the narrow rows; above it one exchange, of the states of a benefit and year
    assert len(exchanges) == 2 and "REPARTITION" in lines[exchanges[1]]
    assert not any("Aggregate" in x for x in lines[exchanges[1]:join])
    assert sum("HashAggregate" in x for x in lines[exchanges[0]:exchanges[1]]) == 3

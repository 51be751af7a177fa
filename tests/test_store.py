"""Facts stored by payment id: joined without an exchange, same rows, opened again."""

from collections import Counter

import pytest
from pyspark.errors import AnalysisException

from claimflow.plans.catalog import RELATE_FIELDS
from claimflow.operators.relate import relate
from claimflow.plans.lookups import payment_states
from claimflow.session import scratch_path
from claimflow.sources.fixtures import REP_END, stored_entities
from claimflow.sources.store import open_facts, store_facts
from helpers import SF_SMALL, make_tables


def _rows(df):
    return Counter(map(repr, df.collect()))


def _below_payment_join(plan):
    """The lines of the plan below the join on the payment id."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "Join" in x and "payment_id#" in x)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    below = []
    for x in lines[at + 1:]:
        if len(x) - len(x.lstrip(" :+-")) <= depth:
            break
        below.append(x)
    return lines[at], below


def test_stored_facts_meet_without_an_exchange(spark, fixture_tables):
    root = scratch_path(spark, "facts")
    stored = store_facts(fixture_tables, root, buckets=3)
    fields = {"name": "name", "benefit": "benefit_claimed.name", "payment": "payment.name"}
    for build in (lambda t: relate(t, "payment_contribution", fields), lambda t: payment_states(t, REP_END).drop("total")):
        join, below = _below_payment_join(build(stored)._jdf.queryExecution().executedPlan().toString())
        assert "SortMergeJoin" in join and any("Bucketed: true" in x for x in below)
        assert not any("Exchange" in x for x in below), below
        assert _rows(build(stored)) == _rows(build(fixture_tables))
    again = open_facts(spark, root)
    assert {k: _rows(v) for k, v in again.items()} == {k: _rows(fixture_tables[k]) for k in again}
    assert again["payment"].schema == stored["payment"].schema


def test_a_store_is_there_when_it_is_whole(spark, fixture_tables):
    with pytest.raises(AnalysisException):
        open_facts(spark, scratch_path(spark, "no-facts"))
    root = scratch_path(spark, "facts")
    store_facts(fixture_tables, root, buckets=2)
    with pytest.raises(AnalysisException):      # a store is written to a fresh folder
        store_facts(fixture_tables, root, buckets=2)


def test_empty_objects_and_missing_ids_are_stored(spark):
    empty = store_facts(make_tables(spark), scratch_path(spark, "facts"), buckets=2)
    assert relate(empty, "payment_contribution", {"a": "name", "p": "payment.name"}).count() == 0
    tables = make_tables(spark, payment=[{"id": None, "name": "x"}, {"id": 1, "name": "y"}],
                         payment_contribution=[{"name": "a", "payment_id": None}, {"name": "b", "payment_id": 1},
                                               {"name": "c", "payment_id": 9}])
    stored = store_facts(tables, scratch_path(spark, "facts"), buckets=2)
    got = relate(stored, "payment_contribution", {"a": "name", "p": "payment.name"}).collect()
    assert sorted((r["a"], r["p"]) for r in got) == [("a", None), ("b", "y"), ("c", None)]


def test_store_of_the_driver_tables_is_written_once(spark, fixture_tables):
    one, two = stored_entities(spark, SF_SMALL), stored_entities(spark, SF_SMALL + "/")
    assert one["payment"] is two["payment"]
    assert _rows(relate(one, "payment_contribution", RELATE_FIELDS)) == _rows(
        relate(fixture_tables, "payment_contribution", RELATE_FIELDS))


def test_one_read_of_payments_writes_no_store(spark):
    """Queries that read payments once join the driver's tables directly."""
    from claimflow.plans.catalog import QUERIES

    for name in ("acr_base", "payment_rollup", "ocr_with_payments"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "lineitem.parquet" in plan and "claimflow_fact_" not in plan, name

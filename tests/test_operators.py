from collections import Counter

from pyspark.sql import functions as F

from claimflow.operators import predicates as P
from claimflow.operators.latest import latest_per_group
from claimflow.operators.relate import relate
from claimflow.operators.rollup import rollup_payments
from claimflow.operators.supplements import fold, fold_with_orphans, orphans
from claimflow.plans.lookups import latest_diagnosis, payment_rollup
from claimflow.plans.ocr import apply_measures
from helpers import D, clean_rows, make_tables

REP_END = D("2020-12-31")


def test_relate_follows_paths_and_keeps_orphan_facts(spark):
    t = make_tables(
        spark,
        organisation=[{"id": 1, "name": "Org"}],
        scheme=[{"id": 10, "number": "S10", "organisation_id": 1}],
        policy=[{"id": 100, "name": "P100", "scheme_id": 10}],
        claim=[{"id": 1000, "name": "C1000", "policy_id": 100},
               {"id": 1001, "name": "C1001", "policy_id": 999}],
        benefit_claimed=[{"id": 1, "name": "B1", "claim_id": 1000},
                         {"id": 2, "name": "B2", "claim_id": 1001},
                         {"id": 3, "name": "B3", "claim_id": None}])
    got = relate(t, "benefit_claimed", {
        "bc": "name", "claim": "claim.name", "policy": "claim.policy.name",
        "org": "claim.policy.scheme.organisation.name"}).orderBy("bc").collect()
    assert [tuple(r) for r in got] == [("B1", "C1000", "P100", "Org"),
                                       ("B2", "C1001", None, None),
                                       ("B3", None, None, None)]


def _payments(spark, rows):
    return spark.createDataFrame(
        [(r["bc"], r.get("amount"), r.get("start"), r.get("through"), r["release"],
          r.get("line", 1)) for r in rows],
        "benefit_claimed_name string, amount double, start date, through date, "
        "release date, line_number int")


def test_rollup_null_poisoning_and_ties(spark):
    df = _payments(spark, [
        # one missing amount makes the total missing
        {"bc": "A", "amount": 10.0, "release": D("2020-01-10")},
        {"bc": "A", "amount": None, "release": D("2020-01-05")},
        # start missing: release is used for the first payment
        {"bc": "B", "amount": 1.0, "start": None, "through": D("2020-02-01"),
         "release": D("2020-01-20")},
        {"bc": "B", "amount": 2.0, "start": D("2020-01-25"), "through": None,
         "release": D("2020-02-10")},
        # two payments on the latest release date: first in tie order wins
        {"bc": "C", "amount": 7.0, "release": D("2020-03-01"), "line": 2},
        {"bc": "C", "amount": 5.0, "release": D("2020-03-01"), "line": 1},
        {"bc": "C", "amount": 9.0, "release": D("2020-02-01"), "line": 0},
    ])
    got = {r.benefit_claimed_name: r for r in rollup_payments(df).collect()}
    assert got["A"].total_paid is None and got["A"].last_amount == 10.0
    assert got["B"].total_paid == 3.0
    assert got["B"].first_payment == D("2020-01-20")
    assert got["B"].last_payment == D("2020-02-10")
    assert got["B"].eff_date_last_payment == D("2020-02-10")
    assert got["C"].last_amount == 5.0 and got["C"].total_paid == 21.0


def test_rollup_hot_key_is_partition_independent(spark):
    """A group holding most rows, spread over many partitions, gives the same
    measures as one partition (partial aggregation merges exactly)."""
    rows = [{"bc": "HOT", "amount": float(i % 97) + 0.25, "release": D("2020-01-01"),
             "line": i % 5} for i in range(3000)]
    rows += [{"bc": f"K{i}", "amount": 1.0, "release": D("2020-01-01")} for i in range(50)]
    df = _payments(spark, rows)
    a = sorted(map(tuple, rollup_payments(df.repartition(1)).collect()))
    b = sorted(map(tuple, rollup_payments(df.repartition(37)).collect()))
    assert a == b
    hot = [r for r in a if r[0] == "HOT"][0]
    assert hot[4] == min(float(i % 97) + 0.25 for i in range(3000) if i % 5 == 0)


def test_latest_per_group(spark):
    df = spark.createDataFrame([
        ("C1", "DX-2", D("2020-01-01"), None, "b"),
        ("C1", "DX-1", None, D("2020-01-01"), "a"),  # tie on date: DX-1 first by name
        ("C1", "DX-0", D("2019-01-01"), None, "z"),
        ("C2", "DX-3", None, None, "x"),             # no date at all: no row
        ("C3", "DX-4", D("2018-05-05"), None, "c"),
        ("C3", None, D("2018-05-05"), None, "n"),    # missing name loses the tie
    ], "claim string, name string, start date, created date, code string")
    aux = F.coalesce(F.col("start"), F.col("created"))
    got = {r.claim: r.code for r in latest_per_group(df, "claim", aux, F.col("name"),
                                                     ["code"]).collect()}
    assert got == {"C1": "a", "C3": "c"}


def test_predicates_three_valued(spark):
    df = spark.createDataFrame([
        ("Closed", D("2020-01-01")),   # closed in the past: dropped
        ("Closed", None),              # closed without date: kept
        ("Closed", D("2021-01-01")),   # closed after period end: kept
        (None, D("2020-01-01")),       # missing status, past closure: dropped
        ("Open", D("2020-01-01")),     # not closed: kept
    ], "status string, closure date")
    kept = df.filter(P.open_at(F.col("status"), F.col("closure"), REP_END)).count()
    assert kept == 3
    reasons = spark.createDataFrame([(None,), ("",), ("Withdrawn",),
                                     ("Not a Legitimate Benefit",)], "r string")
    assert reasons.filter(P.closed_reason_in_scope(F.col("r"))).count() == 3
    status = spark.createDataFrame([(None,), ("Incomplete",), ("Open",)], "s string")
    assert status.filter(P.differs_from(F.col("s"), "Incomplete")).count() == 2


def _clean(spark):
    return clean_rows(spark, [
        # claim C1: IP primary with two SC rows on the same key, one Add, one SCAdd
        {"name": "1", "claim_name": "C1", "sc_key": "C1-2020-01-01-X",
         "benefit_name": "Income Protection", "coverage_amount": 100.0, "total_paid": 1.0},
        {"name": "2", "claim_name": "C1", "sc_key": "C1-2020-01-01-X",
         "benefit_name": "Super Contribution", "coverage_amount": 10.0, "total_paid": 2.0},
        {"name": "3", "claim_name": "C1", "sc_key": "C1-2020-01-01-X",
         "benefit_name": "Super Contribution", "coverage_amount": 20.0, "total_paid": 3.0},
        {"name": "4", "claim_name": "C1", "sc_key": "C1-2020-01-01-X",
         "benefit_name": "Additional Income Protection", "coverage_amount": 5.0,
         "total_paid": 4.0},
        {"name": "5", "claim_name": "C1", "sc_key": "C1-2020-01-01-X",
         "benefit_name": "Additional Super Contribution", "coverage_amount": 7.0,
         "total_paid": 8.0},
        # claim C2: only one Additional Super Contribution row
        {"name": "6", "claim_name": "C2", "sc_key": "C2-NA-NA",
         "benefit_name": "Additional Super Contribution", "coverage_amount": 50.0,
         "total_paid": 1.0},
        # claim C3: TPD primary with an SC under another date -> SC lost
        {"name": "7", "claim_name": "C3", "sc_key": "C3-2020-01-01-X",
         "benefit_name": "Total and Permanent Disablement", "coverage_amount": 100.0,
         "total_paid": None},
        {"name": "8", "claim_name": "C3", "sc_key": "C3-2019-01-01-X",
         "benefit_name": "Super Contribution", "coverage_amount": 10.0, "total_paid": 2.0},
        # claim C4: null benefit name is primary, TPD-like multiplier 1
        {"name": "9", "claim_name": "C4", "sc_key": "C4-NA-NA", "benefit_name": None,
         "coverage_amount": 3.0, "total_paid": 1.0},
        # claim C5: TPD primary with an SC on the same key
        {"name": "10", "claim_name": "C5", "sc_key": "C5-NA-X",
         "benefit_name": "Total and Permanent Disablement", "coverage_amount": 100.0,
         "total_paid": 1.0},
        {"name": "11", "claim_name": "C5", "sc_key": "C5-NA-X",
         "benefit_name": "Super Contribution", "coverage_amount": 10.0, "total_paid": 2.0},
    ])


def test_fold_fans_out_and_orphans(spark):
    clean = _clean(spark)
    folded = fold(clean).collect()
    c1 = [r for r in folded if r.claim_name == "C1"]
    assert len(c1) == 2  # one primary x two SC rows
    assert sorted(r.benefit_sc for r in c1) == [10.0, 20.0]
    assert {r.benefit_add for r in c1} == {5.0} and {r.benefit_sc_add for r in c1} == {7.0}
    orph = orphans(clean).collect()
    # C2's single ASC row enters through two branches; C3's SC has a primary claim
    assert sorted(r.name for r in orph) == ["6", "6"]


def test_measures_on_folded_rows(spark):
    out = apply_measures(fold_with_orphans(_clean(spark)), REP_END).collect()
    by = {}
    for r in out:
        by.setdefault(r.name, []).append(r)
    ip = sorted(by["1"], key=lambda r: r.benefit_sc)
    # (100 + add 5 + sc 10 + scadd 7) * 12 and Total PAYG adds only the SC payment
    assert ip[0].sum_insured_combined == (100 + 5 + 10 + 7) * 12
    assert ip[0].total_paid == 1.0 + 2.0
    # SC cover on a non-IP primary counts 0, not null
    assert by["10"][0].benefit_sc == 0.0 and by["10"][0].sum_insured_combined == 100.0
    # orphan ASC: from add_open combined 50, from sc_add_open (self-match) 100
    assert sorted(r.sum_insured_combined for r in by["6"]) == [50.0, 100.0]
    # TPD primary of C3 keeps a missing total; its SC under another date is gone
    assert by["7"][0].total_paid is None and "8" not in by
    assert by["9"][0].sum_insured_combined == 3.0


def test_two_level_lookups_equal_direct_aggregation(spark, fixture_tables):
    from claimflow.sources.extracts import diagnosis_extract, payments_extract

    t = fixture_tables
    direct = rollup_payments(payments_extract(t, REP_END))
    two_level = payment_rollup(t, REP_END)
    # repr: a NaN total equals itself
    a, b = (Counter(map(repr, d.collect())) for d in (direct, two_level))
    assert a == b
    dx = diagnosis_extract(t)
    aux = F.coalesce(F.col("start"), F.col("created"))
    direct = latest_per_group(dx, "claim_name", aux, F.col("name"),
                              ["medical_code", "description", "duration_factor"])
    assert Counter(map(repr, direct.collect())) == Counter(
        map(repr, latest_diagnosis(t).collect()))


def test_lookup_keys_are_unique(fixture_tables):
    t = fixture_tables
    r = payment_rollup(t, REP_END)
    assert r.count() == r.select("benefit_claimed_name").distinct().count()
    assert r.filter("benefit_claimed_name IS NULL OR benefit_claimed_name LIKE 'Shared%'").count() > 1
    d = latest_diagnosis(t)
    assert d.count() == d.select("claim_name").distinct().count()


def test_relate_rejects_unknown_paths(spark):
    import pytest

    t = make_tables(spark)
    with pytest.raises(ValueError, match="no relationship 'polcy'"):
        relate(t, "claim", {"x": "polcy.name"})


def test_orphan_claim_test_before_lookups_equals_after(spark, fixture_tables):
    """Testing the claim first (then semi-reduced lookups) gives exactly the rows
    of the definition: stack the branches, then drop claims with a primary row.
    Includes a merge key shared by two claims (one orphan, one not) and a
    missing claim name."""
    from claimflow.functions import text
    from helpers import orphan_branches
    from claimflow.plans.ocr import ocr_clean
    from claimflow.sources.fixtures import REP_END as FIXTURE_END

    def by_definition(clean):
        stacked = orphan_branches(clean)
        primary = (clean.filter(text.is_primary_benefit(F.col("benefit_name")))
                   .select(F.col("claim_name").alias("_p")).distinct())
        return stacked.join(primary, stacked["claim_name"].eqNullSafe(primary["_p"]),
                            "left_anti")

    extra = clean_rows(spark, [
        # key shared by claims "K" (orphan) and "K-A" (has a primary row)
        {"name": "20", "claim_name": "K", "sc_key": "K-A-NA", "benefit_name": "Super Contribution",
         "coverage_amount": 1.0, "total_paid": 1.0},
        {"name": "21", "claim_name": "K-A", "sc_key": "K-A-NA",
         "benefit_name": "Income Protection", "coverage_amount": 2.0, "total_paid": 2.0},
        {"name": "22", "claim_name": "K-A", "sc_key": "K-A-NA",
         "benefit_name": "Additional Income Protection", "coverage_amount": 3.0,
         "total_paid": 3.0},
        # missing claim name, supplements only
        {"name": "23", "claim_name": None, "sc_key": "NA-NA-NA",
         "benefit_name": "Additional Super Contribution", "coverage_amount": 4.0,
         "total_paid": 4.0},
        {"name": "24", "claim_name": None, "sc_key": "NA-NA-NA",
         "benefit_name": "Super Contribution", "coverage_amount": 5.0, "total_paid": 5.0},
    ])
    hand = _clean(spark).unionByName(extra)
    real = ocr_clean(fixture_tables, FIXTURE_END)
    for clean in (hand, real):
        got = Counter(map(repr, orphans(clean).collect()))
        want = Counter(map(repr, by_definition(clean).collect()))
        assert got == want and sum(got.values()) > 0


def test_rollup_sums_and_ties(spark):
    """Sub-cent amounts are summed exactly, NaN poisons, huge amounts do not fail;
    of two payments on the last day the smaller line wins, then the smaller amount,
    a missing amount last."""
    rows = [("cent", 0.005, 1, "2020-01-01"), ("cent", 0.005, 2, "2020-01-01"),
            ("nan", float("nan"), 1, "2020-01-02"), ("nan", 0.005, 2, "2020-01-01"),
            ("big", 1e17, 1, "2020-01-01"), ("big", 1.0, 2, "2020-01-01"),
            ("huge", 1e30, 1, "2020-01-01"), ("huge", 1e29, 2, "2020-01-01"),
            ("tie", 7.0, 3, "2020-01-02"), ("tie", 9.0, 1, "2020-01-02"), ("tie", 8.0, 1, "2020-01-02"),
            ("tie", None, 1, "2020-01-02"), ("tie", -5.0, 1, "2020-01-01"),
            ("noline", 4.0, None, "2020-01-02"), ("noline", 5.0, 9, "2020-01-02"),
            ("last", None, 1, "2020-01-03"), ("last", 2.0, 1, "2020-01-01"), (None, 3.0, 1, "2020-01-01")]
    df = spark.createDataFrame([(n, a, D(d), D(d), D(d), k) for n, a, k, d in rows],
                               "benefit_claimed_name string, amount double, start date, through date, "
                               "release date, line_number int")
    got = {r.benefit_claimed_name: r for r in rollup_payments(df).collect()}
    assert got["cent"].total_paid == 0.01
    assert got["nan"].total_paid != got["nan"].total_paid
    assert got["big"].total_paid == 1e17 + 1.0
    assert got["huge"].total_paid == 1e30 + 1e29
    assert got["tie"].last_amount == 8.0 and got["tie"].total_paid is None
    assert got["noline"].last_amount == 5.0
    assert got["last"].last_amount is None and got[None].total_paid == 3.0
    plan = rollup_payments(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Sort [" not in plan


def test_rollup_is_joined_by_name(spark):
    """Benefits that share a name share its rollup; a missing name is a name too."""
    from claimflow.plans.ocr import ocr_clean

    claim = {"id": 1, "name": "C", "claim_type": "Claim", "business_type": "Group"}
    bc = dict(claim_id=1, status="Open", notification_date=D("2020-01-01"))
    pay = dict(line_number=1, payment_status="Processed", payment_release=D("2020-02-01"))  # no month
    t = make_tables(spark, claim=[claim], benefit_claimed=[
        {**bc, "id": 1, "name": "B"}, {**bc, "id": 2, "name": "B"}, {**bc, "id": 3}, {**bc, "id": 4, "name": "D"}],
        payment_contribution=[{**pay, "benefit_claimed_id": 1, "amount": 10.0},
                              {**pay, "benefit_claimed_id": 2, "amount": 5.0},
                              {**pay, "benefit_claimed_id": 3, "amount": 2.0}])
    got = Counter((r["name"], r["total_paid"]) for r in ocr_clean(t, D("2020-12-31")).collect())
    assert got == {("B", 15.0): 2, (None, 2.0): 1, ("D", None): 1}


def test_open_filter_runs_before_the_wide_joins(fixture_tables):
    from claimflow.operators.audit import StageTaps
    from claimflow.plans.ocr import ocr_open

    plan = ocr_open(fixture_tables, REP_END, StageTaps())._jdf.queryExecution().optimizedPlan().toString()
    depth = {}
    for line in plan.splitlines():
        for mark in ("CollectMetrics open_at", "c_acctbal", "legacy_member_number"):
            if mark in line:
                depth.setdefault(mark, len(line) - len(line.lstrip(" :+-")))
    # the observed open rows lie deeper in the plan than the join that brings the policy
    joins = [len(x) - len(x.lstrip(" :+-")) for x in plan.splitlines() if "Join LeftOuter" in x]
    assert depth["CollectMetrics open_at"] > min(joins)
    below = plan[plan.index("CollectMetrics open_at"):]
    above = plan[:plan.index("CollectMetrics open_at")]
    assert above.count("Join LeftOuter") >= 3 and "legacy_member_number" in above
    assert "legacy_member_number" not in below.split("CollectMetrics ocr_base")[1].split("Relation")[0]


def test_rollup_picks_exactly_for_any_amount(spark):
    """Of rows that tie on day and line the least amount wins, however large the amounts are
    or however little they differ; also when states of parts are merged."""
    import random

    from claimflow.operators.rollup import finish, merged, states

    rng = random.Random(5)
    amounts = [1e14, 2e14, 3e17, -4e18, 1e300, -1e300, 1.0000000001, 1.0000000002, 5e-324, 0.0, -7.5,
               float("inf"), float("-inf"), float("nan"), None]
    days = [D("0001-01-01"), D("2020-02-29"), D("9999-12-31"), None]
    lines = [-2 ** 31, 0, 7, 2 ** 31 - 1, None]
    rows = [(f"B{rng.randrange(40)}" if rng.random() < 0.95 else None, rng.randrange(3), rng.choice(amounts),
             rng.choice(days), rng.choice(lines)) for _ in range(1500)]
    df = spark.createDataFrame([(n, k, a, d, d, d, x) for n, k, a, d, x in rows],
                               "benefit_claimed_name string, part int, amount double, start date, through date, "
                               "release date, line_number int").repartition(5)
    cols = [F.col(c) for c in ("amount", "start", "through", "release", "line_number")]
    parts = states(df, ["benefit_claimed_name", "part"], *cols)
    two = finish(merged(parts, ["benefit_claimed_name"]), "benefit_claimed_name")

    def place(amount):
        return (2, 0) if amount is None else (1, 0) if amount != amount else (0, amount)

    want = {}
    for n, _, a, d, x in rows:
        want.setdefault(n, []).append((d, x, a))
    for out in (rollup_payments(df), two):
        got = {r.benefit_claimed_name: r for r in out.collect()}
        assert got.keys() == want.keys()
        for n, group in want.items():
            complete = all(d is not None for d, _, _ in group)
            best = min((g for g in group if g[0]), key=lambda g: (
                -g[0].toordinal(), g[1] is None, g[1] or 0, place(g[2])), default=(None, None, None))
            assert repr(got[n].last_amount) == repr(best[2] if complete else None), n
        assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_latest_diagnosis_aggregates_no_text(spark, fixture_tables):
    plan = latest_diagnosis(fixture_tables)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan
    assert "partial_max" in plan


def test_latest_ties_end_with_the_payload(spark):
    data = [("A", "n", D("2020-01-01"), "z", None), ("A", "n", D("2020-01-01"), "b", "q"), ("A", None, D("2020-01-01"), "a", "a"),
            (None, "m", D("2020-01-01"), "c", "c"), (None, "k", D("2020-01-02"), "d", "d"), ("none", "x", None, "e", "e")]
    df = spark.createDataFrame(data, "claim string, name string, d date, code string, text string")
    got = latest_per_group(df, "claim", F.col("d"), F.col("name"), ["code", "text"]).collect()
    assert {tuple(r) for r in got} == {("A", "b", "q"), (None, "d", "d")}

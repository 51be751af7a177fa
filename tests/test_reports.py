import glob
from collections import Counter
import os

import pytest

from claimflow.plans.acr import ACR_COLUMNS, acr_report
from claimflow.plans.ocr import OCR_COLUMNS, ocr_report
from claimflow.session import scratch_path
from claimflow.sources.fixtures import REP_END, REP_START
from claimflow.sources.sinks import (acr_file_name, ocr_file_name, read_csv, write_report)
from helpers import SF_SMALL
from helpers import make_tables


def test_report_schemas(fixture_tables):
    ocr = ocr_report(fixture_tables, REP_END)
    acr = acr_report(fixture_tables, REP_START, REP_END)
    assert ocr.columns == [c for c, _ in OCR_COLUMNS] and len(ocr.columns) == 54
    assert acr.columns == [c for c, _ in ACR_COLUMNS] and len(acr.columns) == 34
    types = dict(ocr.dtypes)
    assert types["Date Incurred"] == "date" and types["Date Of Birth"] == "string"
    assert types["No. of Days on Claim (GSC)"] == "double"
    assert dict(acr.dtypes)["Date Incurred"] == "string"
    assert dict(acr.dtypes)["Date Notified of Claim"] == "date"


def test_empty_report_writes_header_only(spark):
    empty = make_tables(spark)
    report = ocr_report(empty, REP_END)
    assert report.isEmpty()
    target = scratch_path(spark, "empty")
    assert write_report(report, [target]) == 0
    lines = []
    local = target[len("file:"):] if target.startswith("file:") else target
    for f in sorted(glob.glob(os.path.join(local, "part-*.csv"))):
        lines += open(f).read().splitlines()
    assert len(lines) == 1 and lines[0].split(",")[0] == "Product Variant"
    assert len(lines[0].split(",")) == 54


def test_report_to_two_destinations_roundtrips(spark, fixture_tables):
    report = acr_report(fixture_tables, REP_START, REP_END)
    a = scratch_path(spark, acr_file_name(REP_START, REP_END))
    b = scratch_path(spark, "synced-" + ocr_file_name(REP_END))
    n = write_report(report, [a, b])
    assert n == report.count() > 0
    expected = Counter(map(repr, report.collect()))
    for target in (a, b):
        assert Counter(map(repr, read_csv(spark, target, report.schema).collect())) == expected


def test_file_names():
    assert ocr_file_name(REP_END) == "OCR_2000-12-31_modified.csv"
    assert acr_file_name(REP_START, REP_END) == "ACR_1999-01-01_2000-12-31.csv"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["ocr_report", "acr_report", "payment_rollup",
                                  "latest_diagnosis", "relate_paths"])
def test_plans_have_no_python_or_cartesian(spark, name):
    import __spark_entry__ as E

    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "PythonUDF"):
        assert bad not in plan


def test_extract_filters_reach_the_scan(spark):
    import __spark_entry__ as E

    plan = _plan(E.queries()["acr_base"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan


def test_result_unchanged_after_repartitioning_inputs(spark):
    from claimflow.sources.fixtures import entities

    t = entities(spark, SF_SMALL)
    shuffled = {k: v.repartition(7) for k, v in t.items()}
    a = Counter(map(repr, acr_report(t, REP_START).collect()))
    b = Counter(map(repr, acr_report(shuffled, REP_START).collect()))
    assert a == b


def test_entry_smoke(spark):
    import __spark_entry__ as E
    from claimflow.plans.catalog import QUERIES

    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) == 54
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_audited_runs_match_stage_audit(spark):
    """Counts observed while writing the reports equal the stage_audit query."""
    import __spark_entry__ as E
    from claimflow.plans.acr import run_acr
    from claimflow.plans.ocr import run_ocr
    from claimflow.sources.fixtures import entities

    from claimflow.session import checkpoint_dir

    t = entities(spark, SF_SMALL)
    staged_before = set(glob.glob(checkpoint_dir(spark).removeprefix("file:") + "/ocr_open_claims-*"))
    got = {(s, m): v for s, m, v in run_ocr(t, REP_END, [scratch_path(spark, "ocr")])}
    # the run deletes the table it staged once the report is written
    assert set(glob.glob(checkpoint_dir(spark).removeprefix("file:") + "/ocr_open_claims-*")) \
        <= staged_before
    got.update({(s, m): v for s, m, v in
                run_acr(t, REP_START, REP_END, [scratch_path(spark, "acr")])})
    want = {(r.stage, r.metric): r.value for r in E.queries()["stage_audit"](spark, SF_SMALL)
            .collect()}
    for key in [("ocr_base", "rows"), ("open_at", "rows"), ("supplement_fold", "rows"),
                ("orphan_supplements", "rows"), ("ocr_report", "rows"),
                ("ocr_with_payments", "unmatched"), ("acr_report", "rows")]:
        assert got[key] == want[key], key
    assert got[("acr_base", "no_diagnosis")] == want[("acr_report", "no_diagnosis")]
    assert got[("acr_base", "rows")] == want[("acr_report", "rows")]


def test_csv_numbers_are_plain_and_exact(spark):
    import glob as g

    values = [12345678.9, 1e7, 0.30000000000000004, -0.5, 100.0, 1355355.12 * 1.0, 5e-7,
              float("nan"), 1e25, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    target = scratch_path(spark, "numbers")
    write_report(df, [target])
    local = target[len("file:"):] if target.startswith("file:") else target
    text = "".join(open(f).read() for f in sorted(g.glob(os.path.join(local, "part-*.csv"))))
    assert "12345678.9" in text and "10000000\n" in text and "E7" not in text
    back = {r.i: r.x for r in read_csv(spark, target, df.schema).collect()}
    for i, v in enumerate(values):
        if v is None:
            assert back[i] is None
        elif v != v:
            assert back[i] != back[i]
        else:
            assert back[i] == v, (v, back[i])

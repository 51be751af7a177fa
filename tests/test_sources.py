import re
from collections import Counter

from claimflow.plans.acr import acr_report
from claimflow.plans.ocr import ocr_report
from claimflow.session import scratch_path
from claimflow.sources.entities import SCHEMAS, read_entities, write_entities
from claimflow.sources.extracts import diagnosis_extract, payments_extract
from claimflow.sources.fixtures import REP_END, REP_START


def test_fixture_objects_have_the_declared_schemas(fixture_tables):
    for name, schema in SCHEMAS.items():
        got = [(f.name, f.dataType) for f in fixture_tables[name].schema.fields]
        assert got == [(f.name, f.dataType) for f in schema.fields], name


def test_production_reader_roundtrip(spark, fixture_tables):
    """Objects written as one parquet folder each and read back with the
    declared schemas give the same reports."""
    root = scratch_path(spark, "extracts")
    write_entities(fixture_tables, root)
    tables = read_entities(spark, root)
    for build in (lambda t: acr_report(t, REP_START, REP_END),
                  lambda t: ocr_report(t, REP_END),
                  lambda t: payments_extract(t, REP_END),
                  lambda t: diagnosis_extract(t)):
        a = Counter(map(repr, build(fixture_tables).collect()))  # repr: NaN equals itself
        b = Counter(map(repr, build(tables).collect()))
        assert a == b and sum(a.values()) > 0


def test_production_reader_scan_is_pruned_and_filtered(spark, fixture_tables):
    root = scratch_path(spark, "extracts")
    write_entities(fixture_tables, root)
    tables = read_entities(spark, root)
    plan = acr_report(tables, REP_START)._jdf.queryExecution().executedPlan().toString()
    # whole release-month folders before the period start are never listed for reading
    assert re.search(r"PartitionFilters: \[[^\]]*release_month#\d+ >= 1999-01-01", plan)
    assert "GreaterThanOrEqual(release,1999-01-01)" in plan
    plan = payments_extract(tables, REP_END)._jdf.queryExecution().executedPlan().toString()
    assert "<= 2000-12-01" in plan


def test_month_end_run(spark, fixture_tables, capsys):
    import datetime as dt
    import json

    from claimflow.__main__ import main, previous_month_end

    assert previous_month_end(dt.date(2026, 3, 31)) == dt.date(2026, 2, 28)
    assert previous_month_end(dt.date(2024, 3, 1)) == dt.date(2024, 2, 29)
    root = scratch_path(spark, "extracts")
    write_entities(fixture_tables, root)
    out_a, out_b = scratch_path(spark, "reports"), scratch_path(spark, "synced")
    audit = main(["--extracts", root, "--reports", out_a, "--reports", out_b,
                  "--rep-start", REP_START.isoformat(), "--rep-end", REP_END.isoformat()])
    got = {(s, m): v for s, m, v in audit}
    assert got[("ocr_report", "rows")] == ocr_report(fixture_tables, REP_END).count()
    assert got[("acr_report", "rows")] == acr_report(fixture_tables, REP_START).count()
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert len(lines) == len(audit)
    from claimflow.sources.sinks import acr_file_name, ocr_file_name, read_csv
    for folder in (out_a, out_b):
        ocr_back = read_csv(spark, f"{folder}/{ocr_file_name(REP_END)}",
                            ocr_report(fixture_tables, REP_END).schema)
        assert ocr_back.count() == got[("ocr_report", "rows")]
        acr_back = read_csv(spark, f"{folder}/{acr_file_name(REP_START, REP_END)}",
                            acr_report(fixture_tables, REP_START).schema)
        assert acr_back.count() == got[("acr_report", "rows")]


def test_text_extracts_are_cast_tolerantly(spark, fixture_tables):
    """CSV (all-text) extracts give the same reports as typed ones."""
    from pyspark.sql import functions as F

    root = scratch_path(spark, "text-extracts")
    for name, df in fixture_tables.items():
        df = df.select([F.col(c).cast("string") for c in df.columns])
        df.write.options(header="true", escape='"').csv(f"{root}/{name}")
    tables = read_entities(spark, root, fmt="csv")
    assert tables["payment_contribution"].columns == [f.name for f in SCHEMAS["payment_contribution"].fields]

    def rows(df):  # a text extract cannot tell a blank field from a missing one
        return Counter(tuple(None if v == "" or v != v else v for v in r) for r in df.collect())

    # NaN is not a number in text: those amounts are missing there
    paid = fixture_tables["payment_contribution"].withColumn(
        "amount", F.when(~F.isnan("amount"), F.col("amount")))
    typed = {**fixture_tables, "payment_contribution": paid}
    for build in (lambda t: acr_report(t, REP_START, REP_END), lambda t: ocr_report(t, REP_END)):
        assert rows(build(typed)) == rows(build(tables))


def test_text_extract_is_bound_by_header(spark):
    """Reordered and dropped columns, line ends in a field, text ids, dates in other
    forms that the payments report passes on as delivered."""
    import pytest

    from claimflow.sources.entities import from_text

    raw = spark.createDataFrame([("line one\nline two", "a0X7", "Group")], "name string, id string, business_type string")
    root = scratch_path(spark, "bound")
    keys = raw.selectExpr("name", "id", "business_type", "'p' AS policy_id", "'c' AS claimant_id", "'o' AS owner_id")
    keys.write.options(header="true", escape='"').csv(root)
    from claimflow.sources.entities import TEXT_OPTIONS
    [row] = from_text(spark.read.options(**TEXT_OPTIONS).csv(root), "claim").collect()
    assert (row["id"], row["name"], row["business_type"]) == ("a0X7", "line one\nline two", "Group")
    assert row["status"] is None and row["claim_type"] is None and row["form_received"] is None
    with pytest.raises(ValueError, match="owner_id"):
        from_text(keys.drop("owner_id"), "claim")
    dates = spark.createDataFrame([("1", "31/12/2020", "x")], "id string, closure_date string, line_number string")
    got = from_text(dates.selectExpr("*", "id AS claim_id", "id AS benefit_id", "id AS modified_by_id"),
                    "benefit_claimed").collect()[0]
    assert got["closure_date"] == "31/12/2020"


def test_csv_sink_keeps_blanks_line_ends_and_digits(spark):
    from pyspark.sql import types as T

    from claimflow.sources.sinks import read_csv, write_report

    schema = T.StructType([T.StructField("A b", T.StringType()), T.StructField("x", T.DoubleType())])
    data = [(" lead and trail  ", 1e-20), ("two\nlines", 0.0012345678901234567), ("cr\r\nlf", 1.5e300),
            ('quote "q", comma', -12345678.9), ("plain", 100.0), (None, None), ("tab\t", 4.9e-324),
            ("nan", float("nan")), ("inf", float("-inf")), ("zero", -0.0)]
    df = spark.createDataFrame(data, schema).repartition(2)
    targets = [scratch_path(spark, "sink"), scratch_path(spark, "sink")]
    assert write_report(df, targets) == len(data)
    for target in targets:
        back = read_csv(spark, target, schema).collect()
        assert Counter(map(repr, map(tuple, back))) == Counter(map(repr, data))
        text = "".join(r[0] + "\n" for r in spark.read.text(target).collect())
        assert "E-" not in text and "0.00000000000000000001" in text


def test_audited_run_on_empty_tables(spark):
    from helpers import make_tables

    from claimflow.plans.ocr import run_ocr

    audit = run_ocr(make_tables(spark), REP_END, [scratch_path(spark, "empty")])
    assert {v for _, _, v in audit} == {0} and ("ocr_report", "rows", 0) in audit


def test_cluster_without_a_shared_folder_is_refused():
    import pytest

    from claimflow.session import checkpoint_dir

    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())

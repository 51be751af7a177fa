import datetime as dt

from pyspark.sql import functions as F

from claimflow.functions import measures as M
from claimflow.functions import text
from claimflow.functions.casts import as_date, as_number, parse_date, prior_month_end
from helpers import D


def test_tolerant_number_and_date_casts(spark):
    df = spark.createDataFrame(
        [("abc", "junk"), ("12.5", "2022-01-31T23:30:00.000Z"), ("", "2022/01/31"),
         ("1e3", "20220131"), (None, None), ("7", "2022"), ("-3", "2022-1-5 10:00")],
        "amount string, created string")
    out = as_date(as_number(df, ["amount"]), ["created"]).collect()
    assert [r.amount for r in out] == [None, 12.5, None, 1000.0, None, 7.0, -3.0]
    assert [r.created for r in out] == [None, D("2022-01-31"), D("2022-01-31"),
                                        D("2022-01-31"), None, None, D("2022-01-05")]


def test_casts_leave_typed_columns_alone(spark):
    df = spark.createDataFrame([(1.5, dt.date(2020, 1, 2))], "a double, d date")
    out = as_date(as_number(df, ["a"]), ["d"])
    assert out.schema == df.schema


def test_prior_month_end(spark):
    df = spark.createDataFrame([(D("2026-03-31"),), (D("2026-03-01"),), (D("2024-03-15"),),
                                (D("2026-01-10"),)], "d date")
    got = [r[0] for r in df.select(prior_month_end(F.col("d"))).collect()]
    assert got == [D("2026-02-28"), D("2026-02-28"), D("2024-02-29"), D("2025-12-31")]


def test_merge_key_prints_missing_parts_as_na(spark):
    df = spark.createDataFrame([("C1", D("2020-01-01"), "X"), ("C1", None, None),
                                (None, None, "X")], "c string, d date, k string")
    got = [r[0] for r in df.select(text.merge_key(F.col("c"), F.col("d"), F.col("k"))).collect()]
    assert got == ["C1-2020-01-01-X", "C1-NA-NA", "NA-NA-X"]


NAMES = ["Income Protection", "Super Contribution", "Super Contribution Extra",
         "Additional Super Contribution", "Additional Income Protection", "AdditionalX",
         "Additional ", "Additional Super", "Total and Permanent Disablement",
         "Voluntary Super Contribution", "Additional Voluntary Super Contribution", None, ""]


def test_benefit_classes_equal_the_regex_definitions(spark):
    """Prefix/contains tests equal the regexes, look-ahead included."""
    df = spark.createDataFrame([(n,) for n in NAMES], "n string")
    n = F.col("n")
    pairs = [
        (text.is_super_contribution(n), text.grepl(n, "^Super Contribution")),
        (text.mentions_super_contribution(n), text.grepl(n, "Super Contribution")),
        (text.is_additional_super_contribution(n),
         text.grepl(n, "Additional Super Contribution")),
        (text.starts_additional(n), text.grepl(n, "^Additional")),
        (text.is_additional_benefit(n), text.grepl(n, "^Additional (?!(Super Contribution))")),
        (text.is_income_protection(n), text.grepl(n, "Income Protection")),
        (text.is_primary_benefit(n),
         ~text.grepl(n, "Super Contribution") & ~text.grepl(n, "Additional Super Contribution")
         & ~text.grepl(n, "^Additional")),
    ]
    for mine, regex in pairs:
        rows = df.select(mine.alias("a"), regex.alias("b")).collect()
        assert all(r.a == r.b for r in rows), rows
        assert all(r.a is not None for r in rows)


def test_measures_null_handling(spark):
    df = spark.createDataFrame(
        [("Income Protection", 100.0, None, 10.0, None, 5.0, None),
         ("Total and Permanent Disablement", 100.0, 1.0, 10.0, 2.0, None, 3.0),
         (None, None, 1.0, 1.0, 1.0, 5.0, 1.0)],
        "n string, cover double, add double, sc double, scadd double, p double, e double")
    n = F.col("n")
    out = df.select(
        M.sc_cover_for_income_protection(F.col("sc"), n).alias("sc"),
        M.sum_insured_combined(F.col("cover"), F.col("add"),
                               M.sc_cover_for_income_protection(F.col("sc"), n),
                               F.col("scadd"), n).alias("combined"),
        M.waiting_period_total(F.col("p"), F.col("e")).alias("wpt"),
        M.annual_sum_insured(F.col("cover"), n).alias("annual")).collect()
    assert [r.sc for r in out] == [10.0, 0.0, 0.0]
    assert [r.combined for r in out] == [1320.0, 103.0, None]
    assert [r.wpt for r in out] == [None, None, 6.0]
    assert [r.annual for r in out] == [1200.0, 100.0, None]


def test_days_on_claim_can_be_negative(spark):
    df = spark.createDataFrame([("Income Protection", D("2020-03-01"), D("2020-02-01")),
                                ("Other", D("2020-01-01"), D("2020-02-01"))],
                               "n string, f date, l date")
    got = [r[0] for r in df.select(M.days_on_claim(F.col("f"), F.col("l"), F.col("n"))).collect()]
    assert got == [-29.0, None]


def test_parse_date_is_a_builtin_expression(spark):
    df = spark.createDataFrame([("2020-01-01",)], "s string").select(parse_date(F.col("s")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan

"""Quality checks and derived analyses on hand-made frames."""

import pytest

from panelforge.operators import checks
from panelforge.operators.filters import EmptyInputError, domain_profile, require_rows
from panelforge.plans import insights
from panelforge.contracts import DATASETS
from panelforge.plans.load import load_table
from tests.conftest import rows

GG = ("country string, year bigint, hours_worked_m double, hours_worked_f double, "
      "hours_worked_delta double, gender_pay_gap double, accidents_m double, accidents_f double, "
      "employed_m double, employed_f double")
REL = ("country string, year bigint, marriage_rate double, divorce_rate double, "
       "age_at_marriage_f double, age_at_marriage_m double, gender_pay_gap double")


def test_check_counts(spark):
    df = spark.createDataFrame([("BE", 2005, -1.0), ("BE", 2005, None), ("NL", 2005, 2.0)],
                               "country string, year bigint, v double")
    report = checks.run_checks(df, not_null=("v",), unique=("country", "year"), non_negative=("v",))
    got = {(r.check, r.column_name): r.violations for r in report.collect()}
    assert got == {("not_null", "v"): 1, ("non_negative", "v"): 1, ("unique", "country,year"): 1}
    with pytest.raises(checks.QualityCheckError):
        checks.enforce(report, "t")
    assert len(checks.enforce(report, "t", mode="warn")[None]) == 3


def test_changes_only_between_neighbouring_years(spark):
    rel = spark.createDataFrame(
        [("BE", y, v) for y, v in ((2005, 10.0), (2006, 9.5), (2010, 5.0), (2011, 4.0))]
        + [("NL", y, float(y)) for y in (2005, 2006, 2007)], "country string, year bigint, marriage_rate double")
    got = {r.country: (r.drop_year, r["drop"]) for r in insights.marriage_rate_drop(rel).collect()}
    assert got == {"BE": (2011, -1.0), "NL": (None, None)}
    gaps = rel.selectExpr("country", "year", "marriage_rate AS gender_pay_gap", "1.0D AS hours_worked_delta",
                          "marriage_rate AS employed_m", "0.0D AS employed_f", "0.0D AS accidents_m",
                          "marriage_rate AS accidents_f")
    moves = {r.country: r for r in insights.gap_comovement(gaps).collect()}
    assert moves["BE"].pay_changes == 2 and moves["NL"].pay_changes == 2
    assert moves["BE"].employed_agree == 1.0 and moves["BE"].accidents_agree == 0.0


def test_panel_correlation_is_one_row(spark):
    rel = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 1.0), (3.0, 6.0, 2.0)],
                                "gender_pay_gap double, marriage_rate double, divorce_rate double")
    rows = insights.pay_gap_correlation(rel, by=None).collect()
    assert len(rows) == 1 and rows[0].corr_marriage == 1.0 and rows[0].corr_divorce == -0.5


def test_empty_input_and_filter_matching_nothing(spark):
    empty = spark.createDataFrame([], "freq string, sex string, country string, `2005` double")
    with pytest.raises(EmptyInputError):
        require_rows(empty, "x")
    df = spark.createDataFrame([("A", "M", "BE", "Y20-64", "TOTAL", "PC", 1.0)],
                               "freq string, sex string, country string, age string, nace_r2 string, unit string, `2005` double")
    assert load_table(df, DATASETS["employed"]).count() == 0  # silent by default
    with pytest.raises(EmptyInputError):
        load_table(df, DATASETS["employed"], check_output=True)


def test_domain_profile(spark):
    df = spark.createDataFrame([("M", "TOTAL"), ("F", "TOTAL"), ("M", "C")], "sex string, nace_r2 string")
    assert rows(domain_profile(df, ["sex", "nace_r2"])) == [
        ("nace_r2", "C", 1), ("nace_r2", "TOTAL", 2), ("sex", "F", 1), ("sex", "M", 2)]


def test_zero_denominator_gives_null(spark):
    df = spark.createDataFrame([("BE", 2005, 0.0, 1.0, None, None, None)], REL)
    assert insights.divorce_marriage_ratio(df).first().divorce_to_marriage is None


def test_flat_or_single_row_correlation_is_null(spark):
    flat = spark.createDataFrame([("BE", 2005, 1.0, 1.0, None, None, 3.0),
                                  ("NL", 2005, 1.0, 2.0, None, None, 4.0)], REL)
    r = insights.pay_gap_correlation(flat).first()
    assert r.corr_marriage is None and r.corr_divorce == 1.0
    one = spark.createDataFrame([("BE", 2005, 1.0, 1.0, None, None, 3.0)], REL)
    assert insights.pay_gap_correlation(one).first().corr_divorce is None


def test_marriage_drop_tie_goes_to_earliest_year(spark):
    df = spark.createDataFrame([("BE", 2005, 5.0, None, None, None, None), ("BE", 2006, 4.0, None, None, None, None),
                                ("BE", 2007, 5.0, None, None, None, None), ("BE", 2008, 4.0, None, None, None, None)], REL)
    r = insights.marriage_rate_drop(df).first()
    assert (r.drop_year, r.drop) == (2006, -1.0)


def test_convergence_and_reduction(spark):
    df = spark.createDataFrame([("BE", 2005, 1.0, None, 25.0, 28.0, 10.0),
                                ("BE", 2006, 1.0, None, 26.0, 28.0, 8.0)], REL)
    r = insights.age_gap_convergence(df).first()
    assert (r.gap_first, r.gap_last, r.gap_change, r.converging) == (3.0, 2.0, -1.0, True)
    assert insights.pay_gap_trend(df).first().gap_slope == -2.0
    gg = spark.createDataFrame([("BE", 2005, 40.0, 30.0, 10.0, 5.0, 3.0, 1.0, 60.0, 40.0),
                                ("BE", 2006, 40.0, 32.0, 8.0, 4.0, 0.0, 0.0, 55.0, 45.0)], GG)
    red = insights.employment_gap_reduction(gg).first()
    assert red.reduction == 0.5
    shares = {r.year: (r.male_share, r.male_to_female) for r in insights.accident_share(gg).collect()}
    assert shares == {2005: (0.75, 3.0), 2006: (None, None)}
    co = insights.gap_comovement(gg).first()
    assert (co.pay_changes, co.hours_agree, co.employed_agree) == (1, 1.0, 1.0)


def test_preview_is_ordered_top_k(spark):
    df = spark.createDataFrame([("NL", 2005, 1.0, None, None, None, None),
                                ("BE", 2006, 1.0, None, None, None, None),
                                ("BE", 2005, 1.0, None, None, None, None)], REL)
    assert [(r.country, r.year) for r in insights.preview(df, 2).collect()] == [("BE", 2005), ("BE", 2006)]

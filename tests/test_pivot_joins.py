"""Conditional-aggregate pivot (staging) and left-deep joins (analytics)."""

from pyspark.sql import functions as F

from panelforge.contracts import DATASETS
from panelforge.operators.joins import left_join_all
from panelforge.operators.pivot import conditional_pivot, pivot_values, self_join_split
from panelforge.plans.analytics import final_table
from panelforge.plans.staging import stage_table
from tests.conftest import rows

LONG = "country string, year bigint, sex string, hours_worked double"


def test_one_sided_group_gives_nulls_not_zero(spark):
    df = spark.createDataFrame([("BE", 2005, "M", 40.0)], LONG)
    out = stage_table(df, DATASETS["hours_worked"]).first()
    assert (out.hours_worked_m, out.hours_worked_f, out.hours_worked_delta) == (40.0, None, None)
    acc = spark.createDataFrame([("BE", 2005, "M", 3.0)], "country string, year bigint, sex string, accidents double")
    a = stage_table(acc, DATASETS["accidents"]).first()
    assert (a.accidents_m, a.accidents_f) == (3.0, None)


def test_only_unknown_codes_keep_the_key(spark):
    df = spark.createDataFrame([("OTHER", "BE", 2005, 30.0)],
                               "indic_de string, country string, year bigint, age_at_marriage double")
    out = stage_table(df, DATASETS["age_at_marriage"]).collect()
    assert [(r.country, r.age_at_marriage_f, r.age_at_marriage_m) for r in out] == [("BE", None, None)]


def test_sub_groups_unweighted_mean_and_delta(spark):
    df = spark.createDataFrame([("BE", 2005, "M", 40.0), ("BE", 2005, "M", 30.0),
                                ("BE", 2005, "F", 20.0)], LONG)
    out = stage_table(df, DATASETS["hours_worked"]).first()
    assert (out.hours_worked_m, out.hours_worked_f, out.hours_worked_delta) == (35.0, 20.0, 15.0)


def test_two_units_summed(spark):
    df = spark.createDataFrame([("BE", 2005, "F", 2.0), ("BE", 2005, "F", 5.0)],
                               "country string, year bigint, sex string, accidents double")
    assert stage_table(df, DATASETS["accidents"]).first().accidents_f == 7.0


def test_passthrough_keeps_duplicates(spark):
    df = spark.createDataFrame([("BE", 2005, 1.0), ("BE", 2005, 2.0)],
                               "country string, year bigint, gender_pay_gap double")
    assert stage_table(df, DATASETS["gender_pay_gap"]).count() == 2


def test_generic_pivot_and_self_join_equal_conditional_pivot(spark):
    df = spark.createDataFrame([("BE", 2005, "M", 40.0), ("BE", 2005, "F", 20.0),
                                ("BE", 2006, "M", 41.0), ("NL", 2005, "F", 10.0)], LONG)
    a = stage_table(df, DATASETS["hours_worked"]).drop("hours_worked_delta")
    b = pivot_values(df, ["country", "year"], "sex", ["M", "F"], "hours_worked")
    c = self_join_split(df, "hours_worked", "sex", (("hours_worked_m", "M"), ("hours_worked_f", "F")))
    cols = ("country", "year", "hours_worked_m", "hours_worked_f")
    assert rows(a, *cols) == rows(b, *cols) == rows(c, *cols)


def test_self_join_without_reduction_multiplies_rows(spark):
    df = spark.createDataFrame([("BE", 2005, "M", 40.0), ("BE", 2005, "M", 30.0),
                                ("BE", 2005, "F", 20.0), ("BE", 2005, "F", 10.0)], LONG)
    m = df.filter(F.col("sex") == "M").select("country", "year", F.col("hours_worked").alias("m"))
    f = df.filter(F.col("sex") == "F").select("country", "year", F.col("hours_worked").alias("f"))
    assert m.join(f, ["country", "year"]).count() == 4  # the rejected design
    assert stage_table(df, DATASETS["hours_worked"]).count() == 1


def _staged(spark, **overrides):
    base = {
        "hours_worked": [("BE", 2005, 40.0, 30.0, 10.0), ("NL", 2005, 38.0, 36.0, 2.0)],
        "gender_pay_gap": [("BE", 2005, 5.0)],
        "accidents": [("BE", 2005, 3.0, 1.0), ("DE", 2005, 9.0, 9.0)],
        "employed": [],
    }
    base.update(overrides)
    schemas = {
        "hours_worked": "country string, year bigint, hours_worked_m double, hours_worked_f double, hours_worked_delta double",
        "gender_pay_gap": "country string, year bigint, gender_pay_gap double",
        "accidents": "country string, year bigint, accidents_m double, accidents_f double",
        "employed": "country string, year bigint, employed_m double, employed_f double",
    }
    return {k: spark.createDataFrame(v, schemas[k]) for k, v in base.items()}


def test_anchor_rows_survive_and_right_only_keys_are_lost(spark):
    out = final_table("gender_gap", _staged(spark))
    assert rows(out, "country", "gender_pay_gap", "accidents_m") == [("BE", 5.0, 3.0), ("NL", None, None)]
    assert str(out.first().year_date) == "2005-12-31"


def test_duplicate_right_key_doubles_anchor_row(spark):
    staged = _staged(spark, gender_pay_gap=[("BE", 2005, 5.0), ("BE", 2005, 6.0)])
    assert final_table("gender_gap", staged).count() == 3


def test_null_keys_never_match(spark):
    a = spark.createDataFrame([(None, 2005, 1.0)], "country string, year bigint, x double")
    b = spark.createDataFrame([(None, 2005, 2.0)], "country string, year bigint, y double")
    assert left_join_all(a, [b]).first().y is None


def test_local_variant_has_no_date(spark):
    out = final_table("gender_gap", _staged(spark), with_year_date=False)
    assert "year_date" not in out.columns and out.columns[:2] == ["country", "year"]


def test_conditional_pivot_is_one_aggregate(spark):
    df = spark.createDataFrame([("BE", 2005, "M", 40.0)], LONG)
    plan = stage_table(df, DATASETS["hours_worked"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 1
    assert conditional_pivot is not None

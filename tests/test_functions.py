"""Scalar expressions: year labels, period-end dates, safe ratios, guarded correlation."""

import datetime

import pytest
from pyspark.sql import functions as F

from panelforge.functions import guarded_corr, label_to_year, period_end_date, safe_ratio
from panelforge.sources.extracts import year_column_name


def test_label_to_year(spark):
    df = spark.createDataFrame([("_2013",), ("2014",)], "label string")
    assert [r.y for r in df.select(label_to_year("label").alias("y")).collect()] == [2013, 2014]


def test_malformed_label_raises_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("foo",)], "label string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(label_to_year("label")).collect()


def test_period_end_date_and_null_year(spark):
    df = spark.createDataFrame([(2005,), (None,)], "year bigint")
    got = [r.d for r in df.select(period_end_date("year").alias("d")).collect()]
    assert got == [datetime.date(2005, 12, 31), None]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r.q for r in df.select(safe_ratio("a", "b").alias("q")).collect()] == [None, None, 1.5]


def test_guarded_corr_ignores_rows_with_one_side_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 7.0)], "x double, y double")
    assert df.agg(F.round(guarded_corr("x", "y"), 9).alias("c")).first().c == 1.0


def test_year_column_names():
    assert [year_column_name(y) for y in (1995, 1996)] == ["_1995", "1996"]


def test_sizing_conf_scales_with_input():
    from panelforge.session import sizing_conf
    small = sizing_conf(40 * 1024 * 1024)
    big = sizing_conf(100 * 1024 ** 4)
    assert small["spark.sql.shuffle.partitions"] == "1"
    assert big["spark.sql.shuffle.partitions"] == str(4 * 100 * 1024)
    mid = sizing_conf(10 * 1024 ** 4)
    assert mid["spark.sql.shuffle.partitions"] == str(10 * 1024 ** 4 // (256 * 1024 ** 2))


def test_given_settings_stay(spark):
    from panelforge.session import SettingError, fill_settings
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    session.conf.unset("spark.sql.files.maxPartitionBytes")
    fill_settings(session, {"spark.sql.adaptive.enabled": "true", "spark.sql.files.maxPartitionBytes": "1048576"})
    assert session.conf.get("spark.sql.adaptive.enabled") == "false"
    assert session.conf.get("spark.sql.files.maxPartitionBytes") == "1048576"
    session.conf.set("spark.sql.session.timeZone", "America/New_York")
    with pytest.raises(SettingError, match="New_York"):
        fill_settings(session, {})


def test_only_one_jvm_counts_as_local():
    from panelforge.session import is_local_master
    assert is_local_master("local") and is_local_master("local[8]")
    assert not is_local_master("local-cluster[3,2,1024]")

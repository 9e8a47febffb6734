"""Wide -> long: renames, year labels, stray columns, missing values."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from panelforge.contracts import DATASETS
from panelforge.operators.reshape import (
    drop_missing,
    rename_geography,
    split_columns,
    unpivot_years,
    validate_year_columns,
)
from panelforge.plans.load import load_table
from tests.conftest import rows


def wide(spark, data, years=("2005", "_2006"), dims=("freq", "sex", "country"), dtype=DoubleType()):
    schema = StructType([StructField(d, StringType()) for d in dims]
                        + [StructField(y, dtype) for y in years])
    return spark.createDataFrame(data, schema)


def test_rename_geography(spark):
    schema = StructType([StructField("geo\\TIME_PERIOD", StringType()),
                         StructField("2005", DoubleType())])
    df = spark.createDataFrame([("A", 1.0)], schema)
    assert df.columns[0] == "geo\\TIME_PERIOD"
    assert rename_geography(df).columns == ["country", "2005"]


def test_rename_geography_absent_raises(spark):
    df = spark.createDataFrame([("A", 1.0)], "geo string, `2005` double")
    with pytest.raises(ValueError):
        rename_geography(df)


def test_year_prefix_parsed_to_bigint(spark):
    df = wide(spark, [("A", "M", "BE", 1.0, 2.0)])
    out = load_table(df, DATASETS["hours_worked"])
    assert dict((f.name, f.dataType) for f in out.schema.fields)["year"] == LongType()
    assert rows(out, "year", "hours_worked") == [(2005, 1.0), (2006, 2.0)]


def test_split_keeps_frame_order():
    ids, years = split_columns(["country", "2005", "freq", "_2006"], ["freq", "country"])
    assert ids == ["country", "freq"] and years == ["2005", "_2006"]


def test_stray_dimension_raises_eagerly(spark):
    df = spark.createDataFrame([("A", "M", "BE", "x", 1.0)],
                               "freq string, sex string, country string, foo string, `2005` double")
    with pytest.raises(ValueError, match="foo"):
        load_table(df, DATASETS["hours_worked"])  # raised while planning, before any action


def test_validate_rejects_no_year_columns():
    with pytest.raises(ValueError):
        validate_year_columns([])


def test_null_and_nan_cells_dropped(spark):
    df = wide(spark, [("A", "M", "BE", None, float("nan")), ("A", "F", "BE", 3.0, None)])
    out = load_table(df, DATASETS["hours_worked"])
    assert rows(out, "sex", "year", "hours_worked") == [("F", 2005, 3.0)]


def test_unpivot_keeps_nulls_until_dropped(spark):
    df = wide(spark, [("A", "M", "BE", None, 1.0)])
    long = unpivot_years(df, ["freq", "sex", "country"], "v")
    assert long.count() == 2
    assert drop_missing(long, "v").count() == 1


def test_mixed_int_and_double_years(spark):
    df = spark.createDataFrame([("A", "M", "BE", 1, 2.5)],
                               "freq string, sex string, country string, `2005` int, `2006` double")
    out = load_table(df, DATASETS["hours_worked"])
    assert dict((f.name, f.dataType) for f in out.schema.fields)["hours_worked"] == DoubleType()
    assert rows(out, "year", "hours_worked") == [(2005, 1.0), (2006, 2.5)]


def test_third_category_and_null_dimension_filtered(spark):
    df = wide(spark, [("A", "T", "BE", 1.0, 1.0), ("A", None, "BE", 1.0, 1.0),
                      ("A", "M", "BE", 1.0, None)])
    out = load_table(df, DATASETS["hours_worked"])
    assert rows(out, "sex", "year") == [("M", 2005)]


def test_years_argument_prunes_columns(spark):
    df = wide(spark, [("A", "M", "BE", 1.0, 2.0)])
    out = load_table(df, DATASETS["hours_worked"], years=[2006])
    assert rows(out, "year", "hours_worked") == [(2006, 2.0)]
    with pytest.raises(ValueError):
        load_table(df, DATASETS["hours_worked"], years=[1990])


def test_dimension_filter_is_pushed_below_unpivot(spark, tmp_path):
    path = str(tmp_path / "wide")
    wide(spark, [("A", "M", "BE", 1.0, 2.0), ("A", "T", "BE", 1.0, 2.0)]).write.parquet(path)
    out = load_table(spark.read.parquet(path), DATASETS["hours_worked"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(sex, [F,M])" in plan or "PushedFilters: [IsNotNull(sex), In(sex" in plan
    assert not math.isnan(out.agg(F.sum("hours_worked")).first()[0])

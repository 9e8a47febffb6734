"""The physical plans keep the properties the design relies on."""

from panelforge.contracts import DATASETS
from panelforge.plans.load import load_table
from panelforge.plans.staging import stage_table
from panelforge.sources import sinks
from panelforge.sources.extracts import read_cube, recipes
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_load_from_a_landed_extract_has_no_shuffle(spark, scratch):
    from panelforge.plans.analytics import Extracts
    wide = Extracts(spark, SF_SMALL).wide["employed"]
    path = sinks.land_wide(wide, f"{scratch}/raw")
    loaded = load_table(sinks.read_written(spark, path, wide.schema), DATASETS["employed"])
    text = plan(loaded)
    assert "Exchange" not in text and "Expand" in text
    assert "PushedFilters: [" in text and "EqualTo(age,Y15-74)" in text


def test_cube_prunes_columns_and_aggregates_before_the_shuffle(spark):
    wanted = recipes()
    text = read_cube(spark, SF_SMALL, wanted.values())._jdf.queryExecution().executedPlan().toString()
    assert ("ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,"
            "l_returnflag:string,l_linestatus:string>") in text
    first_exchange = text.index("Exchange hashpartitioning(l_orderkey")
    assert text.find("partial_sum(l_quantity", first_exchange) > first_exchange  # below it
    assert "Expand" not in text and "hashpartitioning(c_nationkey" not in text.split("o_custkey")[0]
    counts = plan(read_cube(spark, SF_SMALL, [wanted["divorce_rate"]]))
    assert "ReadSchema: struct<l_orderkey:bigint>" in counts
    hours = plan(read_cube(spark, SF_SMALL, [wanted["hours_worked"]]))
    assert "l_linenumber" not in hours and "Expand" not in hours


def test_staging_pivot_is_one_shuffle(spark):
    df = spark.createDataFrame([("BE", 2005, "M", 40.0)],
                               "country string, year bigint, sex string, hours_worked double")
    assert plan(stage_table(df, DATASETS["hours_worked"])).count("Exchange") == 1

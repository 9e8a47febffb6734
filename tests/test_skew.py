"""Hot keys: one order owns a third of all lines, one customer a third of all orders.

The skewed inputs are derived from the sf0.001 tables into a scratch folder;
the final tables must still match the DuckDB oracle on the same files, and the
join of the hot customer is split where no side is small enough to broadcast.
"""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from panelforge.sources.extracts import MEASURES, line_cells, measure_cube, order_cells, recipes
from tests.conftest import SF_MID, SF_SMALL
from tools.oracle_check import compare, duck


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("skewed"))
    lineitem = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    hot_order = orders.agg(F.min("o_orderkey")).first()[0]
    hot_customer = orders.agg(F.min("o_custkey")).first()[0]
    (lineitem.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(hot_order))
                         .otherwise(F.col("l_orderkey")))
     .write.parquet(f"{out}/lineitem.parquet"))
    (orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(hot_customer))
                       .otherwise(F.col("o_custkey")))
     .write.parquet(f"{out}/orders.parquet"))
    for t in ("customer", "nation"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")
    return out


@pytest.mark.parametrize("name", ["relationships", "gender_gap", "load_hours_worked",
                                  "stg_employed", "extract_marriage_rate"])
def test_hot_keys_keep_results_exact(spark, skewed_dir, name):
    _, status, n_spark, n_duck, _ = compare(spark, duck(skewed_dir), skewed_dir, name,
                                            entry_mod.queries()[name], entry_mod.oracle_sql()[name])
    assert status == "ok", (status, n_spark, n_duck)


def test_hot_order_collapses_before_the_join(spark, skewed_dir):
    """After the map-side pre-aggregation a hot order is at most one row per
    (flag, status), and one row where orders are counted, whatever its line count."""
    lines = spark.read.parquet(f"{skewed_dir}/lineitem.parquet")
    per_order = line_cells(lines, list(MEASURES)).groupBy("l_orderkey").count()
    assert order_cells(lines).groupBy("l_orderkey").count().filter("count > 1").isEmpty()
    hot = lines.groupBy("l_orderkey").count().orderBy(F.desc("count")).first()
    assert hot["count"] > lines.count() / 4
    assert per_order.filter(F.col("l_orderkey") == hot["l_orderkey"]).first()["count"] <= 6


def test_hot_customer_join_is_split(spark, tmp_path):
    """No side broadcasts; partitions of this small input count as skewed from 32 KB on."""
    orders = spark.read.parquet(f"{SF_MID}/orders.parquet")
    hot = orders.agg(F.min("o_custkey")).first()[0]
    (orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(hot)).otherwise(F.col("o_custkey")))
     .repartition(8).write.parquet(f"{tmp_path}/orders.parquet"))
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16384",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32768",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {key: spark.conf.get(key, None) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        lineitem, customer, nation = (spark.read.parquet(f"{SF_MID}/{t}.parquet")
                                      for t in ("lineitem", "customer", "nation"))
        cube = measure_cube(lineitem, spark.read.parquet(f"{tmp_path}/orders.parquet"), customer, nation,
                            [recipes()["accidents"]])
        cube.collect()
        plan = cube._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    final = plan.split("Initial Plan")[0]
    assert [line for line in final.splitlines() if "skew=true" in line and "o_custkey" in line]
    assert "BroadcastHashJoin" not in final

"""Property tests: reshape round trips and upsert idempotence on random panels."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelforge.contracts import DATASETS, STAGING_SCHEMAS
from panelforge.operators.pivot import pivot_values
from panelforge.plans.load import load_table
from panelforge.sources import sinks
from tests.conftest import rows

YEARS = ["2005", "_2006", "2007"]
cells = st.one_of(st.none(), st.integers(min_value=0, max_value=50).map(float))
panel = st.dictionaries(st.tuples(st.sampled_from(["BE", "NL", "DE"]), st.sampled_from(["M", "F"])),
                        st.tuples(cells, cells, cells), min_size=1, max_size=6)
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(data=panel)
def test_unpivot_drop_pivot_back_is_identity(spark, data):
    wide = spark.createDataFrame(
        [("A", sex, country, *vals) for (country, sex), vals in data.items()],
        "freq string, sex string, country string, `2005` double, `_2006` double, `2007` double")
    long = load_table(wide, DATASETS["hours_worked"])
    back = pivot_values(long, ["country", "sex"], "year", [2005, 2006, 2007], "hours_worked", "max",
                        prefix="y")
    expected = {(c, s): v for (c, s), v in data.items() if any(x is not None for x in v)}
    got = {(r.country, r.sex): (r.y_2005, r.y_2006, r.y_2007) for r in back.collect()}
    assert got == expected


@SETTINGS
@given(old=panel, new=panel)
def test_upsert_twice_equals_once(spark, tmp_path_factory, old, new):
    scratch = str(tmp_path_factory.mktemp("ups"))
    schema = STAGING_SCHEMAS["marriage_rate"]

    def frame(d):
        keyed = {(c, 2001 if s == "M" else 2002): v[0] or 0.0 for (c, s), v in d.items()}
        return spark.createDataFrame([(c, y, v) for (c, y), v in keyed.items()], schema)

    target = sinks.replace_sink(frame(old), f"{scratch}/t0", schema)
    src = frame(new)
    once = sinks.upsert_sink(spark, src, target, f"{scratch}/t1", schema=schema)
    twice = sinks.upsert_sink(spark, src, once, f"{scratch}/t2", schema=schema)
    a, b = spark.read.parquet(once), spark.read.parquet(twice)
    assert rows(a) == rows(b)
    keys = {(r.country, r.year) for r in frame(old).unionByName(src).select("country", "year").collect()}
    assert {(r.country, r.year) for r in a.collect()} == keys
    assert a.groupBy("country", "year").count().filter(F.col("count") > 1).count() == 0

"""Registered queries against DuckDB, fixture row counts, and full refresh runs."""

import pytest

import __spark_entry__ as entry_mod
from panelforge.contracts import ANALYTICS_SCHEMAS, STAGING_SCHEMAS
from panelforge.plans.analytics import Extracts
from panelforge.plans.refresh import init_targets, refresh
from panelforge.plans.registry import QUERIES
from panelforge.sources import sinks
from tests.conftest import SF_MID, SF_SMALL, rows
from tools.oracle_check import compare, duck

# FIXTURES.md part B, rows wide / long / staged at sf0.001.
EXPECTED_SF0001 = {
    "marriage_rate": (25, 174, 174),
    "divorce_rate": (25, 158, 158),
    "age_at_marriage": (75, 522, 174),
    "gender_pay_gap": (93, 111, 111),
    "hours_worked": (3186, 2726, 174),
    "accidents": (556, 346, 108),
    "employed": (2016, 94, 43),
}


@pytest.fixture(scope="module")
def extracts(spark):
    return Extracts(spark, SF_SMALL)


@pytest.mark.parametrize("name", sorted(EXPECTED_SF0001))
def test_fixture_row_counts(extracts, name):
    got = (extracts.wide[name].count(), extracts.load(name).count(), extracts.stage(name).count())
    assert got == EXPECTED_SF0001[name]


def test_final_tables_and_null_counts(extracts):
    rel = extracts.final("relationships")
    gg = extracts.final("gender_gap")
    assert rel.count() == 174 and gg.count() == 174
    assert rel.filter("divorce_rate IS NULL").count() == 16
    assert gg.filter("employed_m IS NULL").count() == 141
    assert [f.name for f in gg.schema.fields] == ANALYTICS_SCHEMAS["gender_gap"].names


def test_years_observed_from_the_cube(extracts):
    assert extracts.years == list(range(1995, 2002))


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ANALYTICS_SCHEMAS["gender_gap"].names
    assert df.count() == 174


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    oracle = entry_mod.oracle_sql()
    assert name in oracle, f"{name} has no oracle SQL"
    _, status, n_spark, n_duck, _ = compare(spark, con, SF_SMALL, name, entry_mod.queries()[name],
                                            oracle[name])
    assert status == "ok", (status, n_spark, n_duck)


def test_refresh_local_matches_queries(spark, scratch):
    res = refresh(spark, SF_SMALL, scratch, variant="local")
    rel = spark.read.parquet(res.paths["analytics.relationships"])
    expected = entry_mod.queries()["relationships_local"](spark, SF_SMALL)
    assert rows(rel) == rows(expected)
    # left joins leave nulls in the final tables: recorded as warnings, not raised
    assert "analytics.relationships" in res.warnings


def test_refresh_cloud_is_idempotent(spark, scratch):
    with pytest.raises(sinks.MissingTargetError):
        refresh(spark, SF_SMALL, scratch, variant="cloud")
    first = refresh(spark, SF_SMALL, scratch, variant="cloud", previous=init_targets(spark, scratch))
    stored = {name: rows(t, *sorted(t.columns)) for name in ("staging.hours_worked", "analytics.gender_gap")
              for t in [spark.read.parquet(first.paths[name])]}
    second = refresh(spark, SF_SMALL, scratch, variant="cloud", previous=first.paths)
    for name, before in stored.items():
        t = spark.read.parquet(second.paths[name])
        assert rows(t, *sorted(t.columns)) == before
    # the partitioned final tables are merged where they are
    assert second.paths["analytics.gender_gap"] == first.paths["analytics.gender_gap"]
    gg = sinks.read_partitioned(spark, second.paths["analytics.gender_gap"],
                                ANALYTICS_SCHEMAS["gender_gap"])
    assert gg.count() == 174
    assert spark.read.parquet(second.paths["staging.employed"]).columns == \
        STAGING_SCHEMAS["employed"].names


def landed(spark, extracts):
    """The seven extracts as in-memory frames: nothing of the TPC-H tables is read."""
    return {n: spark.createDataFrame(extracts.wide[n].collect(), extracts.wide[n].schema)
            for n in extracts.wide}


def test_refresh_from_extracts_alone(spark, scratch, extracts):
    wide = landed(spark, extracts)
    res = refresh(spark, wide, scratch, variant="local")
    rel = spark.read.parquet(res.paths["analytics.relationships"])
    assert rows(rel) == rows(extracts.final("relationships", with_year_date=False))


def test_negative_values_halt_before_the_sink(spark, scratch, extracts):
    from panelforge.operators import checks
    wide = landed(spark, extracts)
    wide["employed"] = wide["employed"].withColumn("_1997", -wide["employed"]["_1997"])
    with pytest.raises(checks.QualityCheckError, match="employed_m"):
        refresh(spark, wide, scratch, variant="local")


def test_a_measured_zero_survives_the_load(spark):
    from panelforge.contracts import DATASETS
    from panelforge.plans.load import load_table
    wide = spark.createDataFrame([("A", "RATE", "BE", 0.0, None)],
                                 "freq string, indic_de string, country string, _1995 double, `1996` double")
    assert rows(load_table(wide, DATASETS["marriage_rate"])) == [("BE", 1995, 0.0)]


def test_fanout_doubles_every_key(spark):
    """FIXTURES.md: at sf0.01 every pay-gap key appears twice and gender_gap has 350 rows."""
    ex = Extracts(spark, SF_MID, pay_gap_fanout=True)
    staged = ex.stage("gender_pay_gap")
    assert staged.groupBy("country", "year").count().filter("count != 2").count() == 0
    assert ex.final("gender_gap").count() == 350


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_MID])
def test_final_tables_keep_the_anchor_row_count(spark, sf_dir):
    """With unique right keys, a left-deep join keeps exactly the anchor's rows."""
    from panelforge.contracts import ANALYTICS
    ex = Extracts(spark, sf_dir)
    for name, spec in ANALYTICS.items():
        for right in spec.joined:
            dup = ex.stage(right).groupBy("country", "year").count().filter("count > 1")
            assert dup.count() == 0
        assert ex.final(name).count() == ex.stage(spec.anchor).count()


def test_partitioned_write_read_is_identity(spark, scratch):
    ex = Extracts(spark, SF_SMALL)
    rel = ex.final("relationships")
    path = sinks.partitioned_sink(rel, f"{scratch}/rel")
    back = sinks.read_partitioned(spark, path, ANALYTICS_SCHEMAS["relationships"])
    assert back.columns == rel.columns
    assert rows(back) == rows(rel)

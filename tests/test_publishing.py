"""What readers and the next run find when a run fails, dies midway or ends well."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelforge.contracts import ANALYTICS_SCHEMAS, DATASETS, STAGING_SCHEMAS
from panelforge.operators import checks
from panelforge.operators.filters import EmptyInputError
from panelforge.plans.analytics import Extracts
from panelforge.plans.refresh import TARGET_SCHEMAS, current_tables, init_targets, refresh, remove_old_runs
from panelforge.sources import sinks, versions
from panelforge.sources.files import FileMoveError, Folder, footer_types
from tests.conftest import SF_SMALL, rows
from tests.test_sinks import REL, rel

RATE = STAGING_SCHEMAS["marriage_rate"]


class Died(BaseException):
    """The driver's process ends here."""


def rates(spark, *data):
    return spark.createDataFrame(list(data), RATE)


def failing(df):
    return df.withColumn("marriage_rate", F.when(F.col("marriage_rate") > 1, F.raise_error(F.lit("bad cell")).cast("double"))
                         .otherwise(F.col("marriage_rate")))


# ---- full replace

def test_a_failing_write_leaves_the_old_rows(spark, scratch):
    path = sinks.replace_sink(rates(spark, ("BE", 2005, 1.0)), f"{scratch}/t", RATE)
    with pytest.raises(Exception, match="bad cell"):
        sinks.replace_sink(failing(rates(spark, ("NL", 2005, 1.0), ("DE", 2005, 2.0)).repartition(2)), path, RATE)
    assert rows(spark.read.parquet(path)) == [("BE", 2005, 1.0)]
    assert os.listdir(scratch) == ["t"]


@pytest.mark.parametrize("step", [1, 2])
def test_a_driver_that_dies_between_the_renames(spark, scratch, monkeypatch, step):
    path = sinks.replace_sink(rates(spark, ("BE", 2005, 1.0)), f"{scratch}/t", RATE)
    real, calls = Folder.move_to, []

    def dying(self, other):
        calls.append(other.path)
        if len(calls) == step:
            raise Died
        real(self, other)

    monkeypatch.setattr(Folder, "move_to", dying)
    with pytest.raises(Died):
        sinks.replace_sink(rates(spark, ("NL", 2005, 2.0)), path, RATE)
    monkeypatch.undo()
    assert rows(sinks.read_target(spark, path, RATE)) == [("BE", 2005, 1.0)]
    sinks.replace_sink(rates(spark, ("NL", 2005, 2.0)), path, RATE)
    assert rows(sinks.read_written(spark, path, RATE)) == [("NL", 2005, 2.0)]
    assert not Folder(spark, path).beside("old").exists()


def test_a_table_may_be_replaced_by_rows_read_from_it(spark, scratch):
    path = sinks.replace_sink(rates(spark, ("BE", 2005, 1.0), ("NL", 2005, 2.0)), f"{scratch}/t", RATE)
    sinks.replace_sink(sinks.read_written(spark, path, RATE).filter("marriage_rate > 1"), path, RATE)
    assert rows(sinks.read_written(spark, path, RATE)) == [("NL", 2005, 2.0)]


def test_an_empty_extract_is_not_published(spark, scratch):
    wide = spark.createDataFrame([("A", "RATE", "BE", 1.0)], "freq string, indic_de string, country string, `2005` double")
    path = sinks.land_wide(wide, f"{scratch}/raw")
    with pytest.raises(EmptyInputError):
        sinks.land_wide(wide.limit(0), path)
    assert spark.read.parquet(path).count() == 1


# ---- pointers

def test_pointers_keep_the_last_published_version(spark, scratch):
    versions.publish(spark, scratch, {"staging.a": f"{scratch}/run-1/a", "staging.b": "/elsewhere/b"})
    versions.publish(spark, scratch, {"staging.a": f"{scratch}/run-2/a"})
    assert versions.current(spark, f"{scratch}/", ["staging.a", "staging.b", "staging.c"]) == {
        "staging.a": f"{scratch}/run-2/a", "staging.b": "/elsewhere/b"}
    with open(f"{scratch}/current/staging.a") as f:
        assert f.read() == "run-2/a"  # the warehouse may be moved
    assert versions.current(spark, f"{scratch}/none", ["staging.a"]) == {}


def test_a_second_refresh_finds_its_targets_by_folder_alone(spark, scratch):
    init_targets(spark, scratch)
    first = refresh(spark, SF_SMALL, scratch)
    assert current_tables(spark, scratch) == {t: first.paths[t] for t in TARGET_SCHEMAS}
    other = spark.newSession()
    second = refresh(other, SF_SMALL, scratch)
    assert current_tables(other, scratch)["staging.employed"] == second.paths["staging.employed"] != \
        first.paths["staging.employed"]
    gap = sinks.read_partitioned(other, current_tables(other, scratch)["analytics.gender_gap"], ANALYTICS_SCHEMAS["gender_gap"])
    assert gap.count() == 174


def test_a_run_that_dies_before_the_rename_leaves_the_old_version_current(spark, scratch, monkeypatch):
    init_targets(spark, scratch)
    refresh(spark, SF_SMALL, scratch)
    before = current_tables(spark, scratch)
    stored = rows(spark.read.parquet(before["staging.employed"]))
    real = versions.publish

    def dying(spark, root, paths):
        if any(t.startswith("staging.") for t in paths):
            raise Died
        real(spark, root, paths)

    monkeypatch.setattr(versions, "publish", dying)
    with pytest.raises(Died):
        refresh(spark, SF_SMALL, scratch)
    assert current_tables(spark, scratch) == before
    assert rows(spark.read.parquet(before["staging.employed"])) == stored


def test_a_pointer_is_replaced_by_one_rename(spark, scratch, monkeypatch):
    pointer = Folder(spark, f"{scratch}/p")
    pointer.write_text("one")
    monkeypatch.setattr(Folder, "new_beside", lambda self: self.beside("new"))
    os.mkdir(f"{scratch}/p.new")  # the text cannot be written beside the pointer
    with pytest.raises(Exception):
        pointer.write_text("two")
    assert pointer.read_text() == "one"


def test_old_runs_are_removed_and_the_cube_goes_with_the_run(spark, scratch):
    from panelforge.session import checkpoint_root
    cubes = {n for n in os.listdir(checkpoint_root(spark).removeprefix("file:")) if n.startswith("cube-")}
    init_targets(spark, scratch)
    runs = [refresh(spark, SF_SMALL, scratch) for _ in range(3)]
    assert cubes == {n for n in os.listdir(checkpoint_root(spark).removeprefix("file:")) if n.startswith("cube-")}
    # the first run's folder holds the partitioned final tables, the last one's all others
    assert remove_old_runs(spark, scratch) == [os.path.basename(runs[1].run_dir)]
    assert remove_old_runs(spark, scratch) == []
    for path in current_tables(spark, scratch).values():
        assert spark.read.parquet(path).count() > 0


def test_scratch_scopes_remove_their_folders_only(spark):
    from panelforge.session import scratch_dir, scratch_scope
    outer = scratch_dir(spark, "outer")
    with scratch_scope(spark):
        first = scratch_dir(spark, "first")
        with pytest.raises(ZeroDivisionError), scratch_scope(spark):
            second = scratch_dir(spark, "second")
            raise ZeroDivisionError
        assert Folder(spark, first).exists() and not Folder(spark, second).exists()
    assert Folder(spark, outer).exists() and not Folder(spark, first).exists()


# ---- partitions

@pytest.fixture
def half_committed(spark, scratch, monkeypatch):
    """A partitioned table whose upsert died after the first of three folders."""
    table = sinks.partitioned_sink(rel(spark, [("BE", 2005, 1.0), ("BE", 2006, 2.0), ("NL", 2007, 3.0), ("DE", None, 4.0)]),
                                   f"{scratch}/t")
    source = rel(spark, [("BE", 2005, 5.0), ("BE", 2006, 6.0), ("FR", 2008, 7.0)])
    real, moved = Folder.move_to, []

    def dying(self, other):
        if "/year_date=" in other.path:
            moved.append(other.path)
            if len(moved) == 2:
                raise Died
        real(self, other)

    monkeypatch.setattr(Folder, "move_to", dying)
    with pytest.raises(Died):
        sinks.upsert_partitions(spark, source, table, f"{scratch}/staged", REL)
    monkeypatch.undo()
    return table


MERGED = [("BE", 2005, 5.0), ("BE", 2006, 6.0), ("DE", None, 4.0), ("FR", 2008, 7.0), ("NL", 2007, 3.0)]


def content(spark, table):
    return rows(sinks.read_partitioned(spark, table, REL), "country", "year", "marriage_rate")


def test_a_commit_that_ended_midway_is_finished(spark, half_committed, scratch):
    assert sinks.finish_commit(spark, half_committed) is True
    assert content(spark, half_committed) == rows(rel(spark, MERGED), "country", "year", "marriage_rate")
    assert not os.path.exists(f"{scratch}/staged")
    assert sinks.finish_commit(spark, half_committed) is False


def test_the_next_run_finishes_what_the_last_one_left(spark, half_committed, scratch):
    sinks.upsert_partitions(spark, rel(spark, [("BE", 2006, 9.0), ("FR", 2008, 8.0)]), half_committed, f"{scratch}/next", REL)
    want = [("BE", 2006, 9.0) if r[:2] == ("BE", 2006) else ("FR", 2008, 8.0) if r[0] == "FR" else r for r in MERGED]
    assert content(spark, half_committed) == rows(rel(spark, want), "country", "year", "marriage_rate")


def test_without_a_record_staged_folders_are_scratch(spark, scratch, monkeypatch):
    table = sinks.partitioned_sink(rel(spark, [("BE", 2005, 1.0)]), f"{scratch}/t")

    def dying(*_):
        raise Died

    monkeypatch.setattr(sinks, "commit_partitions", dying)
    with pytest.raises(Died):
        sinks.upsert_partitions(spark, rel(spark, [("BE", 2005, 5.0)]), table, f"{scratch}/staged", REL)
    assert content(spark, table) == [("BE", 2005, 1.0)]


def test_folders_in_the_way_are_not_overwritten(spark, scratch):
    os.makedirs(f"{scratch}/a"), os.makedirs(f"{scratch}/b")
    with pytest.raises(FileMoveError):
        Folder(spark, f"{scratch}/a").move_to(Folder(spark, f"{scratch}/b"))


# ---- checks while writing

SPEC = {"not_null": ("country", "marriage_rate"), "unique": ("country", "year"), "non_negative": ("marriage_rate",)}
BAD = [("BE", 2005, 1.0), ("BE", 2005, 2.0), ("BE", 2005, 3.0), (None, 2005, -1.0), (None, 2005, None), ("NL", 2006, 4.0)]


def counted_evaluations(df, folder):
    """``df`` that leaves a file for every task that computes it."""
    os.makedirs(folder, exist_ok=True)

    def touch(batches):
        import tempfile
        tempfile.mkstemp(dir=folder)
        yield from batches

    return df.coalesce(1).mapInArrow(touch, df.schema)


def test_watched_writes_report_as_run_checks_in_one_evaluation(spark, scratch):
    df = rates(spark, *BAD)
    seen = []
    report = sinks.write_watched(counted_evaluations(df, f"{scratch}/seen"), f"{scratch}/t", RATE, seen.extend, SPEC)
    want = sorted(map(tuple, checks.run_checks(df, **SPEC).collect()))
    assert sorted(report) == sorted(seen) == want
    assert len(os.listdir(f"{scratch}/seen")) == 1
    assert rows(spark.read.parquet(f"{scratch}/t")) == rows(df)


def test_a_failed_check_publishes_nothing(spark, scratch):
    path = sinks.replace_sink(rates(spark, ("BE", 2005, 1.0)), f"{scratch}/t", RATE)
    with pytest.raises(checks.QualityCheckError, match="marriage_rate"):
        sinks.write_watched(rates(spark, *BAD), path, RATE, lambda r: checks.judge(r, "rates"), SPEC)
    assert rows(spark.read.parquet(path)) == [("BE", 2005, 1.0)] and os.listdir(scratch) == ["t"]


def test_a_merge_checks_its_source_in_one_evaluation(spark, scratch):
    target = sinks.replace_sink(rel(spark, [("BE", 2005, -1.0), ("NL", 2005, 2.0), (None, 2005, 3.0)]), f"{scratch}/t0", REL)
    source = rel(spark, [("BE", 2005, 9.0), ("DE", 2005, -3.0), (None, 2005, 4.0)])
    seen = []
    out = sinks.upsert_sink(spark, counted_evaluations(source, f"{scratch}/seen"), target, f"{scratch}/t1", schema=REL,
                            check=seen.extend, checks={"not_null": ("country",), "unique": ("country", "year_date"),
                                                       "non_negative": ("marriage_rate",)})
    assert seen == [("not_null", "country", 1), ("non_negative", "marriage_rate", 1), ("unique", "country,year_date", 0)]
    assert len(os.listdir(f"{scratch}/seen")) == 1
    assert rows(sinks.read_written(spark, out, REL), "country", "marriage_rate") == rows(
        rel(spark, [("BE", 2005, 9.0), ("DE", 2005, -3.0), ("NL", 2005, 2.0), (None, 2005, 3.0), (None, 2005, 4.0)]),
        "country", "marriage_rate")


def test_a_repeated_source_key_removes_the_output(spark, scratch):
    target = sinks.replace_sink(rel(spark, [("BE", 2005, 1.0)]), f"{scratch}/t0", REL)
    with pytest.raises(sinks.DuplicateKeyError):
        sinks.upsert_sink(spark, rel(spark, [("BE", 2005, 1.0)] * 2), target, f"{scratch}/t1", schema=REL)
    assert sorted(os.listdir(scratch)) == ["t0"]


def test_refresh_evaluates_every_staged_table_once(spark, scratch, monkeypatch):
    from panelforge.plans import refresh as module
    real = module.stage_table
    monkeypatch.setattr(module, "stage_table", lambda loaded, spec: counted_evaluations(
        real(loaded, spec), f"{scratch}/seen/{spec.name}"))
    init_targets(spark, f"{scratch}/out")
    refresh(spark, SF_SMALL, f"{scratch}/out")
    assert {n: len(os.listdir(f"{scratch}/seen/{n}")) for n in DATASETS} == dict.fromkeys(DATASETS, 1)


# ---- checks in the plan

def test_a_guarded_write_ends_with_its_job(spark, scratch):
    path = sinks.replace_sink(rates(spark, ("BE", 2005, 1.0)), f"{scratch}/t", RATE)
    for bad, match in ((("NL", 2005, -2.0), "rates: non_negative marriage_rate"),
                       ((None, 2005, 2.0), "rates: not_null country")):
        guarded = checks.guarded(rates(spark, ("DE", 2005, 1.0), bad), "rates", **SPEC)
        with pytest.raises(checks.QualityCheckError, match=match), checks.guard_errors():
            sinks.replace_sink(guarded, path, RATE)
        assert rows(spark.read.parquet(path)) == [("BE", 2005, 1.0)]
    fine = rates(spark, ("DE", 2005, 0.0))
    assert rows(checks.guarded(fine, "rates", **SPEC)) == rows(fine)


def test_other_errors_pass_the_guard(spark):
    with pytest.raises(ZeroDivisionError), checks.guard_errors():
        raise ZeroDivisionError


def test_a_halting_refresh_publishes_nothing_of_the_layer(spark, scratch):
    ex = Extracts(spark, SF_SMALL)
    wide = {n: spark.createDataFrame(ex.wide[n].collect(), ex.wide[n].schema) for n in ex.wide}
    wide["employed"] = wide["employed"].withColumn("_1997", -wide["employed"]["_1997"])
    before = init_targets(spark, scratch)
    with pytest.raises(checks.QualityCheckError, match="staging.employed: non_negative employed_[mf]"):
        refresh(spark, wide, scratch, staging_checks="halt")
    assert current_tables(spark, scratch) == before
    with pytest.raises(ValueError, match="unknown check mode"):
        refresh(spark, wide, scratch, staging_checks="stop")


def test_required_matches(spark, scratch):
    ex = Extracts(spark, SF_SMALL)
    wide = {n: spark.createDataFrame(ex.wide[n].collect(), ex.wide[n].schema) for n in ex.wide}
    wide["employed"] = wide["employed"].withColumn("age", F.lit("Y0-14"))
    with pytest.raises(EmptyInputError, match="employed after filters"):
        refresh(spark, wide, scratch, variant="local", require_matches=True)


# ---- catalog tables and views

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_staging_tables_join_without_a_shuffle(spark, scratch):
    from panelforge.plans.analytics import final_table, needed_datasets
    ex = Extracts(spark, SF_SMALL)
    needed = needed_datasets(["relationships"])
    given = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with sinks.catalog_names(spark, len(needed)) as names:
            for table, n in zip(names, needed):
                sinks.save_bucketed(ex.stage(n), table, f"{scratch}/{n}", STAGING_SCHEMAS[n])
            final = final_table("relationships", {n: spark.table(t) for t, n in zip(names, needed)})
            text = plan(final)
            assert text.count("SortMergeJoin") == 3 and "Exchange" not in text
            assert rows(final) == rows(ex.final("relationships"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", given)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("panel_")]


def test_clustered_catalog_table_prunes_dates_and_countries(spark, scratch):
    df = rel(spark, [(c, y, 1.0) for c in ("BE", "NL", "DE", "FR") for y in (2005, 2006, 2007)])
    with sinks.catalog_names(spark) as (name,):
        sinks.save_bucketed(df, name, f"{scratch}/t", REL, keys=("country",), buckets=4, partition_by=("year_date",))
        q = spark.table(name).filter("year_date = DATE '2006-12-31' AND country = 'NL'")
        text = plan(q)
        assert "PartitionFilters: [isnotnull(year_date" in text and "EqualTo(country,NL)]" in text
        extended = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        assert extended["Num Buckets"] == "4" and extended["Bucket Columns"] == "[`country`]"
        assert q.count() == 1
        assert rows(spark.table(name).select(*REL.names)) == rows(df)


def test_a_catalog_table_keeps_its_entry_when_replaced(spark, scratch):
    with sinks.catalog_names(spark) as (name,):
        sinks.save_table(rates(spark, ("BE", 2005, 1.0)), name, f"{scratch}/t", RATE)
        with pytest.raises(Exception, match="bad cell"):
            sinks.save_table(failing(rates(spark, ("NL", 2005, 2.0))), name, f"{scratch}/t", RATE)
        assert rows(spark.table(name)) == [("BE", 2005, 1.0)]
        sinks.save_table(rates(spark, ("NL", 2005, 1.0)), name, f"{scratch}/t", RATE)
        assert rows(spark.table(name)) == [("NL", 2005, 1.0)]


def test_views_go_when_they_were_used(spark):
    with sinks.named_views(spark, {"stg_rates": rates(spark, ("BE", 2005, 1.0))}):
        found = spark.sql("SELECT country FROM stg_rates")
        with pytest.raises(ValueError, match="already has views"), sinks.named_views(spark, {"stg_rates": found}):
            pass
    assert rows(found) == [("BE",)]
    assert not spark.catalog.tableExists("stg_rates")


# ---- declared inputs

def test_declared_sources_are_read_without_a_schema_job(spark):
    from panelforge.contracts import SOURCE_SCHEMAS
    from panelforge.sources.tables import read_source
    sc = spark.sparkContext
    sc.setJobGroup("declared", "declared sources")
    try:
        frames = [read_source(spark, SF_SMALL, n) for n in SOURCE_SCHEMAS]
        assert not sc.statusTracker().getJobIdsForGroup("declared")
        spark.read.parquet(f"{SF_SMALL}/nation.parquet")
        assert len(sc.statusTracker().getJobIdsForGroup("declared")) == 1  # what inferring takes
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    for n, df in zip(SOURCE_SCHEMAS, frames):
        inferred = spark.read.parquet(f"{SF_SMALL}/{n}.parquet").select(*SOURCE_SCHEMAS[n].names)
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in inferred.schema]
        assert rows(df.limit(20)) == rows(inferred.limit(20))


@pytest.mark.parametrize("change, match", [
    (lambda t: t.drop(["n_name"]), "n_name is missing"),
    (lambda t: t.set_column(0, "n_nationkey", t["n_nationkey"].cast(pa.int64())), "n_nationkey is stored as INT64, not int"),
    (lambda t: t.set_column(1, "n_name", pa.array([[1]] * len(t))), "n_name is stored as GROUP"),
])
def test_a_wrong_source_column_raises(spark, scratch, change, match):
    import pyarrow.parquet as pq
    from panelforge.sources.tables import SourceSchemaError, read_source
    pq.write_table(change(pq.read_table(f"{SF_SMALL}/nation.parquet")), f"{scratch}/nation.parquet")
    with pytest.raises(SourceSchemaError, match=match):
        read_source(spark, scratch, "nation")


def test_landed_extracts_are_read_by_their_footers(spark, scratch):
    from panelforge.sources.tables import SourceSchemaError, read_extract
    wide = Extracts(spark, SF_SMALL, datasets=["employed"]).wide["employed"]
    sinks.land_wide(wide, f"{scratch}/employed.parquet")
    assert rows(read_extract(spark, scratch, "employed")) == rows(wide)
    wide.drop("age").write.parquet(f"{scratch}/bad/employed.parquet")
    with pytest.raises(SourceSchemaError, match="age is missing"):
        read_extract(spark, f"{scratch}/bad", "employed")
    wide.withColumn("2001", F.lit("x")).withColumnRenamed("2001", "2002").write.parquet(f"{scratch}/worse/employed.parquet")
    with pytest.raises(SourceSchemaError, match="2002 is stored as"):
        read_extract(spark, f"{scratch}/worse", "employed")


def test_footers_of_partitioned_and_empty_tables(spark, scratch):
    table = sinks.partitioned_sink(rel(spark, [("BE", 2005, 1.0)]), f"{scratch}/t")
    types, partitions = footer_types(spark, table)
    assert partitions == ["year_date"] and types["country"] == ("BINARY", "STRING")
    os.mkdir(f"{scratch}/none")
    assert footer_types(spark, f"{scratch}/none") is None

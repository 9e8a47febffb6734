"""One end-to-end run: land -> load -> stage -> check -> final tables.

Each layer is written and read back, so a later layer never recomputes an
earlier one (and a lost executor costs at most the current layer).  The
expensive part, the measure cube, runs once per refresh.

Two variants share the code path:

* ``local``: every layer is fully replaced; the final tables have no
  ``year_date`` and are stored sorted by (country, year).
* ``cloud``: staging and final tables are upserted on (country, year) into
  the previous run's tables; the final tables are partitioned by
  ``year_date`` and clustered by ``country``.

Every run writes its own folder (``<out>/run-<id>/<layer>/<table>``) and, when
a layer is complete and its checks have passed, points ``<out>/current`` at it,
which is where the next run, in whatever process, finds its targets.  Only the
final tables, once partitioned, stay where they are: a run merges the
partitions it touches in its own folder and then moves just those into place,
by a commit that the next run finishes if this one dies.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelforge.contracts import ANALYTICS, ANALYTICS_SCHEMAS, DATASETS, KEYS, STAGING_SCHEMAS, load_schema
from panelforge.operators.checks import (ANALYTICS_CHECKS, LOAD_CHECKS, STAGING_CHECKS, guard_errors, guarded,
                                         judge)
from panelforge.operators.filters import EmptyInputError
from panelforge.operators.reshape import rename_geography
from panelforge.plans.analytics import Extracts, final_table, needed_datasets
from panelforge.plans.load import load_table
from panelforge.plans.staging import stage_table
from panelforge.session import scratch_scope
from panelforge.sources import sinks, versions
from panelforge.sources.files import Folder
from panelforge.sources.tables import read_extract


@dataclass
class RefreshResult:
    run_dir: str
    paths: dict[str, str] = field(default_factory=dict)
    warnings: dict[str, list] = field(default_factory=dict)


def _each(names, work, parallel_jobs: int) -> dict:
    """Run ``work(name)`` for independent tables, up to ``parallel_jobs`` Spark
    jobs at a time (jobs submitted from several threads share the executors);
    the first failure is raised."""
    names = list(names)
    if parallel_jobs <= 1:
        return {n: work(n) for n in names}
    with ThreadPoolExecutor(max_workers=parallel_jobs) as pool:
        return dict(zip(names, pool.map(work, names)))


def landed_extracts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The seven wide extracts of a folder that holds ``<dataset>.parquet`` for each."""
    return {n: read_extract(spark, folder, n) for n in DATASETS}


TARGET_SCHEMAS = {**{f"staging.{n}": STAGING_SCHEMAS[n] for n in DATASETS},
                  **{f"analytics.{n}": ANALYTICS_SCHEMAS[n] for n in ANALYTICS}}


def init_targets(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Empty staging and final tables, which a first cloud run merges into."""
    paths = sinks.init_tables(spark, out_dir, TARGET_SCHEMAS)
    versions.publish(spark, out_dir, paths)
    return paths


def remove_old_runs(spark: SparkSession, out_dir: str) -> list[str]:
    """Delete the run folders of a warehouse that no current version lies in; returns their names.

    Not for a time at which a run is under way: its folder is not current yet.
    """
    base = Folder(spark, out_dir)
    used = versions.all_current(spark, out_dir).values()
    old = [name for name in base.folders() if name.startswith("run-")
           and not any(path.startswith(f"{base.path}/{name}/") for path in used)]
    for name in old:
        base.child(name).delete()
    return old


def current_tables(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Where the current version of every staging and final table of a warehouse folder lies."""
    return versions.current(spark, out_dir, TARGET_SCHEMAS)


def refresh(spark: SparkSession, source: str | Mapping[str, DataFrame], out_dir: str,
            variant: str = "cloud",
            previous: Mapping[str, str] | None = None, staging_checks: str = "fail",
            analytics_checks: str = "warn", require_matches: bool = False,
            parallel_jobs: int = 4) -> RefreshResult:
    """Run every layer once and return where each table was written.

    ``source`` gives the wide extracts by dataset name (``landed_extracts`` for
    files), or names a folder of the TPC-H style tables to derive them from.
    A cloud run merges into the current versions that ``out_dir`` points at, or
    into ``previous`` where it names a table; all nine targets must exist
    (``init_targets`` makes empty ones for the first run).

    Every table is evaluated once: its checks are counted while it is written,
    and it is published only after they were judged.  ``staging_checks`` /
    ``analytics_checks`` are ``fail`` (raise, so nothing of the layer or after
    it is published), ``halt`` (the same, but the job itself ends at the first
    null or negative value) or ``warn`` (record and go on): the final tables
    are left joins, so their not-null checks can fail on honest data.
    ``require_matches`` raises when a load's dimension filters keep no row,
    instead of writing an empty table.  The writes of one layer are
    independent and run ``parallel_jobs`` at a time.
    """
    if variant not in ("cloud", "local"):
        raise ValueError(f"unknown variant {variant!r}")
    for mode in (staging_checks, analytics_checks):
        if mode not in ("fail", "halt", "warn"):
            raise ValueError(f"unknown check mode {mode!r}")
    targets: dict[str, str] = {}
    if variant == "cloud":
        targets = {**versions.current(spark, out_dir, TARGET_SCHEMAS), **(previous or {})}
        missing = sorted(set(TARGET_SCHEMAS) - set(targets))
        if missing:
            raise sinks.MissingTargetError(f"no target for {missing}: create them with init_targets")
    if isinstance(source, str):
        with scratch_scope(spark):  # the cube goes when the run has stored its tables
            return refresh(spark, Extracts(spark, source).wide, out_dir, variant, previous, staging_checks, analytics_checks,
                           require_matches, parallel_jobs)
    run_dir = f"{out_dir.rstrip('/')}/run-{uuid.uuid4().hex[:12]}"
    result = RefreshResult(run_dir)

    def write_layer(layer: str, names: Iterable[str], write: Callable[[str], str]) -> None:
        written = {f"{layer}.{n}": path for n, path in _each(names, write, parallel_jobs).items()}
        versions.publish(spark, out_dir, written)
        result.paths.update(written)

    def judged(table: str, mode: str) -> Callable[[list], None]:
        def check(report: list) -> None:
            failed = judge(report, table, mode)
            if failed:
                result.warnings[table] = failed
        return check

    def halting(df: DataFrame, table: str, spec: dict, mode: str) -> DataFrame:
        return guarded(df, table, **spec) if mode == "halt" else df

    # Ingestion and load; an extract without rows is not published.
    landed: dict[str, DataFrame] = {}

    def land(name: str) -> str:
        wide = rename_geography(source[name])
        path = sinks.land_wide(wide, f"{run_dir}/raw/{name}")
        landed[name] = spark.read.schema(wide.schema).parquet(path)
        return path

    def load(name: str) -> str:
        path, table, spec = f"{run_dir}/load/{name}", f"load.{name}", LOAD_CHECKS.get(name, {})
        loaded = halting(load_table(landed[name], DATASETS[name]), table, spec, staging_checks)
        seen = Observation()
        counted = loaded.observe(seen, F.count(F.lit(1)).alias("n")) if require_matches else loaded
        check = judged(table, staging_checks)

        def guard(report: list) -> None:
            if require_matches and not seen.get["n"]:
                raise EmptyInputError(f"{name} after filters: no rows")
            check(report)

        sinks.write_watched(counted, path, load_schema(DATASETS[name]), guard, spec)
        return path

    def stage(name: str) -> str:
        path, table, spec = f"{run_dir}/staging/{name}", f"staging.{name}", STAGING_CHECKS[name]
        schema, check = STAGING_SCHEMAS[name], judged(table, staging_checks)
        loaded = sinks.read_written(spark, result.paths[f"load.{name}"], load_schema(DATASETS[name]))
        staged = halting(stage_table(loaded, DATASETS[name]), table, spec, staging_checks)
        if variant == "cloud":
            return sinks.upsert_sink(spark, staged, targets[table], path, schema=schema, check=check, checks=spec)
        ordered = KEYS if name == "age_at_marriage" else ()  # stored sorted in the local variant
        sinks.write_watched(staged, path, schema, check, spec, order_by=ordered)
        return path

    def analyse(name: str) -> str:
        path, table, spec = f"{run_dir}/analytics/{name}", f"analytics.{name}", _analytics_checks(name, variant)
        check = judged(table, analytics_checks)
        staged = {n: sinks.read_written(spark, result.paths[f"staging.{n}"], STAGING_SCHEMAS[n])
                  for n in needed_datasets([name])}
        final = halting(final_table(name, staged, variant == "cloud"), table, spec, analytics_checks)
        if variant == "local":
            sinks.write_watched(final, path, check=check, checks=spec, order_by=KEYS)
            return path
        return sinks.upsert_partitioned(spark, final, targets[table], path, ANALYTICS_SCHEMAS[name],
                                        check=check, checks=spec)

    with guard_errors():
        write_layer("raw", DATASETS, land)
        write_layer("load", DATASETS, load)
        write_layer("staging", DATASETS, stage)
        write_layer("analytics", ANALYTICS, analyse)
    return result


def _analytics_checks(name: str, variant: str) -> dict:
    spec = dict(ANALYTICS_CHECKS[name])
    if variant == "local":  # no year_date column: check the (country, year) key instead
        spec = {k: tuple("year" if c == "year_date" else c for c in v) for k, v in spec.items()}
    return spec

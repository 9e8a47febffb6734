"""Registered queries: ``name -> (spark, input folder) -> DataFrame``.

Every query reads the input tables (directly or through the extracts derived
from them), so its work grows with the data.  Queries that exercise a sink
write under the session's checkpoint folder (shared storage on a cluster)
and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.contracts import ANALYTICS_SCHEMAS, DATASETS, STAGING_SCHEMAS, Pivot
from panelforge.operators import checks
from panelforge.operators.filters import domain_profile as _domain_profile
from panelforge.operators.filters import keep_codes
from panelforge.operators.pivot import conditional_pivot, pivot_values, self_join_split
from panelforge.operators.reshape import (drop_missing, parse_year, quote, split_columns,
                                          unpivot_years)
from panelforge.plans import insights
from panelforge.plans.analytics import Extracts, final_table, needed_datasets
from panelforge.plans.load import load_table
from panelforge.plans.refresh import current_tables, init_targets, landed_extracts, refresh
from panelforge.session import scratch_dir
from panelforge.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark, 'sinks')}/{name}"


def _load(name: str) -> Query:
    return lambda spark, base: Extracts(spark, base, datasets=[name]).load(name)


def _stage(name: str) -> Query:
    return lambda spark, base: Extracts(spark, base, datasets=[name]).stage(name)


def _final(name: str, with_year_date: bool = True) -> Query:
    def run(spark: SparkSession, base: str) -> DataFrame:
        out = Extracts(spark, base, datasets=needed_datasets([name])).final(name, with_year_date)
        return out if with_year_date else out.orderBy("country", "year")
    return run


def join_fanout(spark: SparkSession, base: str) -> DataFrame:
    """gender_gap with a pay-gap extract that carries two units per key."""
    return Extracts(spark, base, True, datasets=needed_datasets(["gender_gap"])).final("gender_gap")


def unpivot_sql(spark: SparkSession, base: str) -> DataFrame:
    """The explicit-list SQL form: ``UNPIVOT (v FOR year IN (...))``."""
    wide = Extracts(spark, base, datasets=["marriage_rate"]).wide["marriage_rate"]
    _, years = split_columns(wide.columns, DATASETS["marriage_rate"].id_columns)
    year_list = ", ".join(quote(c) for c in years)
    return spark.sql(f"""
        SELECT country, CAST(REPLACE(year_label, '_', '') AS BIGINT) AS year, marriage_rate
        FROM {{wide}}
        UNPIVOT (marriage_rate FOR year_label IN ({year_list}))
        WHERE marriage_rate IS NOT NULL AND NOT isnan(marriage_rate)""", wide=wide)


def unpivot_fused(spark: SparkSession, base: str) -> DataFrame:
    """Wide hours extract straight to F/M columns in one plan."""
    spec = DATASETS["hours_worked"]
    long = unpivot_years(Extracts(spark, base, datasets=["hours_worked"]).wide["hours_worked"], spec.id_columns, "value")
    long = parse_year(drop_missing(keep_codes(long, spec.filters), "value"))
    rule = Pivot("sex", "avg", (("hours_worked_f", "F"), ("hours_worked_m", "M")))
    return conditional_pivot(long, "value", rule)


def unpivot_pruned_years(spark: SparkSession, base: str) -> DataFrame:
    """Only 1996-1999 are expanded: the other year columns are never read."""
    ex = Extracts(spark, base, datasets=["hours_worked"])
    return load_table(ex.wide["hours_worked"], DATASETS["hours_worked"], years=range(1996, 2000))


def pivot_generic(spark: SparkSession, base: str) -> DataFrame:
    loaded = Extracts(spark, base, datasets=["hours_worked"]).load("hours_worked")
    return pivot_values(loaded, ["country", "year"], "sex", ["M", "F"], "hours_worked", "avg")


def self_join_split_query(spark: SparkSession, base: str) -> DataFrame:
    loaded = Extracts(spark, base, datasets=["hours_worked"]).load("hours_worked")
    return self_join_split(loaded, "hours_worked", "sex",
                           (("hours_worked_m", "M"), ("hours_worked_f", "F")))


def land_wide_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Land a raw extract (geography column still named ``geo\\TIME_PERIOD``),
    read it back and load it."""
    raw = Extracts(spark, base, datasets=["accidents"]).wide["accidents"].withColumnRenamed("country", "geo\\TIME_PERIOD")
    path = sinks.land_wide(raw, _scratch(spark, "landed_accidents"))
    return load_table(spark.read.parquet(path), DATASETS["accidents"], check_input=True)


def replace_sink(spark: SparkSession, base: str) -> DataFrame:
    """Full replace run twice on one path: the second run replaces the first."""
    staged = Extracts(spark, base, datasets=["hours_worked"]).stage("hours_worked")
    path = _scratch(spark, "stg_hours_worked")
    sinks.replace_sink(staged.filter(F.col("year") < 1998), path, STAGING_SCHEMAS["hours_worked"])
    sinks.replace_sink(staged, path, STAGING_SCHEMAS["hours_worked"])
    return sinks.read_written(spark, path, STAGING_SCHEMAS["hours_worked"])


def _upsert(spark: SparkSession, base: str, times: int) -> DataFrame:
    schema = ANALYTICS_SCHEMAS["relationships"]
    written = sinks.replace_sink(Extracts(spark, base, datasets=needed_datasets(["relationships"])).final("relationships"),
                                 _scratch(spark, "relationships"), schema)
    rel = sinks.read_written(spark, written, schema)  # computed once, read by every step below
    target = sinks.replace_sink(rel.filter(F.col("year") <= 1999), _scratch(spark, "rel_v0"),
                                schema)
    source = rel.filter(F.col("year") >= 1998).withColumn(
        "marriage_rate", F.col("marriage_rate") + F.lit(1.0))
    for i in range(times):
        target = sinks.upsert_sink(spark, source, target, _scratch(spark, f"rel_v{i + 1}"),
                                   schema=schema)
    return sinks.read_written(spark, target, schema)


def upsert_sink(spark: SparkSession, base: str) -> DataFrame:
    return _upsert(spark, base, 1)


def upsert_idempotent(spark: SparkSession, base: str) -> DataFrame:
    return _upsert(spark, base, 2)


def partitioned_sink(spark: SparkSession, base: str) -> DataFrame:
    """relationships written partitioned by date and clustered by country, read back."""
    rel = Extracts(spark, base, datasets=needed_datasets(["relationships"])).final("relationships")
    path = sinks.partitioned_sink(rel, _scratch(spark, "relationships"))
    return sinks.read_partitioned(spark, path, ANALYTICS_SCHEMAS["relationships"])


def upsert_partitions(spark: SparkSession, base: str) -> DataFrame:
    """The rows of ``upsert_sink`` by a table partitioned by date: only the years from 1998 on are rewritten."""
    schema = ANALYTICS_SCHEMAS["relationships"]
    written = sinks.replace_sink(Extracts(spark, base, datasets=needed_datasets(["relationships"])).final("relationships"),
                                 _scratch(spark, "relationships"), schema)
    rel = sinks.read_written(spark, written, schema)
    table = sinks.partitioned_sink(rel.filter(F.col("year") <= 1999), _scratch(spark, "rel_by_date"))
    source = rel.filter(F.col("year") >= 1998).withColumn("marriage_rate", F.col("marriage_rate") + F.lit(1.0))
    sinks.upsert_partitions(spark, source, table, _scratch(spark, "rel_staged"), schema)
    return sinks.read_partitioned(spark, table, schema)


def _in_late_nineties(table: DataFrame) -> DataFrame:
    return table.filter(F.col("year_date").between(F.lit("1996-12-31").cast("date"),
                                                   F.lit("1999-12-31").cast("date"))
                        & F.col("country").isin("NATION_1", "NATION_7", "NATION_19"))


def pruned_read(spark: SparkSession, base: str) -> DataFrame:
    """Date range and country filter on the partitioned table: the date filter
    prunes folders, the country filter skips row groups."""
    return _in_late_nineties(partitioned_sink(spark, base))


GENDER_GAP_COLUMNS = list(ANALYTICS_SCHEMAS["gender_gap"].names)


def check_not_null(spark: SparkSession, base: str) -> DataFrame:
    gg = Extracts(spark, base, datasets=needed_datasets(["gender_gap"])).final("gender_gap")
    return checks.not_null_counts(gg, GENDER_GAP_COLUMNS)


def check_unique(spark: SparkSession, base: str) -> DataFrame:
    """Duplicate (country, year) keys of the fan-out pay-gap staging table."""
    staged = Extracts(spark, base, True, datasets=["gender_pay_gap"]).stage("gender_pay_gap")
    return checks.duplicate_key_rows(staged, ["country", "year"])


def check_non_negative(spark: SparkSession, base: str) -> DataFrame:
    gg = Extracts(spark, base, datasets=needed_datasets(["gender_gap"])).final("gender_gap")
    return checks.non_negative_counts(gg, ["hours_worked_m", "hours_worked_f", "accidents_m",
                                           "accidents_f", "employed_m", "employed_f"])


def domain_profile(spark: SparkSession, base: str) -> DataFrame:
    wide = Extracts(spark, base, datasets=["hours_worked"]).wide["hours_worked"]
    dims = [c for c in DATASETS["hours_worked"].id_columns if c != "country"]
    return _domain_profile(wide, dims)


def _extract(name: str) -> Query:
    """A wide extract as landed: id columns plus one column per year."""
    return lambda spark, base: Extracts(spark, base, datasets=[name]).wide[name]


def check_load(spark: SparkSession, base: str) -> DataFrame:
    """Null counts of every column of the seven load tables, one job."""
    ex = Extracts(spark, base)
    return checks.labelled({n: checks.not_null_counts(ex.load(n), list(DATASETS[n].load_columns))
                            for n in DATASETS})


def check_staging(spark: SparkSession, base: str) -> DataFrame:
    """Not-null and unique-key reports of all seven staging tables, one job."""
    ex = Extracts(spark, base)
    return checks.labelled({n: checks.run_checks(ex.stage(n), **checks.STAGING_CHECKS[n])
                            for n in DATASETS})


def check_analytics(spark: SparkSession, base: str) -> DataFrame:
    """The reports the final tables are checked with before they are written."""
    ex = Extracts(spark, base)
    return checks.labelled({n: checks.run_checks(ex.final(n), **checks.ANALYTICS_CHECKS[n])
                            for n in ("relationships", "gender_gap")})


def refresh_local(spark: SparkSession, base: str) -> DataFrame:
    """Every layer written by one local-variant run; returns the stored
    relationships table (sorted, no ``year_date``)."""
    result = refresh(spark, base, _scratch(spark, "refresh"), variant="local")
    schema = ANALYTICS_SCHEMAS["relationships"]
    return spark.read.parquet(result.paths["analytics.relationships"]).select(
        *[c for c in schema.names if c != "year_date"])


def refresh_cloud(spark: SparkSession, base: str) -> DataFrame:
    """Two cloud-variant runs, the second upserting into what the folder points
    at; returns the current partitioned gender_gap table."""
    out = _scratch(spark, "refresh")
    init_targets(spark, out)
    refresh(spark, base, out, variant="cloud")
    refresh(spark, base, out, variant="cloud")
    return sinks.read_partitioned(spark, current_tables(spark, out)["analytics.gender_gap"],
                                  ANALYTICS_SCHEMAS["gender_gap"])


def refresh_halting(spark: SparkSession, base: str) -> DataFrame:
    """A local run whose staging checks are part of the written plans; returns the stored employed table."""
    result = refresh(spark, base, _scratch(spark, "refresh"), variant="local", staging_checks="halt")
    return sinks.read_written(spark, result.paths["staging.employed"], STAGING_SCHEMAS["employed"])


def refresh_from_landed(spark: SparkSession, base: str) -> DataFrame:
    """Extracts derived and landed as files, then one cloud run from those files alone."""
    out = _scratch(spark, "landed")
    wide = Extracts(spark, base).wide
    for name in DATASETS:
        sinks.land_wide(wide[name], f"{out}/{name}.parquet", check_input=False)
    init_targets(spark, out)
    result = refresh(spark, landed_extracts(spark, out), out)
    return sinks.read_partitioned(spark, result.paths["analytics.gender_gap"],
                                  ANALYTICS_SCHEMAS["gender_gap"])


def catalog_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """A staging table saved as a named catalog table and read by name."""
    staged = Extracts(spark, base, datasets=["hours_worked"]).stage("hours_worked")
    with sinks.catalog_names(spark) as (name,):
        sinks.save_table(staged, name, _scratch(spark, name), STAGING_SCHEMAS["hours_worked"])
        return spark.table(name)


def _bucketed_final(name: str) -> Query:
    """A final table joined from bucketed catalog tables: their rows are dealt by the key already."""
    def run(spark: SparkSession, base: str) -> DataFrame:
        needed = needed_datasets([name])
        ex = Extracts(spark, base, datasets=needed)
        with sinks.catalog_names(spark, len(needed)) as names:
            for table, dataset in zip(names, needed):
                sinks.save_bucketed(ex.stage(dataset), table, _scratch(spark, table), STAGING_SCHEMAS[dataset])
            return final_table(name, {d: spark.table(t) for t, d in zip(names, needed)})
    return run


def clustered_catalog(spark: SparkSession, base: str) -> DataFrame:
    """``pruned_read`` by name on a catalog table partitioned by date and clustered by country.

    The catalog lists the partitions when the read runs, so its rows are stored
    before the entry goes.
    """
    schema = ANALYTICS_SCHEMAS["relationships"]
    rel = Extracts(spark, base, datasets=needed_datasets(["relationships"])).final("relationships")
    with sinks.catalog_names(spark) as (name,):
        sinks.save_bucketed(rel, name, _scratch(spark, name), schema, keys=("country",), partition_by=("year_date",))
        found = _in_late_nineties(spark.table(name)).select(*schema.names)
        return sinks.read_written(spark, sinks.replace_sink(found, _scratch(spark, "found"), schema), schema)


# The final tables as a SQL user writes them over the staging tables.
RELATIONSHIPS_SQL = """
SELECT make_date(CAST(m.year AS INT), 12, 31) AS year_date, m.country, m.year, m.marriage_rate, d.divorce_rate,
       a.age_at_marriage_f, a.age_at_marriage_m, p.gender_pay_gap
FROM stg_marriage_rate m
LEFT JOIN stg_divorce_rate d ON m.country = d.country AND m.year = d.year
LEFT JOIN stg_age_at_marriage a ON m.country = a.country AND m.year = a.year
LEFT JOIN stg_gender_pay_gap p ON m.country = p.country AND m.year = p.year"""
GENDER_GAP_SQL = """
SELECT make_date(CAST(h.year AS INT), 12, 31) AS year_date, h.country, h.year, h.hours_worked_m, h.hours_worked_f,
       h.hours_worked_delta, p.gender_pay_gap, x.accidents_m, x.accidents_f, e.employed_m, e.employed_f
FROM stg_hours_worked h
LEFT JOIN stg_gender_pay_gap p ON h.country = p.country AND h.year = p.year
LEFT JOIN stg_accidents x ON h.country = x.country AND h.year = x.year
LEFT JOIN stg_employed e ON h.country = e.country AND h.year = e.year"""


def _sql_final(name: str, sql: str) -> Query:
    """A final table as Spark SQL over stored staging tables named by views."""
    def run(spark: SparkSession, base: str) -> DataFrame:
        ex = Extracts(spark, base, datasets=needed_datasets([name]))
        stored = {}
        for dataset in needed_datasets([name]):
            path = sinks.replace_sink(ex.stage(dataset), _scratch(spark, dataset), STAGING_SCHEMAS[dataset])
            stored[f"stg_{dataset}"] = sinks.read_written(spark, path, STAGING_SCHEMAS[dataset])
        with sinks.named_views(spark, stored):
            return spark.sql(sql)
    return run


def _written_reports(spark: SparkSession, tables: dict[str, DataFrame], specs: dict[str, dict]) -> DataFrame:
    """Write every table with its checks counted on the way; the reports, a row per checked column."""
    rows = [(n, *row) for n, df in tables.items()
            for row in sinks.write_watched(df, _scratch(spark, n), checks=specs[n])]
    return spark.createDataFrame(rows, "table_name string, check string, column_name string, violations bigint")


def write_staging_checked(spark: SparkSession, base: str) -> DataFrame:
    """The reports of ``check_staging``, counted while the seven staging tables are written."""
    return _written_reports(spark, Extracts(spark, base).staged(DATASETS), checks.STAGING_CHECKS)


def write_analytics_checked(spark: SparkSession, base: str) -> DataFrame:
    """The reports of ``check_analytics``, counted while the final tables are written."""
    ex = Extracts(spark, base)
    return _written_reports(spark, {n: ex.final(n) for n in checks.ANALYTICS_CHECKS}, checks.ANALYTICS_CHECKS)


def _on_final(name: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, base: fn(Extracts(spark, base, datasets=needed_datasets([name])).final(name))


QUERIES: dict[str, Query] = {
    **{f"extract_{n}": _extract(n) for n in DATASETS},
    **{f"load_{n}": _load(n) for n in DATASETS},
    **{f"stg_{n}": _stage(n) for n in DATASETS},
    "relationships": _final("relationships"),
    "gender_gap": _final("gender_gap"),
    "relationships_local": _final("relationships", with_year_date=False),
    "gender_gap_local": _final("gender_gap", with_year_date=False),
    "join_fanout": join_fanout,
    "unpivot_sql": unpivot_sql,
    "unpivot_fused": unpivot_fused,
    "unpivot_pruned_years": unpivot_pruned_years,
    "pivot_generic": pivot_generic,
    "self_join_split": self_join_split_query,
    "land_wide_roundtrip": land_wide_roundtrip,
    "replace_sink": replace_sink,
    "upsert_sink": upsert_sink,
    "upsert_idempotent": upsert_idempotent,
    "partitioned_sink": partitioned_sink,
    "pruned_read": pruned_read,
    "refresh_local": refresh_local,
    "refresh_cloud": refresh_cloud,
    "refresh_from_landed": refresh_from_landed,
    "refresh_halting": refresh_halting,
    "catalog_roundtrip": catalog_roundtrip,
    "upsert_partitions": upsert_partitions,
    "bucketed_relationships": _bucketed_final("relationships"),
    "bucketed_gender_gap": _bucketed_final("gender_gap"),
    "clustered_catalog": clustered_catalog,
    "relationships_sql": _sql_final("relationships", RELATIONSHIPS_SQL),
    "gender_gap_sql": _sql_final("gender_gap", GENDER_GAP_SQL),
    "write_staging_checked": write_staging_checked,
    "write_analytics_checked": write_analytics_checked,
    "check_not_null": check_not_null,
    "check_unique": check_unique,
    "check_non_negative": check_non_negative,
    "check_load": check_load,
    "check_staging": check_staging,
    "check_analytics": check_analytics,
    "domain_profile": domain_profile,
    "preview": _on_final("relationships", insights.preview),
    "pay_gap_trend": _on_final("relationships", insights.pay_gap_trend),
    "age_gap_convergence": _on_final("relationships", insights.age_gap_convergence),
    "employment_gap_reduction": _on_final("gender_gap", insights.employment_gap_reduction),
    "accident_share": _on_final("gender_gap", insights.accident_share),
    "divorce_marriage_ratio": _on_final("relationships", insights.divorce_marriage_ratio),
    "hours_delta_profile": _on_final("gender_gap", insights.hours_delta_profile),
    "hours_delta_by_year": _on_final("gender_gap",
                                     lambda t: insights.hours_delta_profile(t, by="year")),
    "pay_gap_correlation": _on_final("relationships", insights.pay_gap_correlation),
    "pay_gap_correlation_panel": _on_final(
        "relationships", lambda t: insights.pay_gap_correlation(t, by=None)),
    "pay_gap_correlation_by_country": _on_final(
        "relationships", lambda t: insights.pay_gap_correlation(t, by="country")),
    "gap_comovement": _on_final("gender_gap", insights.gap_comovement),
    "marriage_rate_drop": _on_final("relationships", insights.marriage_rate_drop),
}

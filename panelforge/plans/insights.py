"""Analyses the reference describes in prose, built on the two final tables.

Per-country results group by country only; the tables hold one row per
(country, year), so a country's group is bounded by the number of years, not
by the data volume.  Window functions partition by country for the same
reason.  Slopes and correlations are rounded (engines differ in the last
bits of these sums); ratios and differences are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelforge.functions.scalar import guarded_corr, safe_ratio

SLOPE_DIGITS = 6


def _slope(y: str, x: str = "year") -> F.Column:
    return F.round(F.regr_slope(F.col(y), F.col(x).cast("double")), SLOPE_DIGITS)


def pay_gap_trend(relationships: DataFrame) -> DataFrame:
    """Least-squares slope of the pay gap on the year, per country (D1)."""
    rows = relationships.filter(F.col("gender_pay_gap").isNotNull())
    return rows.groupBy("country").agg(
        F.count(F.lit(1)).alias("years"),
        F.min_by("gender_pay_gap", "year").alias("gap_first"),
        F.max_by("gender_pay_gap", "year").alias("gap_last"),
        _slope("gender_pay_gap").alias("gap_slope"),
    )


def _first_last_gap(df: DataFrame, gap: F.Column) -> DataFrame:
    rows = df.select("country", "year", gap.alias("gap")).filter(F.col("gap").isNotNull())
    return rows.groupBy("country").agg(
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.min_by("gap", "year").alias("gap_first"),
        F.max_by("gap", "year").alias("gap_last"),
        _slope("gap").alias("gap_slope"),
    )


def age_gap_convergence(relationships: DataFrame) -> DataFrame:
    """Male minus female age at first marriage: change and convergence (D2)."""
    out = _first_last_gap(relationships, F.col("age_at_marriage_m") - F.col("age_at_marriage_f"))
    return out.withColumn("gap_change", F.col("gap_last") - F.col("gap_first")).withColumn(
        "converging", F.abs(F.col("gap_last")) < F.abs(F.col("gap_first")))


def employment_gap_reduction(gender_gap: DataFrame) -> DataFrame:
    """Male minus female employment: share of the first gap closed by the last (D3)."""
    out = _first_last_gap(gender_gap, F.col("employed_m") - F.col("employed_f"))
    return out.withColumn("reduction", F.lit(1.0) - safe_ratio("gap_last", "gap_first"))


def accident_share(gender_gap: DataFrame) -> DataFrame:
    """Male share of work accidents and the male-to-female ratio, per row (D4)."""
    m, f = F.col("accidents_m"), F.col("accidents_f")
    return gender_gap.select(
        "country", "year",
        safe_ratio(m, m + f).alias("male_share"),
        safe_ratio(m, f).alias("male_to_female"),
    )


def divorce_marriage_ratio(relationships: DataFrame) -> DataFrame:
    """Divorces per marriage, per row (D5); null when the marriage rate is 0."""
    return relationships.select(
        "country", "year", safe_ratio("divorce_rate", "marriage_rate").alias("divorce_to_marriage"))


def pay_gap_correlation(relationships: DataFrame, by: str | None = "year", digits: int = 6) -> DataFrame:
    """Pearson correlation of the pay gap with marriage and divorce rates (D6):
    across countries per year (``by="year"``), across years per country
    (``by="country"``) or over the whole panel (``by=None``); null for flat or
    one-row groups."""
    return relationships.groupBy(*([by] if by else [])).agg(
        F.count(F.lit(1)).alias("observations"),
        F.round(guarded_corr("gender_pay_gap", "marriage_rate"), digits).alias("corr_marriage"),
        F.round(guarded_corr("gender_pay_gap", "divorce_rate"), digits).alias("corr_divorce"),
    )


def hours_delta_profile(gender_gap: DataFrame, by: str = "country", digits: int = 9) -> DataFrame:
    """Hours-worked delta per country (or per year): mean, smallest, largest (D8)."""
    return gender_gap.groupBy(by).agg(
        F.count("hours_worked_delta").alias("observations"),
        F.round(F.avg("hours_worked_delta"), digits).alias("delta_avg"),
        F.min("hours_worked_delta").alias("delta_min"),
        F.max("hours_worked_delta").alias("delta_max"),
    )


def _change(col: str) -> F.Column:
    """Change against the year before; null where that year is missing."""
    w = Window.partitionBy("country").orderBy("year")
    return F.when(F.col("year") - F.lag("year").over(w) == 1, F.col(col) - F.lag(col).over(w))


def gap_comovement(gender_gap: DataFrame) -> DataFrame:
    """Do the labour gaps move with the pay gap (D7)?

    Per row, the sign of the year-on-year change of each gap; per country, the
    share of compared years in which a gap moved the same way as the pay gap.
    """
    gaps = gender_gap.select(
        "country", "year", "gender_pay_gap", "hours_worked_delta",
        (F.col("employed_m") - F.col("employed_f")).alias("employed_gap"),
        (F.col("accidents_m") - F.col("accidents_f")).alias("accidents_gap"),
    )
    moves = gaps.select(
        "country",
        F.signum(_change("gender_pay_gap")).alias("d_pay"),
        F.signum(_change("hours_worked_delta")).alias("d_hours"),
        F.signum(_change("employed_gap")).alias("d_employed"),
        F.signum(_change("accidents_gap")).alias("d_accidents"),
    )

    def agree(col: str) -> F.Column:
        both = F.col("d_pay").isNotNull() & F.col(col).isNotNull()
        return F.avg(F.when(both, (F.col(col) == F.col("d_pay")).cast("double")))

    return moves.groupBy("country").agg(
        F.count("d_pay").alias("pay_changes"),
        agree("d_hours").alias("hours_agree"),
        agree("d_employed").alias("employed_agree"),
        agree("d_accidents").alias("accidents_agree"),
    )


def marriage_rate_drop(relationships: DataFrame) -> DataFrame:
    """Largest year-on-year fall of the marriage rate per country (D9); ties go
    to the earliest year, and both columns are null where nothing falls."""
    changes = relationships.select("country", "year", _change("marriage_rate").alias("change"))
    worst = changes.groupBy("country").agg(
        F.min(F.when(F.col("change") < 0, F.struct("change", "year"))).alias("w"))
    return worst.select("country", F.col("w.year").alias("drop_year"),
                        F.col("w.change").alias("drop"))


def preview(table: DataFrame, rows: int = 10) -> DataFrame:
    """First rows in key order (a top-k: Spark keeps a bounded heap per task)."""
    return table.orderBy("country", "year").limit(rows)

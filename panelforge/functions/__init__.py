"""Column expressions built from ``pyspark.sql.functions`` only (JVM side)."""

from panelforge.functions.scalar import (
    guarded_corr,
    label_to_year,
    period_end_date,
    safe_ratio,
)

__all__ = ["guarded_corr", "label_to_year", "period_end_date", "safe_ratio"]

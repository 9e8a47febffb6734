"""Staging layer: long table -> one row per (country, year) intended."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelforge.contracts import STAGING_SCHEMAS, Dataset
from panelforge.operators.pivot import conditional_pivot


def stage_table(loaded: DataFrame, dataset: Dataset) -> DataFrame:
    """Passthrough of (country, year, value), or the conditional-aggregate pivot.

    The passthrough does not de-duplicate: duplicate keys in the load table
    stay, and later left joins multiply on them, as the reference does.
    """
    value = dataset.value_column
    if dataset.staging is None:
        out = loaded.select("country", "year", value)
    else:
        out = conditional_pivot(loaded, value, dataset.staging)
    if out.columns != STAGING_SCHEMAS[dataset.name].names:
        raise ValueError(f"{dataset.name}: staging columns {out.columns} break the contract")
    return out

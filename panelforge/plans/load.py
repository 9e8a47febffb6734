"""Load layer: wide extract -> long table (one row per kept cell)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from panelforge.contracts import Dataset
from panelforge.functions.scalar import label_to_year
from panelforge.operators.filters import keep_codes, require_rows
from panelforge.operators.reshape import drop_missing, unpivot_years


def load_table(extract: DataFrame, dataset: Dataset, years: Iterable[int] | None = None,
               check_input: bool = False, check_output: bool = False) -> DataFrame:
    """Unpivot -> dimension filters -> drop missing -> parse year -> project.

    One lazy plan without a shuffle: the scan, a filter pushed below the
    ``Expand``, the ``Expand`` itself and a projection.  A column that is
    neither a dimension nor a year raises at once, even where it is all null.

    ``check_input`` raises on an empty extract (cheap when the extract is a
    landed file, a full evaluation when it is a derived plan);
    ``check_output`` raises when the filters matched nothing.
    """
    if check_input:
        require_rows(extract, dataset.name)
    value = dataset.value_column
    long = unpivot_years(extract, dataset.id_columns, value, years=years)
    long = drop_missing(keep_codes(long, dataset.filters), value)
    out = long.select(
        *[label_to_year("year_label").alias(c) if c == "year" else c for c in dataset.load_columns])
    if check_output:
        require_rows(out, f"{dataset.name} after filters")
    return out

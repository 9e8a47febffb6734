"""Wide -> long reshaping of yearly extracts.

The year columns of an extract are not known when the code is written: they
are whatever is not a dimension.  We read them from ``df.columns`` at plan time
(a schema lookup, no job), validate their names eagerly, and hand Catalyst one
``Expand`` node.  Dimension filters placed after the unpivot are pushed below
it and into the scan by the optimizer.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.contracts import GEO_COLUMN, YEAR_COLUMN_PATTERN
from panelforge.functions.scalar import label_to_year

_YEAR_NAME = re.compile(YEAR_COLUMN_PATTERN)


def rename_geography(df: DataFrame, source: str = GEO_COLUMN, target: str = "country") -> DataFrame:
    """Rename the raw geography column; fail loudly when neither name exists.

    ``withColumnRenamed`` alone is a silent no-op for a missing column.
    """
    out = df.withColumnRenamed(source, target)
    if target not in out.columns:
        raise ValueError(f"extract has neither {source!r} nor {target!r}: {df.columns}")
    return out


def split_columns(columns: Sequence[str],
                  id_allow_list: Iterable[str]) -> tuple[list[str], list[str]]:
    """Id columns are those on the allow-list, the rest are years; frame order kept."""
    allowed = set(id_allow_list)
    ids = [c for c in columns if c in allowed]
    years = [c for c in columns if c not in allowed]
    return ids, years


def validate_year_columns(columns: Sequence[str]) -> None:
    """Raise now, not at the first action, for a column that is not a year.

    Under lazy evaluation a bad name would only fail when ``year`` is
    materialised (a ``count()`` prunes the cast away), so check the names.
    """
    bad = [c for c in columns if not _YEAR_NAME.match(c)]
    if bad:
        raise ValueError(f"columns are neither dimensions nor years: {bad}")
    if not columns:
        raise ValueError("extract has no year columns")


def unpivot_years(df: DataFrame, id_allow_list: Iterable[str], value: str,
                  years: Iterable[int] | None = None, name: str = "year_label") -> DataFrame:
    """Dynamic unpivot: one row per (id columns, year column), nulls kept.

    ``years`` restricts the expanded columns *before* the unpivot, so an
    unwanted year is never read or expanded (a filter on ``year`` after the
    unpivot is not pushed through the ``Expand``).  Year columns are widened to
    double first so an int and a double column can be stacked.
    """
    ids, year_cols = split_columns(df.columns, id_allow_list)
    validate_year_columns(year_cols)
    if years is not None:
        wanted = {int(y) for y in years}
        year_cols = [c for c in year_cols if int(c.lstrip("_")) in wanted]
        if not year_cols:
            raise ValueError(f"none of the years {sorted(wanted)} is in the extract")
    widened = df.selectExpr(*[quote(c) for c in ids],
                            *[f"CAST({quote(c)} AS DOUBLE) AS {quote(c)}" for c in year_cols])
    return widened.unpivot(ids, year_cols, name, value)


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def present(value: str) -> Column:
    """True when a cell holds a number: not null and not NaN (``IS NOT NULL``
    alone would keep NaN)."""
    return F.col(value).isNotNull() & ~F.isnan(F.col(value))


def drop_missing(df: DataFrame, value: str) -> DataFrame:
    """Drop rows whose value is null or NaN."""
    return df.filter(present(value))


def parse_year(df: DataFrame, label: str = "year_label", out: str = "year") -> DataFrame:
    parsed = df.withColumn(out, label_to_year(label))
    return parsed if label == out else parsed.drop(label)

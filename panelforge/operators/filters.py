"""Dimension filters, non-empty guards and domain profiling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.checks import union_all


class EmptyInputError(ValueError):
    """An input or a filtered table has no rows."""


def dimension_predicate(filters: Iterable[tuple[str, Sequence[str]]]) -> Column | None:
    """AND of ``dim IN (codes)``; a single code becomes ``dim = code``.

    Null dimensions never pass (``IN`` and ``=`` are null on null input).
    """
    pred: Column | None = None
    for column, codes in filters:
        codes = list(codes)
        term = F.col(column) == codes[0] if len(codes) == 1 else F.col(column).isin(codes)
        pred = term if pred is None else pred & term
    return pred


def keep_codes(df: DataFrame, filters: Iterable[tuple[str, Sequence[str]]]) -> DataFrame:
    pred = dimension_predicate(filters)
    return df if pred is None else df.filter(pred)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Raise when ``df`` has no rows.

    ``isEmpty`` stops at the first row found, so on a large input it reads one
    split, not the table.
    """
    if df is None or df.isEmpty():
        raise EmptyInputError(f"{name}: no rows")
    return df


def require_all_rows(frames: Mapping[str, DataFrame], what: str) -> None:
    """``require_rows`` for many tables in one job: each contributes at most
    one probe row, and the names that returned none are reported."""
    probes = union_all(df.limit(1).select(F.lit(name).alias("name"))
                       for name, df in frames.items())
    found = {r.name for r in probes.collect()}
    empty = [name for name in frames if name not in found]
    if empty:
        raise EmptyInputError(f"{what}: no rows in {empty}")


def domain_profile(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Distinct values of every dimension with their row counts, in one pass.

    The dimensions are stacked into (dimension, value) pairs and counted with
    one partial + final aggregate, instead of one ``distinct`` job per column.
    """
    stacked = df.select(*[F.col(d).cast("string").alias(d) for d in dimensions]).unpivot(
        [], list(dimensions), "dimension", "value")
    return stacked.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("rows"))

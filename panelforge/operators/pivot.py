"""Long -> wide by conditional aggregation (the staging-layer pivot)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.contracts import KEYS, Pivot

_AGGREGATES = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min}


def conditional_pivot(df: DataFrame, value: str, rule: Pivot,
                      keys: Sequence[str] = KEYS) -> DataFrame:
    """``GROUP BY keys`` with ``AGG(CASE WHEN dim = code THEN value END)`` per column.

    A group with no row for a code gets null for AVG *and* SUM (never 0), and a
    code outside the list still creates its key row.  Spark plans a partial
    aggregate before the shuffle, so a hot key is combined map-side.
    """
    agg = _AGGREGATES[rule.function]
    measures = {out: agg(F.when(F.col(rule.dimension) == code, F.col(value)))
                for out, code in rule.columns}
    columns = [m.alias(out) for out, m in measures.items()]
    if rule.delta:  # written over the aggregates, as in SQL; Catalyst computes each once
        name, left, right = rule.delta
        columns.append((measures[left] - measures[right]).alias(name))
    return df.groupBy(*keys).agg(*columns)


def pivot_values(df: DataFrame, keys: Sequence[str], dimension: str, codes: Sequence[str],
                 value: str, function: str = "avg", prefix: str | None = None) -> DataFrame:
    """Generic pivot with ``GroupedData.pivot`` and a fixed code list.

    Passing the codes avoids the extra job Spark runs to discover them and keeps
    the output schema stable; columns are named ``{prefix}_{code}``.
    """
    agg = _AGGREGATES[function]
    wide = df.groupBy(*keys).pivot(dimension, list(codes)).agg(agg(value))
    prefix = prefix if prefix is not None else value
    return wide.select(*keys, *[F.col(f"`{c}`").alias(f"{prefix}_{c}".lower()) for c in codes])


def self_join_split(df: DataFrame, value: str, dimension: str, codes: Sequence[tuple[str, str]],
                    keys: Sequence[str] = KEYS) -> DataFrame:
    """The rejected design: one filtered copy per code, joined on the keys.

    Kept only to show it equals ``conditional_pivot`` once each copy is reduced
    to one row per key; without that reduction it multiplies rows.
    """
    key_cols = list(keys)
    out = df.select(*key_cols).distinct()
    for name, code in codes:
        part = (df.filter(F.col(dimension) == code)
                .groupBy(*key_cols).agg(F.avg(value).alias(name)))
        out = out.join(part, key_cols, "left")
    return out

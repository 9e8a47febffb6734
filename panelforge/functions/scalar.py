"""Scalar and aggregate expressions shared by the operators.

All of them compile to Catalyst expressions, so they stay inside whole-stage
codegen; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_to_year(label: Column | str) -> Column:
    """``'_2013'`` or ``'2013'`` -> 2013 as bigint.

    A literal (non-regex) replace of ``_`` followed by a strict cast; under ANSI
    mode a malformed label raises instead of turning into null.
    """
    return F.replace(_col(label), F.lit("_"), F.lit("")).cast("bigint")


def period_end_date(year: Column | str) -> Column:
    """``DATE(year, 12, 31)``: the date a yearly value is partitioned under."""
    return F.make_date(_col(year).cast("int"), F.lit(12), F.lit(31))


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator``, null when the denominator is zero or null."""
    return F.try_divide(_col(numerator), _col(denominator))


def guarded_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation that is null (not an error) for flat or one-row groups.

    ``covar_pop / (stddev_pop * stddev_pop)`` with the denominator guarded;
    ``F.corr`` raises on zero variance under ANSI mode.
    """
    xc, yc = _col(x), _col(y)
    both = xc.isNotNull() & yc.isNotNull()
    xs, ys = F.when(both, xc), F.when(both, yc)
    spread = F.nullif(F.stddev_pop(xs) * F.stddev_pop(ys), F.lit(0.0))
    return safe_ratio(F.covar_pop(xs, ys), spread)

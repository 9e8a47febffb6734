"""Data-quality checks: not null, unique keys, non-negative.

The checks of a table return their violation counts as a DataFrame computed in
one pass (one aggregate, then a stack into rows); ``enforce``
raises before a sink when any count is non-zero, which halts downstream steps.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


class QualityCheckError(AssertionError):
    pass


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack frames with the same columns (by name) into one plan, one job."""
    return reduce(DataFrame.unionByName, frames)


def labelled(reports: Mapping[str, DataFrame]) -> DataFrame:
    """One report for many tables, with a ``table_name`` column in front."""
    return union_all(r.select(F.lit(name).alias("table_name"), "*") for name, r in reports.items())


def _stack_counts(df: DataFrame, counts: Mapping[str, F.Column], check: str) -> DataFrame:
    row = df.agg(*[expr.cast("bigint").alias(name) for name, expr in counts.items()])
    return (row.unpivot([], list(counts), "column_name", "violations")
            .select(F.lit(check).alias("check"), "column_name", "violations"))


def not_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _stack_counts(df, {c: F.count_if(F.col(c).isNull()) for c in columns}, "not_null")


def non_negative_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Negative values per column; null passes (it is the not-null check's job)."""
    return _stack_counts(df, {c: F.count_if(F.col(c) < 0) for c in columns}, "non_negative")


def duplicate_key_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once and how often (shuffles on the keys, after a
    map-side partial count)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))


def run_checks(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (),
               non_negative: Sequence[str] = ()) -> DataFrame:
    """All checks of one table in one pass: per key the counts, then their totals."""
    counts = {("not_null", c): F.count_if(F.col(c).isNull()) for c in not_null}
    counts |= {("non_negative", c): F.count_if(F.col(c) < 0) for c in non_negative}
    names = {f"n{i}": check for i, check in enumerate(counts)}
    if unique:
        grouped = df.groupBy(*unique).agg(
            F.count(F.lit(1)).alias("rows"),
            *[counts[check].alias(n) for n, check in names.items()])
        totals = {n: F.coalesce(F.sum(n), F.lit(0)) for n in names}
        totals["dup"] = F.count_if(F.col("rows") > 1)
        names["dup"] = ("unique", ",".join(unique))
        row = grouped.agg(*[total.cast("bigint").alias(n) for n, total in totals.items()])
    else:
        row = df.agg(*[counts[check].cast("bigint").alias(n) for n, check in names.items()])
    rows = [F.struct(F.lit(check).alias("check"), F.lit(column).alias("column_name"),
                     F.col(n).alias("violations")) for n, (check, column) in names.items()]
    return row.select(F.inline(F.array(*rows)))


def enforce(report: DataFrame, name: str, mode: str = "fail",
            detail: str | None = None) -> dict[str | None, list[tuple[str, str, int]]]:
    """Collect the (small, one row per checked column) report; raise on
    violations when ``mode == 'fail'``, return them when ``mode == 'warn'``.

    Failures are grouped by the ``detail`` column (e.g. the table name of a
    combined report), or under ``None``.
    """
    failed: dict[str | None, list[tuple[str, str, int]]] = {}
    for r in report.filter(F.col("violations") > 0).collect():
        key = r[detail] if detail else None
        failed.setdefault(key, []).append((r.check, r.column_name, int(r.violations)))
    if failed and mode == "fail":
        raise QualityCheckError(f"{name}: checks failed {failed}")
    return failed


class Watch:
    """Counts of checks, gathered while a frame is written; ``report`` waits for that write."""

    def __init__(self, names: Mapping[str, tuple[str, str]], repeated: str | None = None):
        self.observation = Observation()
        self._names, self._repeated = dict(names), repeated

    def report(self) -> list[tuple[str, str, int]]:
        """(check, column, violations), as the rows of ``run_checks``."""
        got = self.observation.get if self._names else {}
        return [(check, column, int(got[n])) for n, (check, column) in self._names.items()]

    def repeated_keys(self) -> int:
        return int(self.observation.get[self._repeated]) if self._repeated else 0


def watch_marked(marked: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (),
                 non_negative: Sequence[str] = (), only: Column | None = None,
                 report_unique: bool = True) -> tuple[DataFrame, Watch]:
    """Observe the checks of the rows where ``only`` holds.

    ``_nth`` numbers the rows of each key, so a key is repeated where it is 2.
    """
    only = F.lit(True) if only is None else only
    counts = {("not_null", c): F.count_if(only & F.col(c).isNull()) for c in not_null}
    counts |= {("non_negative", c): F.count_if(only & (F.col(c) < 0)) for c in non_negative}
    if unique:
        counts[("unique", ",".join(unique))] = F.count_if(only & (F.col("_nth") == 2))
    names = {f"n{i}": check for i, check in enumerate(counts)}
    repeated = next((n for n, (check, _) in names.items() if check == "unique"), None)
    watch = Watch({n: c for n, c in names.items() if report_unique or n != repeated}, repeated)
    if counts:
        marked = marked.observe(watch.observation, *[counts[c].cast("bigint").alias(n) for n, c in names.items()])
    return marked, watch


def watch_rows(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (),
               non_negative: Sequence[str] = ()) -> tuple[DataFrame, Watch]:
    """``df`` and the checks of ``run_checks``, counted when ``df`` is written.

    The frame is evaluated once.  Only ``unique`` adds a step, numbering the
    rows of each key, which needs no shuffle where ``df`` is already dealt by it.
    """
    marked = df
    if unique:
        marked = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*unique).orderBy(F.lit(0))))
    watched, watch = watch_marked(marked, not_null, unique, non_negative)
    return watched.select(*df.columns), watch


def guarded(df: DataFrame, name: str, not_null: Sequence[str] = (), non_negative: Sequence[str] = (),
            **_: object) -> DataFrame:
    """``df``, whose evaluation fails at the first null or negative value of a checked column.

    The check is part of the columns' own expressions, so a write that would
    store a bad value ends with its job and nothing is published.
    """
    def stop(problem: str) -> Column:
        return F.raise_error(F.lit(f"{GUARD}{name}: {problem}"))

    checked = {}
    for c in dict.fromkeys([*not_null, *non_negative]):
        value = F.col(c)
        if c in non_negative:
            value = F.when(F.col(c) < 0, stop(f"non_negative {c}").cast(df.schema[c].dataType)).otherwise(value)
        if c in not_null:
            value = F.when(F.col(c).isNull(), stop(f"not_null {c}").cast(df.schema[c].dataType)).otherwise(value)
        checked[c] = value
    return df.select(*[checked[c].alias(c) if c in checked else F.col(c) for c in df.columns])


def judge(report: Iterable[tuple[str, str, int]], name: str, mode: str = "fail") -> list[tuple[str, str, int]]:
    """The failed checks of a watched table; raises for them unless ``mode`` is ``warn``."""
    failed = [row for row in report if row[2] > 0]
    if failed and mode != "warn":
        raise QualityCheckError(f"{name}: checks failed {failed}")
    return failed


GUARD = "check failed: "


@contextmanager
def guard_errors() -> Iterator[None]:
    """Turns the error of a job that ``guarded`` ended into a QualityCheckError."""
    try:
        yield
    except Exception as exc:
        found = re.search(re.escape(GUARD) + r"([^\n'\"]+)", str(exc))
        if found is None:
            raise
        raise QualityCheckError(found.group(1)) from exc


# Checks described for the tables of the pipeline, re-aimed at the real ones.
_KEYS = ("country", "year")
LOAD_CHECKS = {"hours_worked": {"not_null": ("sex", "hours_worked")}}
STAGING_CHECKS = {
    "marriage_rate": {"not_null": (*_KEYS, "marriage_rate"), "unique": _KEYS},
    "divorce_rate": {"not_null": (*_KEYS, "divorce_rate"), "unique": _KEYS},
    "age_at_marriage": {"not_null": _KEYS, "unique": _KEYS},
    "gender_pay_gap": {"not_null": _KEYS, "unique": _KEYS},
    "hours_worked": {"not_null": _KEYS, "unique": _KEYS,
                     "non_negative": ("hours_worked_m", "hours_worked_f")},
    "accidents": {"not_null": _KEYS, "unique": _KEYS,
                  "non_negative": ("accidents_m", "accidents_f")},
    "employed": {"not_null": _KEYS, "unique": _KEYS,
                 "non_negative": ("employed_m", "employed_f")},
}
ANALYTICS_CHECKS = {
    "relationships": {"not_null": ("country", "year_date", "gender_pay_gap",
                                   "age_at_marriage_f", "age_at_marriage_m"),
                      "unique": ("country", "year_date")},
    "gender_gap": {"not_null": ("country", "year_date", "hours_worked_delta"),
                   "unique": ("country", "year_date"),
                   "non_negative": ("hours_worked_m", "hours_worked_f")},
}

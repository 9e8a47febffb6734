"""Analytics layer: the two final tables, and the chain that feeds them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelforge.contracts import ANALYTICS, ANALYTICS_SCHEMAS, DATASETS
from panelforge.functions.scalar import period_end_date
from panelforge.operators.joins import left_join_all
from panelforge.plans.load import load_table
from panelforge.plans.staging import stage_table
from panelforge.session import scratch_dir
from panelforge.sources.extracts import ExtractRecipe, read_cube, recipes, wide_extract


def final_table(name: str, staged: Mapping[str, DataFrame],
                with_year_date: bool = True) -> DataFrame:
    """Anchor LEFT JOIN the others on (country, year), plus ``year_date``.

    ``with_year_date=False`` gives the local variant, which has no date column.
    """
    spec = ANALYTICS[name]
    joined = left_join_all(staged[spec.anchor], [staged[n] for n in spec.joined])
    columns = ANALYTICS_SCHEMAS[name].names
    if with_year_date:
        return joined.select(*[period_end_date("year").alias(c) if c == "year_date" else c
                               for c in columns])
    return joined.select(*[c for c in columns if c != "year_date"])


def needed_datasets(names: Iterable[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        spec = ANALYTICS[name]
        for d in (spec.anchor, *spec.joined):
            if d not in out:
                out.append(d)
    return out


class Extracts:
    """The seven wide extracts of one input folder, as lazy DataFrames.

    All of them are cut from one measure cube, which holds what ``datasets``
    need and no more.  It runs once and is written as a Parquet table under the
    session's checkpoint folder, so the query that follows reads a table of a
    few thousand rows instead of re-deriving it in every branch (Catalyst
    pushes different filters into each branch, which defeats exchange reuse).
    The written table also cuts the lineage: losing an executor later does not
    recompute the join.
    """

    def __init__(self, spark: SparkSession, base: str, pay_gap_fanout: bool = False,
                 datasets: Iterable[str] = DATASETS):
        self.spark = spark
        wanted = recipes(pay_gap_fanout)
        wanted = {n: wanted[n] for n in datasets}
        cube = read_cube(spark, base, wanted.values())
        self.cube, self.years = self._materialize(cube)
        self.wide = _WideExtracts(self.cube, self.years, wanted)

    def _materialize(self, cube: DataFrame) -> tuple[DataFrame, list[int]]:
        """Write the cube once; the year list is observed during that write
        (a metric gathered with the job, not a second job)."""
        path = f"{scratch_dir(self.spark, 'cube')}/cube"
        seen = Observation("cube")
        cube.observe(seen, F.collect_set("year").alias("years")).write.parquet(path)
        return (self.spark.read.schema(cube.schema).parquet(path),
                sorted(int(y) for y in seen.get["years"]))

    def load(self, name: str) -> DataFrame:
        return load_table(self.wide[name], DATASETS[name])

    def stage(self, name: str) -> DataFrame:
        return stage_table(self.load(name), DATASETS[name])

    def staged(self, names: Iterable[str]) -> dict[str, DataFrame]:
        return {n: self.stage(n) for n in names}

    def final(self, name: str, with_year_date: bool = True) -> DataFrame:
        return final_table(name, self.staged(needed_datasets([name])), with_year_date)


class _WideExtracts(Mapping[str, DataFrame]):
    """Wide extracts built on first access, so a query only pays for the
    plans it uses."""

    def __init__(self, cube: DataFrame, years: list[int], wanted: Mapping[str, ExtractRecipe]):
        self._cube, self._years, self._recipes = cube, years, wanted
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = wide_extract(self._cube, self._recipes[name], self._years)
        return self._built[name]

    def __iter__(self):
        return iter(self._recipes)

    def __len__(self) -> int:
        return len(self._recipes)

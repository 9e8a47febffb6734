"""Wide yearly extracts derived from the TPC-H style input tables.

The pipeline's real inputs are wide statistical extracts (dimension columns
plus one nullable double column per year).  The test tables have none, so
each of the seven extracts is derived from
``lineitem ⋈ orders ⋈ customer ⋈ nation`` with a fixed mapping of
TPC-H attributes to indicator dimensions (see FIXTURES.md, part B).

This derivation is the only step whose work grows with the input, so it is
planned for scale:

1. ``lineitem`` is aggregated to one row per (order, return flag, line
   status), and for order counts to its distinct orders, *before* any join,
   each only where an extract needs it.  The partial aggregates run map-side,
   so the shuffle carries a few rows per order, and an order holding a third of
   all lines collapses to at most seven rows.
2. Order attributes come from ``orders ⋈ customer ⋈ nation`` without hints:
   a side is broadcast only when its size estimate (file statistics, or the
   runtime size AQE measures) is under the threshold; otherwise the join is a
   sort-merge join whose skewed partitions (a hot customer) AQE splits.
3. The joined rows are rolled up to a *measure cube* keyed by every dimension
   any extract needs.  Its size is bounded by the dimension domains (nations x
   years x flags x statuses x priorities x segments), not by the data, and all
   seven extracts are cheap projections of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.contracts import ALL_SECTORS, TOTAL_ECONOMY, WORKING_AGE
from panelforge.sources.tables import read_source

CUBE_DIMENSIONS = ("country", "year", "o_orderstatus", "o_orderpriority", "c_mktsegment",
                   "l_returnflag", "l_linestatus")


# Measures of the cube: per order from its lines, and summed up over orders.
MEASURES = {
    "qty_sum": ("sum(l_quantity)", "sum(qty_sum)"),
    "qty_n": ("count(l_quantity)", "sum(qty_n)"),
    "qty_max": ("max(l_quantity)", "max(qty_max)"),
    "linenumber_sum": ("sum(l_linenumber)", "sum(linenumber_sum)"),
    "linenumber_n": ("count(l_linenumber)", "sum(linenumber_n)"),
}


def line_cells(lineitem: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Per order one row per (return flag, line status)."""
    return lineitem.groupBy("l_orderkey", "l_returnflag", "l_linestatus").agg(
        *[F.expr(MEASURES[m][0]).alias(m) for m in measures]).withColumn("level", F.lit("line"))


def order_cells(lineitem: DataFrame) -> DataFrame:
    """One row per order with lines: the cube counts distinct orders at any coarser grain."""
    return lineitem.select("l_orderkey").distinct().withColumn("level", F.lit("order"))


def order_attributes(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One row per order with its country, year and order-level dimensions."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                      F.year("o_orderdate").cast("bigint").alias("year")).filter(
        F.col("year").isNotNull())
    # customers meet their nation first, so that no order is ever dealt by a nation key
    n = nation.select("n_nationkey", F.col("n_name").alias("country"))
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment").join(
        n, F.col("c_nationkey") == F.col("n_nationkey"))
    return (o.join(c, o.o_custkey == c.c_custkey)
            .select("o_orderkey", "country", "year", "o_orderstatus", "o_orderpriority",
                    "c_mktsegment"))


def measure_cube(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                 nation: DataFrame, wanted: Iterable["ExtractRecipe"]) -> DataFrame:
    """The measures that ``wanted`` need, keyed by ``CUBE_DIMENSIONS`` and ``level``."""
    wanted = list(wanted)
    levels = {r.level for r in wanted}
    measures = [m for m in MEASURES if any(m in r.cell for r in wanted)]
    if levels == {"order"}:
        cells = order_cells(lineitem)
    elif levels == {"line"}:
        cells = line_cells(lineitem, measures)
    else:
        cells = line_cells(lineitem, measures).unionByName(order_cells(lineitem),
                                                           allowMissingColumns=True)
    attrs = order_attributes(orders, customer, nation)
    joined = cells.join(attrs, cells.l_orderkey == attrs.o_orderkey)
    keys = [k for k in CUBE_DIMENSIONS if k in joined.columns]
    return joined.groupBy(*keys, "level").agg(
        *[F.expr(MEASURES[m][1]).alias(m) for m in measures],
        F.count(F.lit(1)).alias("orders"))


def read_cube(spark: SparkSession, base: str, wanted: Iterable["ExtractRecipe"]) -> DataFrame:
    return measure_cube(
        read_source(spark, base, "lineitem"),
        read_source(spark, base, "orders"),
        read_source(spark, base, "customer"),
        read_source(spark, base, "nation"),
        wanted,
    )


# --- dimension mappings (FIXTURES.md part B) -------------------------------
# Written as SQL expressions: each is parsed once on the JVM side, instead of
# one Python-to-JVM call per column operator.

SEX = ("CASE l_returnflag WHEN 'A' THEN 'M' WHEN 'R' THEN 'F' WHEN 'N' THEN 'T' "
       "ELSE l_returnflag END")
MARRIAGE_INDICATOR = ("CASE l_returnflag WHEN 'A' THEN 'MAGEMAR1' WHEN 'R' THEN 'FAGEMAR1' "
                      "WHEN 'N' THEN 'OTHER' ELSE l_returnflag END")
AGE = f"CASE WHEN o_orderpriority = '3-MEDIUM' THEN '{WORKING_AGE}' ELSE o_orderpriority END"


def _sector(building_as: str) -> str:
    return f"CASE WHEN c_mktsegment = 'BUILDING' THEN '{building_as}' ELSE c_mktsegment END"


# Cell aggregates over the cube rows for which ``{keep}`` holds.
def _ratio(total: str, count: str) -> str:
    return f"sum(CASE WHEN {{keep}} THEN {total} END) / sum(CASE WHEN {{keep}} THEN {count} END)"


def _sum(measure: str, scale: float = 1.0) -> str:
    cell = f"sum(CASE WHEN {{keep}} THEN {measure} END)"
    return cell if scale == 1.0 else f"{cell} / {scale!r}D"


def _max(measure: str) -> str:
    return f"max(CASE WHEN {{keep}} THEN {measure} END)"


@dataclass(frozen=True)
class ExtractRecipe:
    """How one wide extract is cut from the cube (SQL expressions over its columns)."""

    level: str                              # which cube rows: "line" or "order"
    dimensions: tuple[tuple[str, str], ...]  # (id column, expression), in extract order
    cell: str                               # aggregate with a ``{keep}`` row condition
    where: str | None = None


def recipes(pay_gap_unit_from_status: bool = False) -> dict[str, ExtractRecipe]:
    """The seven recipes.  ``pay_gap_unit_from_status`` gives the pay-gap
    extract a second unit, which duplicates every (country, year) key."""
    freq = ("freq", "'A'")
    country = ("country", "country")
    orders_per_10 = _sum("orders", 10.0)
    pay_unit = "l_linestatus" if pay_gap_unit_from_status else "'PC'"
    return {
        "marriage_rate": ExtractRecipe(
            "order", (freq, ("indic_de", "'RATE'"), country), orders_per_10),
        "divorce_rate": ExtractRecipe(
            "order", (freq, ("indic_de", "'RATE'"), country), orders_per_10,
            where="o_orderstatus = 'P'"),
        "age_at_marriage": ExtractRecipe(
            "line", (freq, ("indic_de", MARRIAGE_INDICATOR), country),
            _ratio("qty_sum", "qty_n")),
        "gender_pay_gap": ExtractRecipe(
            "line", (freq, ("unit", pay_unit), ("nace_r2", _sector(TOTAL_ECONOMY)), country),
            _ratio("linenumber_sum", "linenumber_n")),
        "hours_worked": ExtractRecipe(
            "line", (freq, ("nace_r2", _sector(ALL_SECTORS)), ("wstatus", "o_orderstatus"),
                     ("worktime", "l_linestatus"), ("age", AGE), ("sex", SEX),
                     ("unit", "'HR'"), country),
            _max("qty_max")),
        "accidents": ExtractRecipe(
            "line", (freq, ("unit", "l_linestatus"), ("nace_r2", _sector(ALL_SECTORS)),
                     ("sex", SEX), country),
            _sum("qty_sum")),
        "employed": ExtractRecipe(
            "line", (freq, ("unit", "l_linestatus"), ("sex", SEX), ("age", AGE),
                     ("nace_r2", _sector(ALL_SECTORS)), country),
            _sum("qty_sum")),
    }


def year_column_name(year: int) -> str:
    """Column name of a year in a wide extract: odd years carry the ``_``
    prefix some warehouses add to numeric names, even years do not."""
    return f"_{year}" if year % 2 else str(year)


def wide_extract(cube: DataFrame, recipe: ExtractRecipe, years: Sequence[int]) -> DataFrame:
    """One row per combination of id columns, one column per year.

    A single aggregate with one conditional measure per year (a pivot with a
    known value list, in one shuffle).  A year without rows is null; a measured
    zero stays.
    """
    keep = f"level = '{recipe.level}'" + (f" AND ({recipe.where})" if recipe.where else "")
    dims = [F.expr(expr).alias(name) for name, expr in recipe.dimensions]
    cells = [F.expr(f"CAST({recipe.cell.format(keep=f'year = {y}')} AS DOUBLE)")
             .alias(year_column_name(y)) for y in years]
    return cube.filter(keep).groupBy(*dims).agg(*cells)


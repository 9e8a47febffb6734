"""Dataset specifications and table contracts.

A dataset is a row of configuration, not a class hierarchy: which columns of
the wide extract are dimensions, which dimension codes to keep, what the load
table looks like and how staging reduces it to one row per (country, year).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
                               TimestampNTZType)

KEYS = ("country", "year")

# Names, dimension codes and column lists that must equal the
# reference pipeline's so the tables carry the same meaning.
GEO_COLUMN = "geo\\TIME_PERIOD"
YEAR_COLUMN_PATTERN = r"^_?\d{4}$"
SEX_CODES = ("M", "F")
TOTAL_ECONOMY = "B-S_X_O"
ALL_SECTORS = "TOTAL"
WORKING_AGE = "Y15-74"
FEMALE_MARRIAGE_AGE = "FAGEMAR1"
MALE_MARRIAGE_AGE = "MAGEMAR1"


@dataclass(frozen=True)
class Pivot:
    """Staging rule: one column per category by conditional aggregation."""

    dimension: str
    function: str                      # "avg" or "sum"
    columns: tuple[tuple[str, str], ...]  # (output column, dimension code), in contract order
    delta: tuple[str, str, str] | None = None  # (output, minuend, subtrahend)


@dataclass(frozen=True)
class Dataset:
    name: str
    id_columns: tuple[str, ...]
    filters: tuple[tuple[str, tuple[str, ...]], ...]
    load_columns: tuple[str, ...]
    staging: Pivot | None = None       # None: passthrough of (country, year, value)
    value: str = field(default="")

    @property
    def value_column(self) -> str:
        return self.value or self.name


# The seven extracts, their dimension columns, filters and
# staging rules, as the reference defines them.
DATASETS: dict[str, Dataset] = {
    "marriage_rate": Dataset(
        name="marriage_rate",
        id_columns=("freq", "indic_de", "country"),
        filters=(),
        load_columns=("country", "year", "marriage_rate"),
    ),
    "divorce_rate": Dataset(
        name="divorce_rate",
        id_columns=("freq", "indic_de", "country"),
        filters=(),
        load_columns=("country", "year", "divorce_rate"),
    ),
    "age_at_marriage": Dataset(
        name="age_at_marriage",
        id_columns=("freq", "indic_de", "country"),
        filters=(),
        load_columns=("indic_de", "country", "year", "age_at_marriage"),
        staging=Pivot("indic_de", "avg", (("age_at_marriage_f", FEMALE_MARRIAGE_AGE),
                                          ("age_at_marriage_m", MALE_MARRIAGE_AGE))),
    ),
    "gender_pay_gap": Dataset(
        name="gender_pay_gap",
        id_columns=("freq", "unit", "nace_r2", "country"),
        filters=(("nace_r2", (TOTAL_ECONOMY,)),),
        load_columns=("country", "year", "gender_pay_gap"),
    ),
    "hours_worked": Dataset(
        name="hours_worked",
        id_columns=("freq", "nace_r2", "wstatus", "worktime", "age", "sex", "unit", "country"),
        filters=(("sex", SEX_CODES),),
        load_columns=("country", "year", "sex", "hours_worked"),
        staging=Pivot("sex", "avg", (("hours_worked_m", "M"), ("hours_worked_f", "F")),
                      delta=("hours_worked_delta", "hours_worked_m", "hours_worked_f")),
    ),
    "accidents": Dataset(
        name="accidents",
        id_columns=("freq", "unit", "nace_r2", "sex", "country"),
        filters=(("sex", SEX_CODES), ("nace_r2", (ALL_SECTORS,))),
        load_columns=("country", "year", "sex", "accidents"),
        staging=Pivot("sex", "sum", (("accidents_m", "M"), ("accidents_f", "F"))),
    ),
    "employed": Dataset(
        name="employed",
        id_columns=("freq", "unit", "sex", "age", "nace_r2", "country"),
        filters=(("sex", SEX_CODES), ("age", (WORKING_AGE,)), ("nace_r2", (ALL_SECTORS,))),
        load_columns=("country", "year", "sex", "employed"),
        staging=Pivot("sex", "avg", (("employed_m", "M"), ("employed_f", "F"))),
    ),
}


@dataclass(frozen=True)
class Analytics:
    name: str
    anchor: str
    joined: tuple[str, ...]


# The two final tables, their anchor and join order.
ANALYTICS: dict[str, Analytics] = {
    "relationships": Analytics("relationships", "marriage_rate",
                               ("divorce_rate", "age_at_marriage", "gender_pay_gap")),
    "gender_gap": Analytics("gender_gap", "hours_worked",
                            ("gender_pay_gap", "accidents", "employed")),
}


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


_S, _L, _D, _DT = StringType(), LongType(), DoubleType(), DateType()

# Declared staging and analytics schemas (all columns nullable).
STAGING_SCHEMAS: dict[str, StructType] = {
    "marriage_rate": _schema(("country", _S), ("year", _L), ("marriage_rate", _D)),
    "divorce_rate": _schema(("country", _S), ("year", _L), ("divorce_rate", _D)),
    "age_at_marriage": _schema(("country", _S), ("year", _L), ("age_at_marriage_f", _D),
                               ("age_at_marriage_m", _D)),
    "gender_pay_gap": _schema(("country", _S), ("year", _L), ("gender_pay_gap", _D)),
    "hours_worked": _schema(("country", _S), ("year", _L), ("hours_worked_m", _D),
                            ("hours_worked_f", _D), ("hours_worked_delta", _D)),
    "accidents": _schema(("country", _S), ("year", _L), ("accidents_m", _D), ("accidents_f", _D)),
    "employed": _schema(("country", _S), ("year", _L), ("employed_m", _D), ("employed_f", _D)),
}

ANALYTICS_SCHEMAS: dict[str, StructType] = {
    "relationships": _schema(("year_date", _DT), ("country", _S), ("year", _L),
                             ("marriage_rate", _D), ("divorce_rate", _D),
                             ("age_at_marriage_f", _D), ("age_at_marriage_m", _D),
                             ("gender_pay_gap", _D)),
    "gender_gap": _schema(("year_date", _DT), ("country", _S), ("year", _L),
                          ("hours_worked_m", _D), ("hours_worked_f", _D),
                          ("hours_worked_delta", _D), ("gender_pay_gap", _D),
                          ("accidents_m", _D), ("accidents_f", _D),
                          ("employed_m", _D), ("employed_f", _D)),
}


_I, _T = IntegerType(), TimestampNTZType()

# The columns of the input tables that the extracts are derived from.
SOURCE_SCHEMAS: dict[str, StructType] = {
    "lineitem": _schema(("l_orderkey", _L), ("l_linenumber", _I), ("l_quantity", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_orderpriority", _S),
                      ("o_orderdate", _T)),
    "customer": _schema(("c_custkey", _L), ("c_nationkey", _I), ("c_mktsegment", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S)),
}


def load_schema(dataset: Dataset) -> StructType:
    types = {"country": _S, "year": _L, "sex": _S, "indic_de": _S}
    return _schema(*[(c, types.get(c, _D)) for c in dataset.load_columns])

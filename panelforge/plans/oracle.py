"""DuckDB SQL for every registered query: the independent check.

The driver registers the input tables as views and runs these strings next to
the Spark queries.  They are written straight from the definitions (base
join, FIXTURES.md mapping, staging and analytics rules), not from the
Spark plans: the load tables come from a plain GROUP BY over the joined rows,
not from the measure cube.
"""

from __future__ import annotations

_BASE = """
base AS (
  SELECT n.n_name AS country, CAST(year(o.o_orderdate) AS BIGINT) AS year,
         o.o_orderkey, o.o_orderstatus, o.o_orderpriority, c.c_mktsegment,
         l.l_returnflag, l.l_linestatus, l.l_quantity, l.l_linenumber
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  WHERE o.o_orderdate IS NOT NULL
),
mapped AS (
  SELECT *,
    CASE l_returnflag WHEN 'A' THEN 'M' WHEN 'R' THEN 'F' WHEN 'N' THEN 'T'
         ELSE l_returnflag END AS sex,
    CASE l_returnflag WHEN 'A' THEN 'MAGEMAR1' WHEN 'R' THEN 'FAGEMAR1' WHEN 'N' THEN 'OTHER'
         ELSE l_returnflag END AS indic_age,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'TOTAL' ELSE c_mktsegment END AS nace_total,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'B-S_X_O' ELSE c_mktsegment END AS nace_pay,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'Y15-74' ELSE o_orderpriority END AS age
  FROM base
)"""

# Cells of each wide extract, long form: (ids..., year, cell).
_CELLS = {
    "marriage_rate": """
  SELECT 'A' AS freq, 'RATE' AS indic_de, country, year,
         CAST(count(DISTINCT o_orderkey) AS DOUBLE) / 10.0 AS cell
  FROM mapped GROUP BY country, year""",
    "divorce_rate": """
  SELECT 'A' AS freq, 'RATE' AS indic_de, country, year,
         CAST(count(DISTINCT o_orderkey) AS DOUBLE) / 10.0 AS cell
  FROM mapped WHERE o_orderstatus = 'P' GROUP BY country, year""",
    "age_at_marriage": """
  SELECT 'A' AS freq, indic_age AS indic_de, country, year,
         sum(l_quantity) / count(l_quantity) AS cell
  FROM mapped GROUP BY indic_age, country, year""",
    "gender_pay_gap": """
  SELECT 'A' AS freq, {pay_unit} AS unit, nace_pay AS nace_r2, country, year,
         CAST(sum(l_linenumber) AS DOUBLE) / count(l_linenumber) AS cell
  FROM mapped GROUP BY {pay_unit}, nace_pay, country, year""",
    "hours_worked": """
  SELECT 'A' AS freq, nace_total AS nace_r2, o_orderstatus AS wstatus, l_linestatus AS worktime,
         age, sex, 'HR' AS unit, country, year, max(l_quantity) AS cell
  FROM mapped GROUP BY nace_total, o_orderstatus, l_linestatus, age, sex, country, year""",
    "accidents": """
  SELECT 'A' AS freq, l_linestatus AS unit, nace_total AS nace_r2, sex, country, year,
         sum(l_quantity) AS cell
  FROM mapped GROUP BY l_linestatus, nace_total, sex, country, year""",
    "employed": """
  SELECT 'A' AS freq, l_linestatus AS unit, sex, age, nace_total AS nace_r2, country, year,
         sum(l_quantity) AS cell
  FROM mapped GROUP BY l_linestatus, sex, age, nace_total, country, year""",
}

_IDS = {
    "marriage_rate": "freq, indic_de, country",
    "divorce_rate": "freq, indic_de, country",
    "age_at_marriage": "freq, indic_de, country",
    "gender_pay_gap": "freq, unit, nace_r2, country",
    "hours_worked": "freq, nace_r2, wstatus, worktime, age, sex, unit, country",
    "accidents": "freq, unit, nace_r2, sex, country",
    "employed": "freq, unit, sex, age, nace_r2, country",
}

# Load tables: kept cells, filtered and projected.
_LOAD = {
    "marriage_rate": ("SELECT country, year, cell AS marriage_rate FROM cells_{n} "
                      "WHERE cell IS NOT NULL"),
    "divorce_rate": ("SELECT country, year, cell AS divorce_rate FROM cells_{n} "
                     "WHERE cell IS NOT NULL"),
    "age_at_marriage": ("SELECT indic_de, country, year, cell AS age_at_marriage FROM cells_{n} "
                        "WHERE cell IS NOT NULL"),
    "gender_pay_gap": ("SELECT country, year, cell AS gender_pay_gap FROM cells_{n} "
                       "WHERE nace_r2 = 'B-S_X_O' AND cell IS NOT NULL"),
    "hours_worked": ("SELECT country, year, sex, cell AS hours_worked FROM cells_{n} "
                     "WHERE sex IN ('M', 'F') AND cell IS NOT NULL"),
    "accidents": ("SELECT country, year, sex, cell AS accidents FROM cells_{n} "
                  "WHERE sex IN ('M', 'F') AND nace_r2 = 'TOTAL' AND cell IS NOT NULL"),
    "employed": ("SELECT country, year, sex, cell AS employed FROM cells_{n} "
                 "WHERE sex IN ('M', 'F') AND age = 'Y15-74' AND nace_r2 = 'TOTAL' "
                 "AND cell IS NOT NULL"),
}

def _by_category(load: str, value: str, aggregate: str, category: str, codes: dict[str, str]) -> str:
    """One aggregate per category code, each a table of its own, put side by side on the keys."""
    keys = f"SELECT DISTINCT country, year FROM {load}"
    columns = ", ".join(f"{name}.v AS {value}_{name}" for name in codes)
    joins = " ".join(
        f"LEFT JOIN (SELECT country, year, {aggregate}({value}) AS v FROM {load} "
        f"WHERE {category} = '{code}' GROUP BY country, year) AS {name} USING (country, year)"
        for name, code in codes.items())
    return f"SELECT country, year, {columns} FROM ({keys}) {joins}"


_SEXES = {"m": "M", "f": "F"}

# Staging, from the definitions: single indicators pass; categories become columns.
_STAGE = {n: f"SELECT country, year, {n} FROM load_{n}"
          for n in ("marriage_rate", "divorce_rate", "gender_pay_gap")}
_STAGE |= {
    "age_at_marriage": _by_category("load_age_at_marriage", "age_at_marriage", "avg", "indic_de",
                                    {"f": "FAGEMAR1", "m": "MAGEMAR1"}),
    "hours_worked": "SELECT *, hours_worked_m - hours_worked_f AS hours_worked_delta FROM ("
                    + _by_category("load_hours_worked", "hours_worked", "avg", "sex", _SEXES) + ")",
    "accidents": _by_category("load_accidents", "accidents", "sum", "sex", _SEXES),
    "employed": _by_category("load_employed", "employed", "avg", "sex", _SEXES),
}


def _final(inputs: tuple[str, ...]) -> str:
    """The first table's keys and every table's columns, with the period's last day."""
    joined = " ".join(f"LEFT JOIN stg_{n} USING (country, year)" for n in inputs[1:])
    return (f"SELECT last_day(make_date(year::INTEGER, 12, 1)) AS year_date, * "
            f"FROM stg_{inputs[0]} {joined}")


_FINAL_INPUTS = {
    "relationships": ("marriage_rate", "divorce_rate", "age_at_marriage", "gender_pay_gap"),
    "gender_gap": ("hours_worked", "gender_pay_gap", "accidents", "employed"),
}


def with_tables(body: str, datasets=(), stage=(), finals=(), pay_gap_fanout: bool = False,
                extra: str = "") -> str:
    """``WITH`` clause defining the cells, load and staging tables needed, then ``body``."""
    datasets = list(dict.fromkeys([*datasets, *stage,
                                   *[d for f in finals for d in _FINAL_INPUTS[f]]]))
    stage = list(dict.fromkeys([*stage, *[d for f in finals for d in _FINAL_INPUTS[f]]]))
    pay_unit = "l_linestatus" if pay_gap_fanout else "'PC'"
    ctes = [_BASE.strip()]
    for n in datasets:
        ctes.append(f"cells_{n} AS ({_CELLS[n].format(pay_unit=pay_unit)}\n)")
        ctes.append(f"load_{n} AS ({_LOAD[n].format(n=n)})")
    for n in stage:
        ctes.append(f"stg_{n} AS ({_STAGE[n]})")
    for f in finals:
        ctes.append(f"final_{f} AS ({_final(_FINAL_INPUTS[f])})")
    if extra:
        ctes.append(extra.strip())
    return "WITH " + ",\n".join(ctes) + "\n" + body.strip()


YEARS = range(1995, 2002)  # of the test tables (FIXTURES.md)


def wide(name: str) -> str:
    """A wide extract: one conditional aggregate per year, labelled as the extract labels it."""
    cells = ", ".join(f"max(cell) FILTER (WHERE year = {y}) AS \"{'_' if y % 2 else ''}{y}\"" for y in YEARS)
    return with_tables(f"SELECT {_IDS[name]}, {cells} FROM cells_{name} GROUP BY {_IDS[name]}", datasets=[name])


def ids(name: str) -> str:
    return _IDS[name]


_DATASETS = ("marriage_rate", "divorce_rate", "age_at_marriage", "gender_pay_gap",
             "hours_worked", "accidents", "employed")

_GG_COLS = ("year_date", "country", "year", "hours_worked_m", "hours_worked_f",
            "hours_worked_delta", "gender_pay_gap", "accidents_m", "accidents_f",
            "employed_m", "employed_f")


def _stack(table: str, columns, expr: str, check: str) -> str:
    parts = [f"SELECT '{check}' AS \"check\", '{c}' AS column_name, "
             f"CAST({expr.format(c=c)} AS BIGINT) AS violations FROM {table}" for c in columns]
    return "\nUNION ALL\n".join(parts)


def _first_last(table: str, gap: str) -> str:
    return f"""
    SELECT country, min(year) AS first_year, max(year) AS last_year,
           arg_min(gap, year) AS gap_first, arg_max(gap, year) AS gap_last,
           round(CASE WHEN isnan(regr_slope(gap, CAST(year AS DOUBLE))) THEN NULL
                      ELSE regr_slope(gap, CAST(year AS DOUBLE)) END, 6) AS gap_slope
    FROM (SELECT country, year, {gap} AS gap FROM {table}) WHERE gap IS NOT NULL
    GROUP BY country"""


def _corr(y: str, x: str) -> str:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    return (f"round(covar_pop({y}, {x}) FILTER (WHERE {both}) / "
            f"NULLIF(stddev_pop({y}) FILTER (WHERE {both}) * "
            f"stddev_pop({x}) FILTER (WHERE {both}), 0), 6)")


def _change(table: str, value: str) -> str:
    """Change against the row of the year before, if there is one."""
    return (f"(SELECT now.country, now.year, now.v - past.v AS change "
            f"FROM (SELECT country, year, {value} AS v FROM {table}) now "
            f"LEFT JOIN (SELECT country, year + 1 AS year, {value} AS v FROM {table}) past "
            f"USING (country, year))")


def _check_report(table: str, label: str, not_null=(), unique=(), non_negative=()) -> str:
    parts = [f"SELECT '{label}' AS table_name, 'not_null' AS \"check\", '{c}' AS column_name, "
             f"CAST(count(*) - count({c}) AS BIGINT) AS violations FROM {table}" for c in not_null]
    parts += [f"SELECT '{label}' AS table_name, 'non_negative' AS \"check\", '{c}' AS column_name, "
              f"CAST(count(*) FILTER (WHERE {c} < 0) AS BIGINT) AS violations FROM {table}"
              for c in non_negative]
    if unique:
        keys = ", ".join(unique)
        parts.append(f"SELECT '{label}' AS table_name, 'unique' AS \"check\", '{','.join(unique)}' "
                     f"AS column_name, CAST(count(*) AS BIGINT) AS violations FROM "
                     f"(SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1)")
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    for n in _DATASETS:
        q[f"extract_{n}"] = wide(n)
        q[f"load_{n}"] = with_tables(f"SELECT * FROM load_{n}", datasets=[n])
        q[f"stg_{n}"] = with_tables(f"SELECT * FROM stg_{n}", stage=[n])
    q["relationships"] = with_tables("SELECT * FROM final_relationships", finals=["relationships"])
    q["gender_gap"] = with_tables("SELECT * FROM final_gender_gap", finals=["gender_gap"])
    q["relationships_local"] = with_tables(
        "SELECT * EXCLUDE (year_date) FROM final_relationships ORDER BY country, year",
        finals=["relationships"])
    q["gender_gap_local"] = with_tables(
        "SELECT * EXCLUDE (year_date) FROM final_gender_gap ORDER BY country, year",
        finals=["gender_gap"])
    q["join_fanout"] = with_tables("SELECT * FROM final_gender_gap", finals=["gender_gap"],
                                   pay_gap_fanout=True)
    q["unpivot_sql"] = with_tables(
        "SELECT country, year, cell AS marriage_rate FROM cells_marriage_rate WHERE cell IS NOT NULL",
        datasets=["marriage_rate"])
    q["unpivot_fused"] = with_tables(
        """SELECT country, year, avg(cell) FILTER (WHERE sex = 'F') AS hours_worked_f,
                  avg(cell) FILTER (WHERE sex = 'M') AS hours_worked_m
           FROM cells_hours_worked WHERE sex IN ('F', 'M') AND cell IS NOT NULL GROUP BY country, year""",
        datasets=["hours_worked"])
    q["unpivot_pruned_years"] = with_tables(
        "SELECT * FROM load_hours_worked WHERE year BETWEEN 1996 AND 1999",
        datasets=["hours_worked"])
    q["pivot_generic"] = with_tables(
        "SELECT country, year, hours_worked_m, hours_worked_f FROM stg_hours_worked",
        stage=["hours_worked"])
    q["self_join_split"] = q["pivot_generic"]
    q["land_wide_roundtrip"] = with_tables("SELECT * FROM load_accidents", datasets=["accidents"])
    q["replace_sink"] = with_tables("SELECT * FROM stg_hours_worked", stage=["hours_worked"])
    upsert = with_tables(
        """SELECT * FROM final_relationships t
           WHERE t.year <= 1999 AND NOT EXISTS (
             SELECT 1 FROM final_relationships s
             WHERE s.year >= 1998 AND s.country = t.country AND s.year = t.year)
           UNION ALL
           SELECT year_date, country, year, marriage_rate + 1.0 AS marriage_rate, divorce_rate,
                  age_at_marriage_f, age_at_marriage_m, gender_pay_gap
           FROM final_relationships WHERE year >= 1998""",
        finals=["relationships"])
    q["upsert_sink"] = upsert
    q["upsert_idempotent"] = q["upsert_partitions"] = upsert
    q["partitioned_sink"] = q["relationships"]
    q["refresh_local"] = q["relationships_local"]
    q["refresh_cloud"] = q["refresh_from_landed"] = q["gender_gap"]
    q["refresh_halting"] = q["stg_employed"]
    q["catalog_roundtrip"] = q["stg_hours_worked"]
    q["bucketed_relationships"] = q["relationships_sql"] = q["relationships"]
    q["bucketed_gender_gap"] = q["gender_gap_sql"] = q["gender_gap"]
    q["pruned_read"] = with_tables(
        """SELECT * FROM final_relationships
           WHERE year_date BETWEEN DATE '1996-12-31' AND DATE '1999-12-31'
             AND country IN ('NATION_1', 'NATION_7', 'NATION_19')""",
        finals=["relationships"])
    q["clustered_catalog"] = q["pruned_read"]
    q["check_not_null"] = with_tables(
        _stack("final_gender_gap", _GG_COLS, "count(*) - count({c})", "not_null"),
        finals=["gender_gap"])
    q["check_unique"] = with_tables(
        """SELECT country, year, count(*) AS rows FROM stg_gender_pay_gap
           GROUP BY country, year HAVING count(*) > 1""",
        stage=["gender_pay_gap"], pay_gap_fanout=True)
    q["check_non_negative"] = with_tables(
        _stack("final_gender_gap", ("hours_worked_m", "hours_worked_f", "accidents_m",
                                    "accidents_f", "employed_m", "employed_f"),
               "count(*) FILTER (WHERE {c} < 0)", "non_negative"),
        finals=["gender_gap"])
    load_cols = {"marriage_rate": ("country", "year", "marriage_rate"),
                 "divorce_rate": ("country", "year", "divorce_rate"),
                 "age_at_marriage": ("indic_de", "country", "year", "age_at_marriage"),
                 "gender_pay_gap": ("country", "year", "gender_pay_gap"),
                 "hours_worked": ("country", "year", "sex", "hours_worked"),
                 "accidents": ("country", "year", "sex", "accidents"),
                 "employed": ("country", "year", "sex", "employed")}
    q["check_load"] = with_tables(
        "\nUNION ALL\n".join(_check_report(f"load_{n}", n, not_null=load_cols[n])
                              for n in _DATASETS),
        datasets=list(_DATASETS))
    signed = ("hours_worked", "accidents", "employed")
    q["check_staging"] = with_tables(
        "\nUNION ALL\n".join(
            _check_report(f"stg_{n}", n, not_null=("country", "year", *([n] if n.endswith("e_rate") else [])),
                          unique=("country", "year"),
                          non_negative=(f"{n}_m", f"{n}_f") if n in signed else ()) for n in _DATASETS),
        stage=list(_DATASETS))
    q["check_analytics"] = with_tables(
        _check_report("final_relationships", "relationships",
                      not_null=("country", "year_date", "gender_pay_gap", "age_at_marriage_f",
                                "age_at_marriage_m"), unique=("country", "year_date"))
        + "\nUNION ALL\n"
        + _check_report("final_gender_gap", "gender_gap",
                        not_null=("country", "year_date", "hours_worked_delta"),
                        unique=("country", "year_date"),
                        non_negative=("hours_worked_m", "hours_worked_f")),
        finals=["relationships", "gender_gap"])
    q["write_staging_checked"], q["write_analytics_checked"] = q["check_staging"], q["check_analytics"]
    dims = ("freq", "nace_r2", "wstatus", "worktime", "age", "sex", "unit")
    q["domain_profile"] = with_tables(
        "\nUNION ALL\n".join(
            f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, count(*) AS rows "
            f"FROM wide_rows GROUP BY {d}" for d in dims),
        datasets=["hours_worked"],
        extra=f"wide_rows AS (SELECT DISTINCT {ids('hours_worked')} FROM cells_hours_worked)")
    q["preview"] = with_tables(
        "SELECT * FROM final_relationships ORDER BY country, year LIMIT 10",
        finals=["relationships"])
    q["pay_gap_trend"] = with_tables(
        """SELECT country, count(*) AS years,
                  arg_min(gender_pay_gap, year) AS gap_first,
                  arg_max(gender_pay_gap, year) AS gap_last,
                  round(CASE WHEN isnan(regr_slope(gender_pay_gap, CAST(year AS DOUBLE))) THEN NULL
                        ELSE regr_slope(gender_pay_gap, CAST(year AS DOUBLE)) END, 6) AS gap_slope
           FROM final_relationships WHERE gender_pay_gap IS NOT NULL GROUP BY country""",
        finals=["relationships"])
    q["age_gap_convergence"] = with_tables(
        f"""SELECT *, gap_last - gap_first AS gap_change,
                   abs(gap_last) < abs(gap_first) AS converging
            FROM ({_first_last('final_relationships', 'age_at_marriage_m - age_at_marriage_f')})""",
        finals=["relationships"])
    q["employment_gap_reduction"] = with_tables(
        f"""SELECT *, 1.0 - gap_last / NULLIF(gap_first, 0) AS reduction
            FROM ({_first_last('final_gender_gap', 'employed_m - employed_f')})""",
        finals=["gender_gap"])
    q["accident_share"] = with_tables(
        """SELECT country, year,
                  accidents_m / NULLIF(accidents_m + accidents_f, 0) AS male_share,
                  accidents_m / NULLIF(accidents_f, 0) AS male_to_female
           FROM final_gender_gap""",
        finals=["gender_gap"])
    q["divorce_marriage_ratio"] = with_tables(
        """SELECT country, year, divorce_rate / NULLIF(marriage_rate, 0) AS divorce_to_marriage
           FROM final_relationships""",
        finals=["relationships"])
    for key, by in (("hours_delta_profile", "country"), ("hours_delta_by_year", "year")):
        q[key] = with_tables(
            f"""SELECT {by}, count(hours_worked_delta) AS observations,
                      round(avg(hours_worked_delta), 9) AS delta_avg,
                      min(hours_worked_delta) AS delta_min, max(hours_worked_delta) AS delta_max
               FROM final_gender_gap GROUP BY {by}""",
            finals=["gender_gap"])
    for key, by in (("pay_gap_correlation", "year"), ("pay_gap_correlation_by_country", "country")):
        q[key] = with_tables(
            f"""SELECT {by}, count(*) AS observations,
                       {_corr('gender_pay_gap', 'marriage_rate')} AS corr_marriage,
                       {_corr('gender_pay_gap', 'divorce_rate')} AS corr_divorce
                FROM final_relationships GROUP BY {by}""",
            finals=["relationships"])
    moves = {"pay": "gender_pay_gap", "hours": "hours_worked_delta", "employed": "employed_m - employed_f",
             "accidents": "accidents_m - accidents_f"}
    joined = " JOIN ".join(
        f"(SELECT country, year, sign(change) AS d_{k} FROM {_change('final_gender_gap', v)})" + (
            " USING (country, year)" if k != "pay" else "") for k, v in moves.items())
    shares = ", ".join(
        f"avg((d_{k} = d_pay)::INT::DOUBLE) AS {k}_agree" for k in moves if k != "pay")
    q["gap_comovement"] = with_tables(
        f"SELECT country, count(d_pay) AS pay_changes, {shares} FROM {joined} GROUP BY country",
        finals=["gender_gap"])
    q["marriage_rate_drop"] = with_tables(
        f"""SELECT country, arg_min(year, (change, year)) FILTER (WHERE change < 0) AS drop_year,
                  min(change) FILTER (WHERE change < 0) AS "drop"
           FROM {_change('final_relationships', 'marriage_rate')} GROUP BY country""",
        finals=["relationships"])
    q["pay_gap_correlation_panel"] = with_tables(
        f"""SELECT count(*) AS observations,
                   {_corr('gender_pay_gap', 'marriage_rate')} AS corr_marriage,
                   {_corr('gender_pay_gap', 'divorce_rate')} AS corr_divorce
            FROM final_relationships""",
        finals=["relationships"])
    return q

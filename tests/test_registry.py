"""The driver contract: every registered query has an oracle, and names stay plain."""

import re

import __spark_entry__ as entry_mod
from panelforge.plans.oracle import oracle_sql
from panelforge.plans.registry import QUERIES


def test_every_query_has_oracle_sql():
    queries, oracle = entry_mod.queries(), oracle_sql()
    assert set(QUERIES) == set(oracle) and set(QUERIES) <= set(queries)
    assert all(isinstance(sql, str) and sql.strip() for sql in oracle.values())


def test_query_names():
    for name in QUERIES:
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
        assert "pipeline" not in name and not re.match(r"op\d+_", name)

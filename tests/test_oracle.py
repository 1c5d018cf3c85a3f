"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
import compare

SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, con, name):
    assert compare.differences(entry_module.queries()[name](spark, sf), con, SQL[name]) == []


def test_each_query_of_the_library_has_sql():
    assert set(SQL) <= set(entry_module.queries())
    assert {n for n in entry_module.queries() if n not in SQL} <= {n for n in entry_module.queries() if n.startswith("op") or n == "pipeline"}

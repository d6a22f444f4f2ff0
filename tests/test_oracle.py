"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os
from pathlib import Path

import oracle
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no tables")


@pytest.fixture(scope="module")
def database():
    con = oracle.database(SF_DIR)
    yield con
    con.close()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, database, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), SQL[name], database) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_without_sql(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0

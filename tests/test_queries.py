"""Every registered query against its SQL, on the small tables."""

import pytest
from compare import compare, connect
from conftest import SMALL

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    assert compare(spark, con, name, SMALL) == ""


def test_entry(spark):
    rows = {r["split"]: r["n_docs"] for r in entry(spark).collect()}
    assert rows == {"train": 199, "val": 1}


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())

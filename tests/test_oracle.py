"""Every registered query against its SQL on another engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, oracle_rows, spark_rows
from tests.conftest import SF_DIR
from tidetable.plans import registry


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, con, name):
    got = spark_rows(entry.queries()[name](spark, SF_DIR))
    want = oracle_rows(con, entry.oracle_sql()[name])
    assert got == want and got[1]


def test_entry(spark):
    assert entry.entry(spark).columns == ["item_id", "w_start", "w_end", "views", "rank"]

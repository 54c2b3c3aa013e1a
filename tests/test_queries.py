"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest

from checks.compare import connect, difference
from checks.oracle import oracle_sql
from checks.registry import queries

@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, sf_dir, database, name):
    assert difference(queries()[name](spark, sf_dir), database, oracle_sql()[name]) is None


def test_entry_runs(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0

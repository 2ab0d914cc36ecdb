"""Every registered query against its SQL in another engine."""

import pytest

import __spark_entry__ as entry
from tools.check_queries import check, connect


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


# The corpus operators have tests of their own.
NAMES = [n for n, run in entry.queries().items() if run.__module__.startswith("chunkspark.plans")]


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, sf_dir, name):
    assert check(spark, db, sf_dir, name) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sum(r.row_count for r in rows) == 1_500 and all(r.used_bytes <= 4096 for r in rows)

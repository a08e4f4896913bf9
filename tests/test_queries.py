"""Every registered query against its SQL, and the driver's entry point."""

import pytest

import __spark_entry__ as entry
from frameweir.plans.oracle import ORACLE
from frameweir.plans.queries import QUERIES
from tools.check import compare


def test_entry(spark):
    table = entry.entry(spark)
    assert table.count() > 0
    assert table.columns[0] == "cameraId"


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, folder, name):
    outcome = compare(spark, folder, name)
    assert outcome.startswith(("ok", "rows")), outcome

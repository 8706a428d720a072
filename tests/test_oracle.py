"""Every registered query against its DuckDB statement, exactly."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_point  # noqa: E402
from tests.compare import differences  # noqa: E402

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES = entry_point.queries()
STATEMENTS = entry_point.oracle_sql()


def test_statements_belong_to_queries():
    assert STATEMENTS.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), SF_DIR, STATEMENTS[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - STATEMENTS.keys()))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0

"""Every registered query of this package, with its SQL statement where there is one."""

import os

import pytest

from farelake.llm import oracle, queries
from tests.compare import differences

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
STATEMENTS = oracle.statements()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches(spark, name):
    assert differences(queries.registry()[name](spark, SF_DIR), SF_DIR, STATEMENTS[name]) == []


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.registry()) == list(range(1, 14))

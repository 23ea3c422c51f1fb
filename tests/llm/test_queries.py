"""Registered queries against SQL on the smallest tables, plain versions elsewhere."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from roadpulse.llm import registry

ORACLES = registry.oracle_sql()


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, sf, name):
    assert differences(registry.queries()[name](spark, sf), connect(sf), ORACLES[name]) is None


def test_all_are_registered():
    names = entry_point.queries().keys()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in registry.queries()}
    assert registry.queries().keys() | {"pipeline"} <= names

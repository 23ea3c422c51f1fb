"""Every registered query against DuckDB on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
if entry_point.training_data:  # tested in tests/llm
    QUERIES = {n: q for n, q in QUERIES.items() if n not in entry_point.training_data.queries()}
    QUERIES.pop("pipeline")


def test_every_query_has_an_oracle():
    assert QUERIES.keys() <= ORACLES.keys()


def test_entry(spark, sf):
    assert entry_point.entry(spark).count() == 128


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, name):
    assert differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) is None


@pytest.mark.parametrize("name", ["avg_speed_telematics", "sliding_sum"])
def test_session_time_zone_does_not_matter(spark, sf, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert differences(QUERIES[name](spark, sf), connect(sf), ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

"""Every registered query against its DuckDB oracle (the driver's check) on sf0.001."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, duck

from .conftest import SF_SMALL

# the training-data queries are tested in tests/llm
QUERIES = {k: q for k, q in entry.queries().items() if k in entry.catalog.REGISTRY}
ORACLE = {k: q for k, q in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_builder_and_names_match():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 28


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_oracle(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF_SMALL)
    assert "MATCH" in result or "no oracle" in result, result


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "location_id"


def test_results_do_not_depend_on_session_zone(spark, con):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        for name in ("event_time", "kpi_3h", "csv_scan", "range_query", "stream_archive"):
            result = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF_SMALL)
            assert "MATCH" in result, result
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)

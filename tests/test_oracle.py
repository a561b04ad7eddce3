"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from factlake.plans import registry
from factlake.plans.bindings import TABLE_NAMES
from tests.conftest import SF_SMALL
from tools.oracle_compare import compare, register_views, type_mismatches

registry.load_all()
QUERIES = dict(registry.QUERIES)
ORACLE = dict(registry.ORACLE)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    register_views(c, SF_SMALL, TABLE_NAMES)
    yield c
    c.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert type_mismatches(df, con, ORACLE[name]) == []
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_entry_registers_them_all():
    assert set(QUERIES) <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "restatement_id" in df.columns


HOT_PATH_KEYS = ["restatement_event", "financials_current", "scd2_history", "content_change", "company_profile"]


@pytest.mark.parametrize("name", HOT_PATH_KEYS)
def test_hot_key_path_matches_oracle(spark, con, name):
    """Same answers when every multi-row key is routed through the range-partitioned path."""
    spark.conf.set("factlake.skew.hotKeyRows", "2")
    spark.conf.set("factlake.skew.sampleFraction", "1.0")
    try:
        ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    finally:
        spark.conf.unset("factlake.skew.hotKeyRows")
        spark.conf.unset("factlake.skew.sampleFraction")
    assert ok, f"{name}: {msg}"

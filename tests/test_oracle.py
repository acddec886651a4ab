"""Every registered query against its DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as E
from tessera.plans.oracle_compare import compare, duck_connect

from .conftest import SMALL_SF


@pytest.fixture(scope="module")
def con():
    return duck_connect(SMALL_SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL_SF)
    res = compare(df, con, E.oracle_sql()[name])
    assert res["rows_match"] and res["columns_match"] and res["hash_match"] and res["types_match"], res


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SMALL_SF).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "customer_id"


@pytest.mark.parametrize("name", ["log_parse", "gold_features", "latest_per_key", "error_alert",
                                  "ops_stream_windows", "schema_evolution_merge"])
def test_time_sensitive_queries_in_a_non_utc_session(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        res = compare(E.queries()[name](spark, SMALL_SF), con, E.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert res["hash_match"] and res["types_match"], res


@pytest.mark.parametrize("name", ["silver_cast_normalize", "quarantine_split", "contract_errors",
                                  "feature_reshape", "hash_split", "auc_rank"])
def test_cast_heavy_queries_with_ansi_off(spark, con, name):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        res = compare(E.queries()[name](spark, SMALL_SF), con, E.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert res["hash_match"] and res["types_match"], res

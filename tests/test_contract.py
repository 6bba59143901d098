"""Driver contract: entry() runs; every registered query equals its DuckDB oracle."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import duck, rows_of
from vaultline.plans import registry

QUERIES = registry.queries()
ORACLES = registry.oracle_sql()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["cohort_month", "cohort_size"]


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(E.queries())
    assert set(ORACLES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    pdf = QUERIES[name](spark, SF_SMALL).toPandas()
    if name not in ORACLES:
        assert len(pdf) > 0
        return
    c1, r1 = rows_of(pdf)
    c2, r2 = rows_of(con.sql(ORACLES[name]).df())
    assert c1 == c2
    assert r1 == r2


@pytest.mark.parametrize("name", ["cohort_one_pass", "hub_upsert", "history_append", "coerce_typed",
                                  "envelope_unwrap", "late_arrival_wins"])
def test_results_do_not_depend_on_session_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        pdf = QUERIES[name](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows_of(pdf) == rows_of(con.sql(ORACLES[name]).df())

"""Every named query against its SQL twin, on plain and on skewed data."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from conftest import PLAIN, comparable
from ledgerlark.plans import all_queries

NAMES = list(all_queries())
WITHOUT_SQL = set()


def check(query, spark, folder, oracle, rows_of) -> list[dict]:
    rows = rows_of(query.run(spark, folder))
    if query.sql is None:
        assert query.name in WITHOUT_SQL
    else:
        assert comparable(rows) == comparable(oracle(folder, query.sql))
    return rows


@pytest.mark.parametrize("name", NAMES)
def test_plain(name, spark, oracle, rows_of):
    assert check(all_queries()[name], spark, PLAIN, oracle, rows_of)


@pytest.mark.parametrize("name", NAMES)
def test_skewed(name, spark, skewed, oracle, rows_of):
    check(all_queries()[name], spark, skewed, oracle, rows_of)


@pytest.mark.parametrize("name", [
    "filter_between", "row_value_cmp", "page_keyset", "coalesce_zero", "golden_diff", "bucket_5min",
    "day_boundary_tz", "dq_unique", "agg_daily_revenue",
])
def test_other_time_zone(name, spark, skewed, oracle, rows_of):
    """The tables' clock has no zone, so the session's must not matter."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        check(all_queries()[name], spark, skewed, oracle, rows_of)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_contract(spark):
    assert contract.entry(spark).count() == 150
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(NAMES) <= set(contract.queries())
    assert set(NAMES) - set(contract.oracle_sql()) == WITHOUT_SQL

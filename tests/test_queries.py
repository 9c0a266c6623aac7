"""Registered queries against their SQL, on the smallest data set."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, normalise
from promoledger.queries import registry

FOLDER = "/root/testdata/sf0.001"
# A cross-section that stays quick; check_queries.py runs them all.
QUICK = (
    "conform_sales trailing_minus_parse latest_snapshot upsert delete_latest_batch restate_returns loyalty_dedupe "
    "io_proportions gift_value promo_axis dup_keys control_total_recon export_window pii_roundtrip interval_bands "
    "subset_completeness subset_loss report_files exception_table month_fallback catalog_statistics unknown_types"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")


def test_every_query_of_the_reference_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, con, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normalise(got) == normalise(want)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0

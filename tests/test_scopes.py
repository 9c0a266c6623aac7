from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from promoledger.functions import keys
from promoledger.operators import joins
from promoledger.queries import registry, storage, views
from promoledger.sinks import writers

from .conftest import rowset

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")


@pytest.fixture(autouse=True)
def whole_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def ranges(text):
    """Of every scan of the lines: whether a range of the stored date reached it."""
    scans = [x for x in re.findall(r"FileScan parquet [^\n]*", text) if "lineitem" in x]
    return ["GreaterThanOrEqual(l_shipdate" in x and "LessThan(l_shipdate" in x for x in scans]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_ranges_say_the_same_as_keys(spark, kind):
    days = spark.createDataFrame([(dt.datetime(2019, 12, 30) + dt.timedelta(hours=11 * i),) for i in range(200)], "d timestamp").select(F.col("d").cast(kind).alias("d"))
    keyed = days.withColumns({"t": keys.time_key("d"), "m": keys.month_key("d")})
    for got, want in (
        (keys.day_range("d", 20191231, 20200105), F.col("t").between(20191231, 20200105)),
        (keys.day_range("d", 20200229, 20200229), F.col("t") == 20200229),
        (keys.month_range("d", 201912), F.col("m") == 201912),
        (keys.month_range("d", 201912, 202002), F.col("m").between(201912, 202002)),
    ):
        assert rowset(keyed.filter(got)) == rowset(keyed.filter(want)) and keyed.filter(got).count()


@needs_data
@pytest.mark.parametrize("name", ["restate_returns", "trailing_avg", "store_size_band", "latest_batch_counts", "missing_dim_keys", "presence_flags"])
def test_scopes_reach_the_scan(spark, name):
    found = ranges(plan(registry.QUERIES[name](spark, FOLDER)))
    assert found and all(found)


@needs_data
def test_scopes_of_windows_reach_the_scan(spark):
    lines = storage._monthly_lines(spark, FOLDER)
    window = writers.in_window(lines, "time_key", 20000227, 20000304, "l_shipdate")
    assert ranges(plan(window)) == [True] and "l_shipdate" not in window.columns
    assert rowset(window) == rowset(writers.in_window(lines, "time_key", 20000227, 20000304).drop("l_shipdate"))
    assert ranges(plan(lines.filter(keys.month_range("l_shipdate", 199803)))) == [True]
    # The newest load is searched inside its window; what stays is the whole table.
    kept = registry.QUERIES["delete_latest_batch"](spark, FOLDER)
    assert set(ranges(kept._jdf.queryExecution().toString().split("== Physical Plan ==")[1])) == {False, True}


def test_a_calendar_prunes_the_folders_of_a_stored_fact(spark, tmp_path):
    fact = spark.range(240).select((F.col("id") % 12 + 202001).cast("int").alias("month_id"), F.col("id").alias("v"))
    writers.append_partitions(fact, str(tmp_path / "fact"), ("month_id",))
    spark.range(12).select((F.col("id") + 202001).cast("int").alias("month_id"), (F.col("id") % 3).alias("kind")).write.parquet(str(tmp_path / "calendar"))
    chosen = spark.read.parquet(str(tmp_path / "calendar")).filter("kind = 2")
    found = joins.in_calendar(spark.read.parquet(str(tmp_path / "fact")), chosen, "month_id")
    assert "dynamicpruning" in plan(found)
    assert sorted({r["month_id"] for r in found.collect()}) == [202003, 202006, 202009, 202012] and found.count() == 80


@needs_data
def test_a_scope_on_the_view_loses_nothing_inside_it(spark):
    months = keys.month_range("l_shipdate", 200011, 200101)
    scoped = views.sales_fact(spark, FOLDER, months)
    assert scoped.count() == views.sales_fact(spark, FOLDER).filter("month_id between 200011 and 200101").count() > 0

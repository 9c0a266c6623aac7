from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from promoledger.operators import joins, sales

from .conftest import rowset

LINE = "product_code string, invoice_number string, transactional_site_code string, transactional_outlet_code string, month_id int, time_key int, gross_sales_val double"


@contextmanager
def shuffled(spark):
    """Joins shuffle, as they do on large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def masters(spark):
    """Product p2 is in two groups, outlet o2 has its channel twice; a repeated row is shown as often as the masters have it."""
    frame = spark.createDataFrame
    return dict(
        hierarchy=frame([("p1", "g1", "Banded"), ("p2", "g1", "Banded"), ("p2", "g2", "Banded"), ("p2", "g2", "Banded")], "product_code string, standard_product_group_code string, banded string"),
        distributors=frame([("s1", "NORTH"), ("s1", "EAST"), ("s2", None)], "site_code string, dt_region string"),
        outlet_channels=frame([("o1", "GT"), ("o2", "MT"), ("o2", "MT")], "outlet_code string, channel string"),
        outlets=frame([("o1", "Y"), ("o1", "Y"), ("o2", "N"), ("o3", None)], "outlet_code string, perfect_store string"),
        store_sizes=frame([("o1", 1), ("o2", 2)], "outlet_code string, store_size_code int"),
        coded=frame([("CHANNEL", "GT", 7), ("CHANNEL", "MT", 8), ("PERFECT_STORE", "Yes", 1), ("PERFECT_STORE", "No", 0)], "ref_type string, ref_desc string, ref_code int"),
    )


def lines(spark):
    keys = [("p1", "i1", "s1", "o1"), ("p1", "i1", "s1", "o1"), ("p2", "i2", "s2", "o2"), ("p2", "i1", None, "o3"), (None, "i3", "s3", None), ("75x", "i3", "s1", "o1"), ("p9", "i4", "s1", "o4")]
    return spark.createDataFrame([(*k, 202001, 20200100 + n + 1, float(n + 1)) for n, k in enumerate(keys * 2)], LINE)


def coded(df, m):
    codes = sales.outlet_report_codes(m["outlets"], m["outlet_channels"], m["store_sizes"], m["coded"])
    out = df.join(sales.product_groups(m["hierarchy"]), "product_code", "left")
    out = out.join(sales.site_regions(m["distributors"]).withColumnRenamed("site_code", "transactional_site_code"), "transactional_site_code", "left")
    return out.join(codes.withColumnRenamed("outlet_code", "transactional_outlet_code"), "transactional_outlet_code", "left")


def test_codes_that_lines_bring_give_the_same_month_rows(spark, masters):
    after = sales.monthly_sales(lines(spark), None, **masters)
    before = sales.monthly_sales(coded(lines(spark), masters), None, **masters)
    assert rowset(before, *sorted(after.columns)) == rowset(after, *sorted(after.columns)) and before.count() == 9


def test_lines_of_an_invoice_with_their_codes_are_summed_where_they_are(spark, masters):
    with shuffled(spark):
        dealt = coded(lines(spark), masters).localCheckpoint().repartition("invoice_number")
        plan = sales.monthly_sales(dealt, None, **masters)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_lines_dealt_by_a_salt_are_summed_where_they_are_and_a_hot_product_is_split(spark):
    groups = spark.createDataFrame([("p1", "g1", "Banded"), ("p2", "g1", "No"), ("p2", "g2", "No")], "product_code string, standard_product_group_code string, banded string").localCheckpoint()
    # Product p1 owns all but a few of the lines.
    rows = [("p1" if n % 20 else f"p{n % 3}", f"o{n}", 20200101, float(n)) for n in range(400)]
    sold = spark.createDataFrame(rows, "product_code string, transactional_outlet_code string, time_key int, gross_sales_val double").na.fill("NA", ["product_code"]).localCheckpoint()
    by = ["product_code", "transactional_outlet_code"]
    with shuffled(spark):
        lines = joins.salted_join(sold, groups, "product_code", by[1:])
        summed = lines.groupBy(*by, joins.SALT, "banded").agg(F.sum("gross_sales_val").alias("v")).drop(joins.SALT)
        plan = summed._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.adaptive.enabled", False)
        try:
            tasks = [r["count"] for r in joins.salted_join(sold, groups, "product_code", by[1:]).groupBy(F.spark_partition_id()).count().collect()]
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", True)
        assert plan.count("Exchange") == 2
        assert max(tasks) < 0.6 * sum(tasks)
        assert rowset(summed) == rowset(sold.join(groups, "product_code", "left").groupBy(*by, "banded").agg(F.sum("gross_sales_val").alias("v")))


def test_a_repeated_side_is_not_broadcast_however_small_its_estimate(spark):
    sold = spark.range(1000).select((F.col("id") % 50).cast("string").alias("product_code"), F.col("id").alias("site"))
    groups = spark.range(50).select(F.col("id").cast("string").alias("product_code"), F.lit("g").alias("standard_product_group_code"))
    joined = joins.salted_join(sold, groups, "product_code", ["site"])
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 1_000_000
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
    assert joined.where("standard_product_group_code = 'g'").count() == 1000

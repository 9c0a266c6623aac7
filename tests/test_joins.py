from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from promoledger.operators import joins

from .conftest import rowset


@pytest.fixture(scope="module")
def sides(spark):
    rnd = random.Random(7)
    # One key holds a third of the rows; some keys are null or unknown.
    left = [("hot" if i % 3 == 0 else rnd.choice(["a", "b", "zz", None]), i % 5, i) for i in range(300)]
    right = [("hot", 1.0), ("a", 2.0), ("b", 3.0), ("c", 4.0)]
    return (
        spark.createDataFrame(left, "k string, g int, v int"),
        spark.createDataFrame(right, "k string, r double"),
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_spread_join_equals_plain_join(spark, sides, how, broadcast):
    left, right = sides
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = joins.spread_join(left, right, "k", how)
        assert rowset(got) == rowset(left.join(right, "k", how))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_key_is_split_although_the_other_side_is_grouped_by_it(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k) for k in conf if spark.conf.get(k, None) is not None}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
        left = spark.range(0, n, 1, 8).select(hot.alias("k"), F.col("id").alias("invoice_no"), F.rand(1).alias("v"))
        right = spark.range(n).repartition(4).select(F.col("id").alias("k")).groupBy("k").agg(F.count("*").alias("c"))
        for out, split in ((left.join(right, "k", "left"), False), (joins.spread_join(left, right, "k"), True)):
            frame = out.agg(F.count("c"), F.sum("invoice_no"), F.sum("v"))
            assert tuple(frame.collect()[0])[:2] == (n, n * (n - 1) // 2)
            assert ("skew=true" in frame._jdf.queryExecution().executedPlan().toString()) == split
    finally:
        for k in conf:
            spark.conf.set(k, before[k]) if k in before else spark.conf.unset(k)


def test_spreading_keeps_unused_columns_out_of_the_scan(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("unused"), F.col("id").alias("v")).write.parquet(path)
    right = spark.range(10).select(F.col("id").alias("k")).groupBy("k").count()
    out = joins.spread_join(spark.read.parquet(path), right, "k").groupBy("count").agg(F.sum("v"))
    assert "ReadSchema: struct<k:bigint,v:bigint>" in out._jdf.queryExecution().executedPlan().toString()


def test_first_and_latest_per_group(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 9, "q"), (None, 1, "n")], "k string, o int, v string"
    )
    assert rowset(joins.first_per_group(df, ["k"], ["o"])) == [(None, 1, "n"), ("a", 1, "y"), ("b", 9, "q")]
    assert rowset(joins.latest_per_key(df, ["k"], ["o"])) == [(None, 1, "n"), ("a", 2, "x"), ("b", 9, "q")]


def test_newest_rows_keep_all_of_the_newest_year(spark):
    df = spark.createDataFrame([("p", 2019, 1), ("p", 2020, 2), ("p", 2020, 3), ("q", 2019, 4), (None, 2018, 5)], "p string, y int, v int")
    assert rowset(joins.newest_rows_per_key(df, ["p"], "y"), "v") == [(2,), (3,), (4,), (5,)]


def test_dense_code_follows_sort_order(spark):
    names = ["MOM & POP", "PROFESSIONAL", "MOM", "AB", "A", "ABC", "Z", "MARKET", "M"]
    df = spark.createDataFrame([(n,) for n in names + names], "n string")
    got = {r[0]: r[1] for r in joins.dense_code(df, "n", "c").collect()}
    assert got == {n: i + 1 for i, n in enumerate(sorted(names))}


def test_band_edges_gaps_and_overlap(spark):
    bands = spark.createDataFrame([(1, 0.0, 10.0), (2, 10.0, 20.0), (3, 30.0, 40.0)], "ref_code int, param1 double, param2 double")
    df = spark.createDataFrame([(0.0,), (10.0,), (25.0,), (40.0,), (40.5,), (None,)], "v double")
    got = rowset(joins.band(df, "v", bands))
    # 10.0 lies in two bands, as in any left range join.
    assert got == [(None, None), (0.0, 1), (10.0, 1), (10.0, 2), (25.0, None), (40.0, 3), (40.5, None)]


def test_long_code_lists_and_bands(spark):
    n = 50_000
    names = spark.range(n).select(F.format_string("n%06d", F.col("id")).alias("n"))
    codes = joins.dense_code(names.repartition(7), "n", "c")
    assert codes.filter(F.col("c") - 1 == F.substring("n", 2, 6).cast("int")).count() == n
    bands = spark.range(n).select(F.col("id").cast("int").alias("ref_code"), F.col("id").cast("double").alias("param1"), (F.col("id") + 0.5).alias("param2"))
    values = spark.createDataFrame([(1.25,), (1.75,), (49_999.5,), (None,)], "v double")
    assert rowset(joins.band(values, "v", bands)) == [(None, None), (1.25, 1), (1.75, None), (49_999.5, 49_999)]


@pytest.mark.parametrize(("left", "right"), [("int", "bigint"), ("string", "bigint"), ("bigint", "string"), ("date", "timestamp"), ("float", "int"), ("int", "int"), ("string", "int")])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_of_unlike_key_types_equals_a_plain_join(spark, left, right, how):
    values = ["2020-01-02", "2020-03-04"] if left == "date" else ["1", "2"]
    rows = spark.createDataFrame([(v,) for v in [*values, values[0], None]], "k string")
    a = rows.select(F.col("k").cast(left).alias("k"), F.lit("l").alias("a"))
    b = rows.limit(1).union(rows.filter("k is null")).select(F.col("k").cast(right).alias("k"), F.lit("r").alias("b"))
    got = joins.spread_join(a, b, "k", how)
    want = a.join(b, "k", how)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_spread_join_refuses_keys_that_do_not_compare(spark):
    with pytest.raises(TypeError, match="join key k"):
        joins.spread_join(spark.sql("select true as k"), spark.sql("select 1 as k"), "k")

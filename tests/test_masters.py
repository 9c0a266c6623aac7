from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from promoledger import schemas
from promoledger.plans import reference_data
from promoledger.sinks import writers
from promoledger.sources import readers

from .conftest import rowset

GIFTS = ",".join(schemas.GIFT_MASTER.fieldNames())


def _gift(code, packing="1", size="2.5", fields=19):
    return ",".join([code, "n", "", "", "", packing, "", "", "", size, *[""] * 9][:fields])


def test_bad_rows_are_kept_apart_with_their_reasons(spark, tmp_path):
    folder = tmp_path / "in" / "2020" / "02"
    folder.mkdir(parents=True)
    (folder / "g.csv").write_text("\n".join([GIFTS, _gift("G1"), _gift("G2", "12.0", ""), _gift("G3", "1.5", "big"), _gift("", "x"), _gift("G4", fields=7), _gift("G5", "", "")]) + "\n")
    paths = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "rejects")
    for run in ("a", "b", "b"):
        reference_data.conform_master(spark, "gift_master", *paths, run=run)
    typed = spark.read.parquet(paths[1])
    assert typed.schema.simpleString() == schemas.GIFT_MASTER.simpleString()
    assert rowset(typed, "gift_code", "packing_per_case", "size_h") == [("G1", 1, 2.5), ("G2", 12, None), ("G5", None, None)]
    rejects = spark.read.option("header", True).csv(paths[2])
    assert rowset(rejects.filter("run = 'b'"), "gift_code", "reasons") == [
        (None, "gift_code is missing; packing_per_case is no int: x"),
        ("G3", "packing_per_case is no int: 1.5; size_h is no double: big"),
        ("G4", "wrong number of fields"),
    ]
    assert rowset(rejects.groupBy("run").count()) == [("a", 3), ("b", 3)]
    # A run without rejects leaves nothing of what it reported before.
    (folder / "g.csv").write_text("\n".join([GIFTS, _gift("G1")]) + "\n")
    reference_data.conform_master(spark, "gift_master", *paths, run="b")
    assert rowset(spark.read.option("header", True).csv(paths[2]).groupBy("run").count()) == [("a", 3)]


@pytest.mark.parametrize("name", reference_data.MASTER_FILES)
def test_every_master_meets_its_contract(spark, tmp_path, name):
    schema, levels, keys = reference_data.MASTER_FILES[name]
    folder = tmp_path.joinpath("in", *["2020", "1", "3"][:levels])
    folder.mkdir(parents=True)
    good = ["7" if f.dataType.simpleString() != "string" else f"{f.name} x" for f in schema]
    bad = ["" if f.name == keys[-1] else v for f, v in zip(schema, good, strict=True)]
    (folder / "f.csv").write_text("\n".join([",".join(schema.fieldNames()), ",".join(good), ",".join(bad)]) + "\n")
    reference_data.conform_master(spark, name, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "rejects"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.schema.simpleString() == schema.simpleString() and out.count() == 1
    assert rowset(spark.read.option("header", True).csv(str(tmp_path / "rejects")), "reasons") == [(f"{keys[-1]} is missing",)]


def test_a_declared_table_holds_the_last_run(spark, tmp_path):
    schema = schemas.struct(s="k", i="v")
    spark.sql(writers.table_ddl("offenders_t", schema, str(tmp_path / "t")))
    try:
        for n in (3, 1, 0):
            writers.insert_exceptions(spark.range(n).select(F.col("id").cast("int").alias("v"), F.lit("x").alias("k"), F.lit(1).alias("more")), "offenders_t")
            assert readers.read_table(spark, "offenders_t").count() == n
        assert readers.read_table(spark, "offenders_t").schema.simpleString() == schema.simpleString()
    finally:
        spark.sql("drop table offenders_t")


def test_recovered_partitions_are_read_by_name(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.range(6).select(F.col("id").alias("v"), (F.col("id") % 3).cast("int").alias("part"))
    try:
        for part in range(3):
            writers.append_partitions(rows.filter(F.col("part") == part), path, ("part",))
            writers.register_table(spark, "parts_t", rows.schema, path, ("part",))
            assert readers.read_table(spark, "parts_t").count() == 2 * (part + 1)
        assert spark.sql("show partitions parts_t").count() == 3
    finally:
        spark.sql("drop table parts_t")


def test_column_statistics_change_the_join(spark, tmp_path):
    """A filter that leaves one row of many: only with column statistics Spark knows, and broadcasts that side."""
    big = spark.range(20_000).select(F.col("id").alias("k"), F.col("id").alias("v"), F.lit("x" * 50).alias("text"))
    conf = {"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "20000", "spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joins = {}
        for name, columns in (("without_t", ()), ("with_t", ("k", "v"))):
            writers.write_small(big, str(tmp_path / name))
            table = writers.register_table(spark, name, big.schema, str(tmp_path / name), statistics=columns)
            joins[name] = table.filter("v < 10").join(spark.range(50_000).withColumnRenamed("id", "k").repartition(4), "k")
        plans = {name: df._jdf.queryExecution().executedPlan().toString() for name, df in joins.items()}
        assert "SortMergeJoin" in plans["without_t"] and "BroadcastHashJoin" in plans["with_t"]
        assert joins["with_t"].count() == joins["without_t"].count() == 10
    finally:
        for k in conf:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        for name in ("without_t", "with_t"):
            spark.sql(f"drop table if exists {name}")

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from promoledger.operators import mutation
from promoledger.sinks import tables, writers

from .conftest import rowset

COLUMNS = "product_code string, invoice_number string, v int, w string, insert_ts int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def plain_upsert(target, source):
    """Row by row: target rows take v and w of the last source row of their key; unmatched source rows follow."""
    last, owned = {}, {(p, i) for p, i, *_ in target if p is not None and i is not None}
    low = lambda row: tuple((x is not None, x) for x in row[2:4])
    for row in source:
        if None not in row[:2] and (row[:2] not in last or low(row) > low(last[row[:2]])):
            last[row[:2]] = row
    out = [(*r[:2], *last[r[:2]][2:4], r[4]) if r[:2] in last else r for r in target]
    return sorted(out + [r for r in source if r[:2] not in owned], key=str)


def made(seed):
    import random

    rng = random.Random(seed)
    code = lambda n: rng.choice([None, *[f"p{i}" for i in range(n)]])
    rows = lambda n, ts: [(code(4), code(5), rng.choice([None, 1, 2, 3]), rng.choice(["a", "b", None]), ts) for _ in range(n)]
    return rows(60, 1) + [("hot", "hot", i % 3, "t", 1) for i in range(80)], rows(50, 2) + [("hot", "hot", 9, "s", 2), ("hot2", "hot2", 1, "x", 2)] + [("hot2", "hot2", i % 4, "y", 2) for i in range(70)]


@pytest.mark.parametrize("hot", [(), (("hot", "hot"), ("hot2", "hot2"), ("p1", "p2"))])
def test_merge_equals_a_row_by_row_version(spark, hot):
    for seed in range(3):
        target, source = made(seed)
        out = mutation.upsert(spark.createDataFrame(target, COLUMNS), spark.createDataFrame(source, COLUMNS), hot=hot)
        assert sorted(map(tuple, out.collect()), key=str) == plain_upsert(target, source)


def test_hot_keys_are_found_and_kept_out_of_the_shuffle(spark):
    target, source = made(0)
    t, s = spark.createDataFrame(target, COLUMNS), spark.createDataFrame(source, COLUMNS)
    found = mutation.hot_keys(t, s, share=0.2, sample=1.0, least=20)
    assert sorted(found) == [("hot", "hot"), ("hot2", "hot2")]
    assert mutation.hot_keys(t, s) == []
    merged = mutation.upsert(t.repartition(5), s.repartition(5), hot=found)
    assert "BroadcastHashJoin" in plan(merged)


def test_a_merge_scans_and_shuffles_each_side_once(spark, tmp_path):
    for name, rows in zip(("target", "source"), made(1), strict=True):
        spark.createDataFrame(rows, COLUMNS).write.parquet(str(tmp_path / name))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(mutation.upsert(*[spark.read.parquet(str(tmp_path / n)) for n in ("target", "source")]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"FileScan parquet", text)) == 2 and "Join" not in text
    # One exchange above the union of both.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1


FACT = "invoice_number string, product_code string, sales_ret_ref_invoice_number string, invoice_date date, year_id int, month_id int, time_key int"


def _fact(spark, path):
    rows = [("O1", "P1", "0", "2020-02-03", 2020, 202002, 20200203), ("O1", "P1", "0", "2020-02-01", 2020, 202002, 20200201), ("R1", "P1", "O1", "2020-03-05", 2020, 202003, 20200305), ("R2", "P2", "O1", "2020-03-05", 2020, 202003, 20200305), ("X", "P3", "0", "2020-03-06", 2020, 202003, 20200306), ("Y", "P1", "0", "2020-01-06", 2020, 202001, 20200106)]
    df = spark.createDataFrame([(*r[:3], None, *r[4:]) for r in rows], FACT).withColumn("invoice_date", F.to_date(F.col("time_key").cast("string"), "yyyyMMdd"))
    writers.append_partitions(df, path)


def test_a_restatement_reads_the_fact_twice_and_moves_rows_between_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    _fact(spark, path)
    restated = mutation.restate_returns(spark.read.parquet(path), month=202003)
    facts = [x for x in re.findall(r"FileScan parquet [^\n]*", plan(restated)) if "/fact" in x]
    assert 1 <= len(facts) <= 2 and all("month_id" in x.split("PartitionFilters")[1] for x in facts)
    moved = rowset(restated, "invoice_number", "time_key")
    tables.restate_returns_in_place(spark, path, month=202003)
    assert rowset(spark.read.parquet(path), "invoice_number", "time_key") == [("O1", 20200201), ("O1", 20200203), ("R1", 20200201), ("R2", 20200305), ("X", 20200306), ("Y", 20200106)]
    assert moved == [r for r in rowset(spark.read.parquet(path), "invoice_number", "time_key") if r[0] != "Y"]

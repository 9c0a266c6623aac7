from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from promoledger import session
from promoledger.queries import full_grain
from promoledger.sinks import slices
from promoledger.sources import storage

from .conftest import rowset


FOLDER = "/root/testdata/sf0.001"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    summed = spark.range(10_000).repartition(3).groupBy((F.col("id") % 100).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    staged, _ = session.stage(summed, "freed")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert rowset(staged) == [(k, 100) for k in range(100)] == rowset(summed)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_table_in_slices_gives_every_row_once_and_whole_groups(spark, monkeypatch):
    rows = [(f"O{n % 7}" if n % 5 else None, 202001 + n % 3 if n % 11 else None, float(n)) for n in range(400)]
    stored, path = session.stage(spark.createDataFrame(rows, "outlet_code string, month_id int, v double"), "whole")
    size = storage.folder_bytes(spark, path)
    assert size > 0

    def build(part):
        return part.groupBy("outlet_code", "month_id").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"))

    built = []
    monkeypatch.setattr(slices, "SLICE_BYTES", size // 3 - 1)
    found = slices.staged_in_slices(stored, path, ["outlet_code", "month_id"], lambda part: built.append(part.count()) or build(part), "sliced")
    assert len(built) == 4 and sum(built) == 400 and max(built) < 400
    assert rowset(found) == rowset(build(stored))


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")
def test_lines_of_the_typed_fact_go_once_its_branches_hold_theirs(spark):
    top = session.new_work_path(spark, "x").rsplit("/", 1)[0]
    described = lambda: {name for name in storage.child_folders(spark, top) if name.startswith("described-promos")}
    spark.range(1).write.parquet(f"{top}/described-promos-of-another-{time.time()}")
    before, folders = described(), []
    daily = full_grain._daily(spark, FOLDER, folders)
    assert described() == before
    assert sorted(f.rsplit("/", 1)[1].rsplit("-", 1)[0] for f in folders) == ["gift-lines", "off-lines", "on-lines", "other-lines"]
    assert daily.count() > 0

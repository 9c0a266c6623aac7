from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from promoledger import schemas
from promoledger.operators import mutation
from promoledger.sinks import tables, writers
from promoledger.sources import readers, snapshots

from .conftest import rowset


def test_snapshots_compare_numbers_not_text(spark, tmp_path):
    for folder in ("2019/12/31", "2020/9/30", "2020/10/2", "2020/10/11"):
        os.makedirs(tmp_path / folder)
    root = str(tmp_path)
    assert snapshots.latest_snapshot(spark, root) == f"{root}/2020/10/11"
    assert snapshots.latest_month(spark, root) == f"{root}/2020/10"
    assert snapshots.latest_month(spark, root, 2019) == f"{root}/2019/12"
    assert snapshots.month_snapshot(spark, root, "202008") == f"{root}/2020/08"
    assert snapshots.month_snapshot(spark, root, "202012", fallback=True) == f"{root}/2020/10"


def test_newest_rows(spark):
    df = spark.createDataFrame([(2019, 12, 31, 1), (2020, 1, 2, 2), (2020, 1, 2, 3), (2020, 1, 1, 4)], "y int, m int, d int, v int")
    assert rowset(snapshots.newest_rows(df), "v") == [(2,), (3,)]


def test_csv_readers_keep_codes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("code,v\n0003,1.5\n")
    schema = schemas.struct(s="code", d="v")
    assert rowset(readers.read_csv(spark, str(tmp_path), schema)) == [("0003", 1.5)]
    assert rowset(readers.read_csv_text(spark, str(tmp_path))) == [("0003", "1.5")]
    assert rowset(readers.parameter_row(spark, a=1, b="x")) == [(1, "x")]


def _table(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, year_id int, month_id int, time_key int")


def test_replace_slice_drops_emptied_partitions_and_keeps_others(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_partitions(
        _table(spark, [("a", 1, 2020, 202001, 20200101), ("b", 2, 2020, 202001, 20200102), ("c", 3, 2020, 202002, 20200201)]), path
    )
    # The replacement reads the table it replaces.
    changed = spark.read.parquet(path).filter("time_key = 20200102").withColumn("v", F.col("v") * 10)
    writers.replace_slice(changed, path, F.col("month_id") == 202001)
    assert rowset(spark.read.parquet(path), "k", "v") == [("b", 20), ("c", 3)]
    with pytest.raises(Exception, match="(?i)v"):
        writers.replace_slice(changed, path, F.col("v") == 1)


def test_reload_month_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    first = _table(spark, [("a", 1, 2020, 202001, 20200131), ("c", 3, 2020, 202002, 20200229)])
    again = _table(spark, [("x", 9, 2020, 202001, 20200131)])
    writers.reload_months(first, path, [202001, 202002])
    for _ in range(2):
        writers.reload_months(again, path, [202001])
        assert rowset(spark.read.parquet(path), "k", "v") == [("c", 3), ("x", 9)]


def test_export_leaves_part_files_only(spark, tmp_path):
    path = str(tmp_path / "e")
    df = _table(spark, [(str(n), n, 2020, 202001, 20200101 + n) for n in range(20)])
    writers.export_window(df, path, "time_key", 20200103, 20200109, files=3)
    names = [n for n in os.listdir(path) if not n.startswith(".")]
    assert len(names) == 3 and all(n.startswith("part-") for n in names)
    assert spark.read.parquet(path).count() == 7


def test_exceptions_are_written_only_when_there_are_any(spark, tmp_path):
    df = spark.range(2)
    assert not writers.write_exceptions(df.filter("id > 5"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    assert writers.write_exceptions(df, str(tmp_path / "some"))
    assert readers.read_csv_text(spark, str(tmp_path / "some")).count() == 2
    writers.write_exception_table(df.filter("id > 5"), str(tmp_path / "table"))
    assert spark.read.parquet(str(tmp_path / "table")).count() == 0


def test_registered_table(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_partitions(_table(spark, [("a", 1, 2020, 202001, 20200101)]), path)
    schema = schemas.struct(s="k", i="v year_id month_id time_key")
    table = writers.register_table(spark, "daily_t", schema, path, writers.SALES_PARTITIONS)
    assert rowset(table, "k", "v", "time_key") == [("a", 1, 20200101)]
    assert rowset(readers.read_table(spark, "daily_t"), "k") == [("a",)]
    spark.sql("drop table daily_t")


def test_conform_orders_casts_and_fills(spark):
    df = spark.createDataFrame([("1", "x")], "v string, k string")
    out = schemas.conform(df, schemas.struct(s="k", i="v", d="w"))
    assert out.dtypes == [("k", "string"), ("v", "int"), ("w", "double")]
    assert rowset(out) == [("x", 1, None)]


KEYED = "product_code string, invoice_number string, invoice_date string, v int, insert_ts int, update_ts int, year_id int, month_id int, time_key int"


def _keyed(spark, rows):
    return spark.createDataFrame(rows, KEYED)


def test_upsert_updates_inserts_and_is_idempotent(spark):
    day = (2020, 202012, 20201205)
    target = _keyed(
        spark, [("P1", "I1", "d1", 1, 10, 10, *day), ("P1", "I1", "d1", 2, 10, 10, *day), ("P2", "I1", "d1", 3, 10, 10, *day), (None, "I9", "d1", 4, 10, 10, *day)]
    )
    source = _keyed(
        spark, [("P1", "I1", "d2", 7, 20, 20, 2020, 202012, 20201206), ("P3", "I1", "d2", 8, 20, 20, 2020, 202012, 20201206), (None, "I9", "d2", 9, 20, 20, 2020, 202012, 20201206)]
    )
    once = mutation.upsert(target, source)
    got = rowset(once, "product_code", "v", "invoice_date", "insert_ts", "update_ts", "time_key")
    assert got == [
        (None, 4, "d1", 10, 10, 20201205),
        (None, 9, "d2", 20, 20, 20201206),
        ("P1", 7, "d1", 10, 20, 20201205),
        ("P1", 7, "d1", 10, 20, 20201205),
        ("P2", 3, "d1", 10, 10, 20201205),
        ("P3", 8, "d2", 20, 20, 20201206),
    ]
    twice = source.union(source.withColumn("v", F.col("v") + 1))
    assert rowset(mutation.upsert(target, twice, order=["v"]).filter("product_code is not null"), "product_code", "v") == [
        ("P1", 8), ("P1", 8), ("P2", 3), ("P3", 8), ("P3", 9)
    ]
    keyed = source.filter("product_code is not null")
    again = mutation.upsert(mutation.upsert(target, keyed), keyed)
    assert rowset(again) == rowset(mutation.upsert(target, keyed))


def test_delete_latest_batch(spark):
    df = spark.createDataFrame(
        [(20201201, 5, "old"), (20201202, 9, "gone"), (20201203, 9, "gone"), (20201130, 9, "outside"), (20201202, None, "no stamp")],
        "time_key int, insert_ts int, v string",
    )
    assert rowset(mutation.delete_latest_batch(df, 20201201, 20201207), "v") == [("no stamp",), ("old",), ("outside",)]


RETURNS = "invoice_number string, sales_ret_ref_invoice_number string, product_code string, v int, invoice_date string, time_key int, month_id int, year_id int, update_ts int"


def _returns(spark):
    rows = [
        ("R1", "I1", "P1", 1, "d9", 20210105, 202101, 2021, 0),  # original last month
        ("R1", "0", "P1", 2, "d9", 20210105, 202101, 2021, 0),  # other line of the same key moves along
        ("R1", "I1", "P2", 3, "d9", 20210105, 202101, 2021, 0),  # no such product on the original
        ("R2", "I0", "P1", 4, "d9", 20210105, 202101, 2021, 0),  # original too old
        ("I1", "0", "P1", 5, "d1", 20201210, 202012, 2020, 0),
        ("I1", "0", "P1", 6, "d2", 20201211, 202012, 2020, 0),  # a second original: the earliest wins
        ("I0", "0", "P1", 7, "d0", 20201101, 202011, 2020, 0),
    ]
    return spark.createDataFrame(rows, RETURNS)


def test_restate_returns_keeps_rows_and_sums(spark):
    fact = _returns(spark)
    got = rowset(mutation.restate_returns(fact, day=20210105, batch_ts=F.lit(1)), "v", "invoice_date", "time_key", "month_id", "year_id", "update_ts")
    assert got == [
        (1, "d1", 20201210, 202012, 2020, 1),
        (2, "d1", 20201210, 202012, 2020, 1),
        (3, "d9", 20210105, 202101, 2021, 0),
        (4, "d9", 20210105, 202101, 2021, 0),
        (5, "d1", 20201210, 202012, 2020, 0),
        (6, "d2", 20201211, 202012, 2020, 0),
    ]


def test_restate_in_place_moves_rows_between_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    writers.append_partitions(_returns(spark), path)
    for _ in range(2):
        tables.restate_returns_in_place(spark, path, day=20210105, batch_ts=F.lit(1))
        got = rowset(spark.read.parquet(path), "v", "time_key")
        assert got == [(1, 20201210), (2, 20201210), (3, 20210105), (4, 20210105), (5, 20201210), (6, 20201211), (7, 20201101)]


def test_stored_upsert_reloads_a_day(spark, tmp_path):
    path = str(tmp_path / "fact")
    yesterday, today = (2020, 202012, 20201204), (2020, 202012, 20201205)
    old = _keyed(spark, [("P0", "I0", "d", 1, 5, 5, *yesterday), ("P1", "I1", "d", 1, 5, 5, *yesterday), ("P8", "I8", "d", 1, 5, 5, 2020, 202011, 20201101)])
    tables.upsert_days(spark, path, old, 20201204)
    load = _keyed(spark, [("P1", "I1", "d", 2, 6, 6, *today), ("P2", "I2", "d", 2, 6, 6, *today), ("P3", "I3", "d", 2, 6, 6, 2020, 202011, 20201101)])
    tables.upsert_days(spark, path, load, 20201205)
    reload = _keyed(spark, [("P1", "I1", "d", 3, 7, 7, *today), ("P4", "I4", "d", 3, 7, 7, *today)])
    tables.upsert_days(spark, path, reload, 20201205)
    got = rowset(spark.read.parquet(path), "product_code", "v", "insert_ts", "update_ts", "time_key")
    assert got == [
        ("P0", 1, 5, 5, 20201204),
        ("P1", 3, 5, 7, 20201204),
        ("P3", 2, 6, 6, 20201101),
        ("P4", 3, 7, 7, 20201205),
        ("P8", 1, 5, 5, 20201101),
    ]


def test_loading_twice_or_after_a_failure_repeats_no_late_row(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    today = (2020, 202012, 20201205)
    tables.upsert_days(spark, path, _keyed(spark, [("P8", "I8", "d", 1, 5, 5, 2020, 202010, 20201001), ("P0", "I0", "d", 1, 5, 5, *today)]), 20201205)
    load = lambda stamp: _keyed(spark, [("P1", "I1", "d", 2, stamp, stamp, *today), ("P3", "I3", "d", 2, stamp, stamp, 2020, 202010, 20201001)])
    whole = tables.overwrite_partitions

    def fails(*args, **more):
        raise RuntimeError("lost")

    monkeypatch.setattr(writers, "overwrite_partitions", fails)
    with pytest.raises(RuntimeError):
        tables.upsert_days(spark, path, load(6), 20201205)
    monkeypatch.setattr(writers, "overwrite_partitions", whole)
    for stamp in (7, 8):
        tables.upsert_days(spark, path, load(stamp), 20201205)
        assert rowset(spark.read.parquet(path).filter("time_key = 20201001"), "product_code") == [("P3",), ("P8",)]


def test_reload_of_a_null_partition_replaces_it(spark, tmp_path):
    path = str(tmp_path / "t")
    scope = F.col("time_key").isNull() | (F.col("month_id") == 202001)
    writers.append_partitions(_table(spark, [("old", 1, 2020, 202001, None), ("gone", 2, 2020, 202001, 20200101), ("stays", 3, 2020, 202002, 20200201)]), path)
    writers.replace_slice(_table(spark, [("new", 9, 2020, 202001, None)]), path, scope)
    assert rowset(spark.read.parquet(path), "k") == [("new",), ("stays",)]
    writers.replace_slice(_table(spark, [("only", 9, 2020, 202001, 20200105)]), path, scope)
    assert rowset(spark.read.parquet(path), "k") == [("only",), ("stays",)]


def test_a_repeated_batch_adds_its_files_and_leaves_those_of_others(spark, tmp_path, monkeypatch):
    path, days = str(tmp_path / "day 1"), ("day",)
    rows = lambda *pairs: spark.createDataFrame(pairs, "v string, day string")
    names = lambda: {p.name for p in (tmp_path / "day 1").rglob("part-*")}
    stored = lambda: rowset(spark.read.parquet(path), "v", "batch_id")
    writers.append_batch(rows(("a", "1 x"), ("b", "2")), path, "one", days)
    first = names()
    writers.append_batch(rows(("c", "1 x")), path, "two", days)
    others = names() - first
    with monkeypatch.context() as m:
        m.setattr(writers, "replace_slice", None)  # no folder is rewritten
        # A run that breaks off before it removes the old files is repaired by the next.
        m.setattr(writers.storage, "delete_files", lambda *_: None)
        writers.append_batch(rows(("d", "1 x"), ("e", "3")), path, "one", days)
        m.undo()
        m.setattr(writers, "replace_slice", None)
        writers.append_batch(rows(("d", "1 x"), ("e", "3")), path, "one", days)
    assert stored() == [("c", "two"), ("d", "one"), ("e", "one")]
    assert others <= names() and not first & names() and not (tmp_path / "day 1" / "day=2").exists()
    # A file that holds rows of others too is rewritten.
    mixed = spark.read.parquet(path).collect()
    writers.overwrite_partitions(spark.createDataFrame(mixed, "v string, batch_id string, day string").coalesce(1), path, days)
    writers.append_batch(rows(("f", "1 x")), path, "one", days)
    assert stored() == [("c", "two"), ("f", "one")]

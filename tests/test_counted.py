from __future__ import annotations

from pyspark.sql import functions as F

from promoledger.sinks import counted

from .conftest import rowset


def _feed(spark, tmp_path):
    path = str(tmp_path / "feed")
    rows = [("A", 1), ("A", 2), ("B", 3), ("C", 4), (None, 5), ("OTHER", 6)] * 3
    spark.createDataFrame(rows, "kind string, n int").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_counts_of_every_step_agree(spark, tmp_path):
    stored, ledger = counted.store_subsets(_feed(spark, tmp_path), "kind", ["A", "B"], str(tmp_path / "out"))
    assert rowset(ledger.report(spark)) == [("A", None, 6, 6, 6), ("ALL", 18, 18, 18, 18), ("B", None, 3, 3, 3), ("OTHER", None, 9, 9, 9)]
    assert ledger.mismatches(spark).isEmpty() and ledger.mismatches(spark).columns == ledger.report(spark).columns
    assert stored.count() == 18 and rowset(stored.where("subset = 'OTHER'").select("kind").distinct()) == [(None,), ("C",), ("OTHER",)]


def test_a_planted_loss_is_reported(spark, tmp_path):
    lose = lambda df: df.where("n <> 3")
    _, ledger = counted.store_subsets(_feed(spark, tmp_path), "kind", ["A", "B"], str(tmp_path / "out"), lose)
    assert rowset(ledger.mismatches(spark)) == [("ALL", 18, 18, 15, 15), ("B", None, 3, 0, 0)]
    double = lambda df: df.union(df.where("kind = 'A'"))
    _, ledger = counted.store_subsets(_feed(spark, tmp_path / "2"), "kind", ["A", "B"], str(tmp_path / "out2"), double)
    assert rowset(ledger.mismatches(spark), "subset", "rows_stored") == [("A", 12), ("ALL", 24)]


def test_moved_rows_and_rows_lost_by_the_split_are_reported(spark, tmp_path):
    move = lambda df: df.withColumn("subset", F.when(F.col("n") == 3, "A").otherwise(F.col("subset")))
    _, ledger = counted.store_subsets(_feed(spark, tmp_path), "kind", ["A", "B"], str(tmp_path / "out"), move)
    assert rowset(ledger.mismatches(spark), "subset", "rows_split", "rows_stored") == [("A", 6, 9), ("B", 3, 0)]
    ledger = counted.RowLedger(["A"])
    for step, counts in (("read", {"A": 9}), ("split", {"A": 4, "OTHER": 4}), ("written", {"A": 4, "OTHER": 4}), ("stored", {"A": 4, "OTHER": 4})):
        ledger.put(step, counts)
    assert ledger.offenders() == [("ALL", 9, 8, 8, 8)]


def test_counts_that_a_repeated_stage_doubled_raise_no_alarm(spark, tmp_path, monkeypatch):
    real = counted.RowLedger.counts
    monkeypatch.setattr(counted.RowLedger, "counts", lambda self, step: real(self, step) if step in self._counts else {k: 2 * v for k, v in real(self, step).items()})
    _, ledger = counted.store_subsets(_feed(spark, tmp_path), "kind", ["A", "B"], str(tmp_path / "out"))
    assert ledger.mismatches(spark).isEmpty()


def test_the_feed_is_scanned_once(spark, tmp_path):
    feed = _feed(spark, tmp_path)
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    counted.store_subsets(feed.mapInArrow(seen, feed.schema), "kind", ["A", "B"], str(tmp_path / "out"))
    assert reads.value == 18


def test_an_empty_feed(spark, tmp_path):
    stored, ledger = counted.store_subsets(_feed(spark, tmp_path).where("n > 99"), "kind", ["A"], str(tmp_path / "out"))
    assert stored.count() == 0 and ledger.offenders() == [] and rowset(ledger.report(spark), "subset", "rows_read") == [("A", None), ("ALL", 0), ("OTHER", None)]
    stored, ledger = counted.store_subsets(spark.createDataFrame([], "kind string, n int"), "kind", ["A"], str(tmp_path / "none"))
    assert stored.count() == 0 and ledger.offenders() == []

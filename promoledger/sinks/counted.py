"""Split, prepare and store a feed in one run that counts its rows on the way (V3, V4).

The counts are observed metrics: accumulators that the very tasks of the write fill
at read, after the split and at the write. Nothing is scanned for them, and since
each is taken at its own place, a step that loses or doubles rows shows as a
difference between two of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from promoledger.sources.readers import constant_relation

SUBSET, OTHER, ALL = "subset", "OTHER", "ALL"
_STEPS = ("split", "written", "stored")
_REPORT = "subset string, rows_read long, rows_split long, rows_written long, rows_stored long"


class RowLedger:
    """Row counts by step and subset, from observed metrics or counted."""

    def __init__(self, subsets: Sequence[str]):
        self.subsets = [*subsets, OTHER]
        self._observed: dict[str, Observation] = {}
        self._counts: dict[str, dict[str, int]] = {}

    def watch(self, df: DataFrame, step: str, column: str | None = None) -> DataFrame:
        """``df``, whose rows are counted under ``step`` by whatever action runs next, by subset if it has that column."""
        metrics = [F.count(F.lit(1)).alias(ALL)]
        if column is not None:
            metrics += [F.count_if(F.col(column) == name).alias(name) for name in self.subsets]
        self._observed[step] = Observation(f"{step}-{uuid.uuid4().hex}")
        return df.observe(self._observed[step], *metrics)

    def put(self, step: str, counts: dict[str, int]) -> None:
        """Counts of a step taken otherwise; they replace observed ones."""
        self._counts[step] = {ALL: sum(counts.values()), **counts}

    def counts(self, step: str) -> dict[str, int]:
        """Call this after the action that reads what was watched."""
        if step not in self._counts:
            try:
                found = self._observed[step].get
            except Py4JJavaError:
                # An input known to be empty is folded away together with what observes it.
                found = {}
            self._counts[step] = {k: int(v or 0) for k, v in found.items()}
        return self._counts[step]

    def rows(self) -> list[tuple]:
        """One row for each subset and one for all."""
        read = self.counts("read").get(ALL, 0)
        return [(name, read if name == ALL else None, *[self.counts(step).get(name, 0) for step in _STEPS]) for name in [*self.subsets, ALL]]

    def offenders(self) -> list[tuple]:
        """Rows whose counts differ from step to step. Of all rows, those read count too, and the subsets have to add up to them."""
        out = []
        for name, read, *steps in self.rows():
            parts = [sum(self.counts(step).get(s, 0) for s in self.subsets) for step in _STEPS] if name == ALL else []
            if len({*steps, *parts, *([read] if read is not None else [])}) > 1:
                out.append((name, read, *steps))
        return out

    def report(self, spark: SparkSession) -> DataFrame:
        return constant_relation(spark, self.rows(), _REPORT)

    def mismatches(self, spark: SparkSession) -> DataFrame:
        found = self.offenders()
        return constant_relation(spark, found, _REPORT) if found else self.report(spark).where(F.lit(False))


def _by_subset(df: DataFrame) -> dict[str, int]:
    return {row[SUBSET]: row["count"] for row in df.groupBy(SUBSET).count().collect()}


def store_subsets(
    df: DataFrame, column: str, subsets: Sequence[str], path: str, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, RowLedger]:
    """Write ``df`` to ``path`` by subsets of ``column`` and say how many rows each step saw.

    Named values are subsets of their own; all others and missing values are one.
    ``prepare`` works on the labelled rows before they are written and should keep
    their number. The feed is read once. Should a count differ, rows are counted
    anew before anyone is told: a stage that ran again after a lost executor may
    have filled its accumulators twice, which a plain count does not.
    """
    spark, ledger = df.sparkSession, RowLedger(subsets)
    label = F.when(F.col(column).isin(list(subsets)), F.col(column)).otherwise(F.lit(OTHER))
    split = ledger.watch(ledger.watch(df, "read").withColumn(SUBSET, label), "split", SUBSET)
    ready = prepare(split) if prepare else split
    written = ledger.watch(ready, "written", SUBSET)
    written.hint("rebalance", SUBSET).write.mode("overwrite").partitionBy(SUBSET).parquet(path)
    stored = spark.read.schema(ready.schema).parquet(path)
    ledger.put("stored", _by_subset(stored))
    if ledger.offenders():
        counted = _by_subset(df.withColumn(SUBSET, label))
        ledger.put("read", {ALL: sum(counted.values())})
        ledger.put("split", counted)
        ledger.put("written", ledger.counts("stored"))
    return stored, ledger

"""Merge, delete and restate against a partitioned parquet table.

There is no transactional table format here. Every change is first computed
into a staged table in the shared folder, then put in place partition by
partition; a run that dies before that step has changed nothing, and one that
dies within it is repaired by running it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger import session
from promoledger.functions import keys
from promoledger.operators import mutation
from promoledger.sinks.writers import SALES_PARTITIONS, overwrite_partitions, replace_slice
from promoledger.sources import storage

# Columns that differ between two runs of the same load.
LOAD_TIMES = ("insert_ts", "update_ts")


def upsert_days(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    day: int,
    on: Sequence[str] = mutation.SALES_KEYS,
    keep: Sequence[str] = mutation.KEPT_ON_UPDATE,
    partition_cols: Sequence[str] = SALES_PARTITIONS,
) -> None:
    """Daily merge: a reload of ``day`` drops the newest batch of the last week, then the rows merge.

    Matches are searched in the partitions of today and yesterday only. Inserts
    dated elsewhere join the rows of their own partition, where rows that an
    earlier run of the same load left (equal but for the load times) make way, so
    that running a load again after a failure, or loading a day twice, changes
    nothing more. All touched partitions are put in place by one write. The table is
    partitioned by day, so that whole folders are in or out of the merge.
    """
    if "time_key" not in partition_cols:
        raise ValueError("upsert_days needs time_key among the partition columns")
    if not storage.exists(spark, path):
        overwrite_partitions(source, path, partition_cols)
        return
    table = spark.read.parquet(path)
    if not table.filter(F.col("time_key") == int(day)).isEmpty():
        first, last = keys.day_window(day, 7)
        week = F.col("time_key").between(first, last)
        replace_slice(mutation.delete_latest_batch(table.filter(week), first, last), path, week, partition_cols)
        table = spark.read.schema(table.schema).parquet(path)
    scope = F.coalesce(F.col("time_key").isin([int(day), keys.shift_day(day, -1)]), F.lit(False))
    scoped, incoming = table.filter(scope), source.select(*table.columns)
    merged = mutation.upsert(scoped, incoming, on, keep, hot=mutation.hot_keys(scoped, incoming, on))
    staged, staged_path = session.stage(merged, "upsert")
    try:
        late = staged.filter(~scope)
        # Folders that late rows fall into: at most one entry a day.
        folders = [row.asDict() for row in late.select(*partition_cols).distinct().toLocalIterator()]
        touched = F.lit(False)
        for folder in folders:
            own = F.lit(True)
            for name, value in folder.items():
                own = own & F.col(name).eqNullSafe(F.lit(value))
            touched = touched | own
        content = staged.filter(scope)
        if folders:
            compared = [c for c in table.columns if c not in LOAD_TIMES]
            old = table.filter(~scope & touched)
            again = late.select(*[F.col(c).alias(f"__{c}") for c in compared]).distinct()
            stays = old.join(again, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in compared], "left_anti")
            content = content.unionByName(stays).unionByName(late)
        replace_slice(content, path, scope | touched, partition_cols)
    finally:
        storage.delete_folder(spark, staged_path)


def restate_returns_in_place(
    spark: SparkSession,
    path: str,
    day: int | None = None,
    month: int | None = None,
    batch_ts: Column | None = None,
    partition_cols: Sequence[str] = SALES_PARTITIONS,
) -> None:
    """Move returned lines to the partitions of their originals; only folders that lose or gain rows are rewritten."""
    fact = spark.read.parquet(path)
    current = int(month) if month is not None else int(day) // 100
    months = [keys.previous_month(current), current]
    returned = F.col("month_id") == current
    if day is not None:
        returned = returned & (F.col("time_key") == int(day))
    returns, returns_path = session.stage(mutation.returned_lines(fact, returned), "returns")
    source, source_path = session.stage(mutation.restatement_source(fact, returns, months), "restated")
    scoped = fact.filter(F.col("month_id").isin(months))
    moving = scoped.join(source, ["invoice_number", "product_code"], "left_semi")
    # At most one entry per day of the two months.
    touched = sorted(
        {
            row[0]
            for row in moving.select("time_key")
            .unionByName(source.select(F.col("__dates.time_key").alias("time_key")))
            .distinct()
            .toLocalIterator()
        }
    )
    if touched:
        scope = F.col("month_id").isin(months) & F.col("time_key").isin(touched)
        replace_slice(
            mutation.apply_restatement(fact.filter(scope), source, batch_ts), path, scope, partition_cols
        )
    for used in (returns_path, source_path):
        storage.delete_folder(spark, used)

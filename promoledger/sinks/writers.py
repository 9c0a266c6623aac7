"""Write paths. Rows are laid out with the rebalance hint: AQE merges small partitions and splits hot
ones, so neither a tiny master nor a day that holds a third of all rows ends up badly sized."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger import session
from promoledger.functions import keys
from promoledger.sources import storage

SALES_PARTITIONS = ("year_id", "month_id", "time_key")


def overwrite_partitions(df: DataFrame, path: str, partition_cols: Sequence[str] = SALES_PARTITIONS) -> None:
    """Replace exactly the partitions that occur in ``df``; others stay."""
    (
        df.hint("rebalance", *partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def append_partitions(df: DataFrame, path: str, partition_cols: Sequence[str] = SALES_PARTITIONS) -> None:
    """Backfill: one partitioned write of all periods."""
    df.hint("rebalance", *partition_cols).write.mode("append").partitionBy(*partition_cols).parquet(path)


BATCH = "batch_id"


def batch_digest(df: DataFrame) -> str:
    """An identity for the content of a batch, whatever the order of its rows: their number and two sums of their hashes."""
    own = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    seeded = F.xxhash64(F.lit("batch"), *[F.col(f"`{c}`") for c in df.columns])
    found = df.agg(F.count(F.lit(1)), F.bit_xor(own), F.sum(seeded.cast("decimal(20,0)"))).first()
    return hashlib.sha256(repr(tuple(str(x) for x in found)).encode()).hexdigest()[:16]


def append_batch(df: DataFrame, path: str, batch_id: str, partition_cols: Sequence[str] = SALES_PARTITIONS) -> None:
    """Append the rows of one batch, marked as such; rows that an earlier run of the same batch left make way.

    Other batches keep their rows, also in the folders that both write to. A first
    run only adds files. A run that repeats a batch, or a part of it after a
    failure, adds its files and then removes those that held the batch before; if
    it breaks off in between, the next run removes both. Where daily loads have put
    rows of others into such a file, the folders of the batch are rewritten from
    staged rows instead, so that run may be repeated as well.
    """
    spark = df.sparkSession
    mine = df.withColumn(BATCH, F.lit(batch_id))
    old = spark.read.parquet(path) if storage.exists(spark, path) else None
    held = []
    if old is not None and BATCH in old.columns:
        own = F.coalesce(F.col(BATCH) == batch_id, F.lit(False))
        files = old.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.bool_or(own).alias("own"), F.bool_or(~own).alias("shared"))
        # At most one entry a file of the batch.
        held = files.filter("own").collect()
    if not any(f["shared"] for f in held):
        append_partitions(mine, path, partition_cols)
        storage.delete_files(spark, [f["file"] for f in held])
        return
    again = old.filter(F.col(BATCH) == batch_id).select(*partition_cols).distinct()
    # At most one entry a folder of the batch.
    folders = [tuple(r) for r in again.unionByName(mine.select(*partition_cols).distinct()).distinct().toLocalIterator()]
    scope = F.lit(True)
    for at, name in enumerate(partition_cols):
        values = {f[at] for f in folders}
        known = F.coalesce(F.col(name).isin(sorted(values - {None})), F.lit(False))
        scope = scope & (known | F.col(name).isNull() if None in values else known)
    others = old.filter(scope & ~F.coalesce(F.col(BATCH) == batch_id, F.lit(False)))
    replace_slice(others.unionByName(mine.select(*old.columns)), path, scope, partition_cols)


def replace_slice(
    df: DataFrame, path: str, scope: Column, partition_cols: Sequence[str] = SALES_PARTITIONS
) -> None:
    """Make ``df`` the only content of the partitions selected by ``scope``.

    ``scope`` is a predicate on partition columns and every row of ``df`` must
    satisfy it. ``df`` may read from ``path``: it is staged first. Partitions in
    scope that get no row are removed, which a dynamic overwrite alone never does.
    """
    spark = df.sparkSession
    names = list(partition_cols)
    # Folders in scope before the change. Filtering behind the distinct makes a scope on any other
    # column an analysis error, which would otherwise take rows outside the scope along.
    before = spark.read.parquet(path).select(*names).distinct().filter(scope) if storage.exists(spark, path) else None
    staged, staged_path = session.stage(df, "slice")
    try:
        stale: list[str] = []
        if before is not None:
            after = staged.select(*[F.col(k).alias(f"__{k}") for k in names]).distinct()
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in names]
            stale = [
                "/".join([path.rstrip("/"), *[f"{k}={_folder_value(spark, row[k])}" for k in names]])
                for row in before.join(after, same, "left_anti").toLocalIterator()
            ]
        overwrite_partitions(staged, path, partition_cols)
        for folder in stale:
            storage.delete_folder(spark, folder)
    finally:
        storage.delete_folder(spark, staged_path)


def replace_folder(df: DataFrame, path: str, column: str, value: str) -> None:
    """Make ``df`` the whole content of the folder of one value; without rows the folder goes. Other folders are not touched."""
    if df.isEmpty():
        storage.delete_folder(df.sparkSession, f"{path.rstrip('/')}/{column}={_folder_value(df.sparkSession, value)}")
    else:
        overwrite_partitions(df.withColumn(column, F.lit(value)), path, (column,))


def _folder_value(spark: SparkSession, value) -> str:
    """How Spark writes a partition value into a folder's name: null and empty have a name of their own."""
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))


def reload_months(
    df: DataFrame, path: str, month_ids: Sequence[int], partition_cols: Sequence[str] = ("year_id", "month_id")
) -> None:
    """Period reload: whatever the months held before is gone, all other months stay."""
    scope = F.col("month_id").isin([int(m) for m in month_ids])
    replace_slice(df.filter(scope), path, scope, partition_cols)


def write_small(df: DataFrame, path: str) -> None:
    """Unpartitioned master or dimension: few files while it is small, more when it grows."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)


def in_window(df: DataFrame, key: str, first: int, last: int, date: str | None = None) -> DataFrame:
    """Rows of a key window; with the stored date, of which days are keys, found by its range."""
    window = df.filter(F.col(key).between(first, last))
    return window if date is None else window.filter(keys.day_range(date, first, last)).drop(date)


def export_window(
    df: DataFrame, path: str, key: str, first: int, last: int, files: int | None = None, date: str | None = None
) -> None:
    """Overwrite ``path`` with the rows of a key window, leaving part files only (no success marker).

    With ``files`` the row count per file is even; without it AQE sizes the files.
    With the stored ``date`` that a day key comes from, only the window's files are
    read; that column is not exported.
    """
    window = in_window(df, key, first, last, date)
    window = window.repartition(files) if files else window.hint("rebalance")
    (
        window.write.mode("overwrite")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .parquet(path)
    )


def write_exceptions(offenders: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """Headed CSV of offending rows, written only when there are any."""
    if offenders.isEmpty():
        return False
    offenders.hint("rebalance").write.mode(mode).option("header", True).csv(path)
    return True


def append_exceptions(offenders: DataFrame, path: str, run: str) -> None:
    """Headed CSV of offending rows by run: other runs' rows stay, a run that is repeated replaces its own."""
    spark = offenders.sparkSession
    if offenders.isEmpty():
        storage.delete_folder(spark, f"{path.rstrip('/')}/run={_folder_value(spark, run)}")
        return
    marked = offenders.withColumn("run", F.lit(run)).hint("rebalance", "run")
    marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True).partitionBy("run").csv(path)


def insert_exceptions(offenders: DataFrame, table: str) -> None:
    """Truncate and insert into a declared table of offending rows: it holds those of the last run alone, under its own columns."""
    offenders.select(*offenders.sparkSession.table(table).columns).hint("rebalance").write.insertInto(table, overwrite=True)


def write_exception_table(offenders: DataFrame, path: str) -> None:
    """Truncate-and-insert table of offending rows, present even when empty."""
    offenders.hint("rebalance").write.mode("overwrite").parquet(path)


def write_copies(df: DataFrame, csv_path: str, parquet_path: str) -> None:
    """The same rows as headless CSV and as parquet. The parquet copy is the source of the CSV,
    so columns whose values are random per evaluation (cipher text) agree between the two."""
    df.hint("rebalance").write.mode("overwrite").parquet(parquet_path)
    df.sparkSession.read.schema(df.schema).parquet(parquet_path).write.mode("overwrite").csv(csv_path)


def table_ddl(name: str, schema: T.StructType, path: str, partition_cols: Sequence[str] = ()) -> str:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts} LOCATION '{path}'"


def register_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str, partition_cols: Sequence[str] = (), statistics: Sequence[str] = ()
) -> DataFrame:
    """Declare an external parquet table, pick up its partitions and compute its statistics.

    With the names of columns in ``statistics`` their ranges, nulls and distinct
    values are stored too; with ``spark.sql.cbo.enabled`` Spark sizes filters and
    joins by them. Called again it finds folders that were written since.
    """
    spark.sql(table_ddl(name, schema, path, partition_cols))
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    if statistics:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in statistics)}")
    return spark.table(name)

"""Daily and historical secondary-sales loads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger import schemas, session
from promoledger.functions import keys
from promoledger.operators.sales import conform_sales, enrich_sales
from promoledger.sinks import tables, writers
from promoledger.sources import readers, storage


@dataclass(frozen=True)
class SalesPaths:
    processed: str
    fact: str
    export: str


def load_day(
    spark: SparkSession,
    raw: DataFrame,
    salesman: DataFrame,
    product: DataFrame,
    day: int,
    paths: SalesPaths,
    country: str = "VN",
    batch_ts: Column | None = None,
) -> None:
    """Conform -> processed layer -> enrich -> merge -> restate returns -> export the last seven days."""
    writers.overwrite_partitions(conform_sales(raw, country, day).withColumn(writers.BATCH, F.lit(None).cast("string")), paths.processed)
    processed = readers.read_partition(
        spark, paths.processed, year_id=day // 10000, month_id=day // 100, time_key=day
    )
    enriched = schemas.conform(enrich_sales(processed, salesman, product, batch_ts), schemas.DAILY_SALES)
    tables.upsert_days(spark, paths.fact, enriched, day)
    tables.restate_returns_in_place(spark, paths.fact, day=day, batch_ts=batch_ts)
    first, last = keys.day_window(day, 7)
    writers.export_window(spark.read.parquet(paths.fact), paths.export, "time_key", first, last)


def load_history(
    spark: SparkSession,
    raw: DataFrame,
    salesman: DataFrame,
    product: DataFrame,
    paths: SalesPaths,
    country: str = "VN",
    batch_ts: Column | None = None,
    batch_id: str | None = None,
) -> str:
    """Add a batch of history to both layers, one partitioned write each; returns the batch's identity.

    The identity is carried by every row: a name, or else a digest of the batch's
    content. A batch may be run again: its own rows make way, those of other
    batches stay, on shared days too. Lines without a date go to a table of
    offenders beside the fact, under ``-undated``, with a folder for each batch.
    The fact comes from the batch's rows in the processed layer, as in daily loads;
    a named batch is not staged besides, so ``raw`` has to stay as it is meanwhile.
    """
    conformed = conform_sales(raw, country, keys_from_invoice_date=True)
    staged_path = None
    if batch_id is None:
        conformed, staged_path = session.stage(conformed, "history")
    try:
        batch = batch_id or writers.batch_digest(conformed)
        dated, undated = conformed.filter(F.col("time_key").isNotNull()), conformed.filter(F.col("time_key").isNull())
        writers.append_batch(dated, paths.processed, batch)
        stored = T.StructType([*dated.schema, T.StructField(writers.BATCH, T.StringType())])
        processed = spark.read.schema(stored).parquet(paths.processed).filter(F.col(writers.BATCH) == batch)
        enriched = schemas.conform(enrich_sales(processed, salesman, product, batch_ts), schemas.DAILY_SALES)
        writers.append_batch(enriched, paths.fact, batch)
        writers.replace_folder(undated, undated_path(paths), writers.BATCH, batch)
        return batch
    finally:
        if staged_path is not None:
            storage.delete_folder(spark, staged_path)


def undated_path(paths: SalesPaths) -> str:
    """Where backfills leave the lines that have no date."""
    return f"{paths.fact.rstrip('/')}-undated"

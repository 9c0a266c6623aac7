"""One month of promotions: ingest and harmonise, transform to the daily fact, aggregate to the month."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger import schemas, session
from promoledger.functions import rules
from promoledger.operators import dims, feed, monthly, promo, quality
from promoledger.operators.io_master import category_share
from promoledger.sinks import counted, writers
from promoledger.sources import storage

_CONTROL_MEASURES = {
    "value_based_promo_disc": "VBPD",
    "header_lvl_disc": "HLD",
    "free_qty_in_cs": "QTY_CS",
    "free_qty_in_pc": "QTY_PC",
}


@dataclass(frozen=True)
class Masters:
    """Dimensions and references of the processing month, already resolved to DataFrames."""

    article: DataFrame
    local_product: DataFrame
    outlets: DataFrame
    channels: DataFrame
    channel_map: DataFrame
    distributors: DataFrame
    dim_promotion: DataFrame
    io: DataFrame
    split: DataFrame
    gift_price: DataFrame
    gift_master: DataFrame
    coded: DataFrame


@dataclass(frozen=True)
class PromoPaths:
    processed: str
    daily: str
    monthly: str
    export: str
    exceptions: str


def ingest(
    raw: DataFrame, control: DataFrame, calendar: DataFrame, masters: Masters, paths: PromoPaths, threshold: float
) -> None:
    """Raw export -> processed promotions, behind the load and control-total gates.

    The cleaned feed is written once, by subsets, with its rows counted on the way;
    every gate and the next layer read that table, so the raw files are parsed once.
    """
    spark = raw.sparkSession
    path = session.new_work_path(spark, "cleaned")
    try:
        stored, ledger = counted.store_subsets(feed.clean_promo_feed(raw, dims.site_list(masters.distributors)), "promotion_type", rules.FEED_SUBSETS, path)
        cleaned = stored.drop(counted.SUBSET)
        deltas = quality.control_total_deltas(cleaned, feed.clean_control_totals(control), _CONTROL_MEASURES)
        quality.run_checks(
            [
                quality.CheckResult("subset_counts", ledger.mismatches(spark)),
                quality.CheckResult("trading_days_without_sales", quality.trading_days_without_sales(calendar, cleaned)),
                quality.CheckResult("multi_distributor_sites", quality.multi_distributor_sites(cleaned)),
                quality.CheckResult("control_totals", deltas, quality.REPORT),
                quality.CheckResult("control_totals_breached", quality.breached(deltas, threshold)),
            ],
            paths.exceptions,
        )
        promos = feed.dedupe_loyalty(feed.harmonize_promo(cleaned, masters.article))
        writers.overwrite_partitions(schemas.conform(promos, schemas.PROCESSED_PROMO), paths.processed)
    finally:
        storage.delete_folder(spark, path)
    processed = spark.read.parquet(paths.processed)
    hierarchy = dims.standard_hierarchy(masters.local_product, masters.article)
    quality.run_checks(
        [
            quality.CheckResult(
                "missing_products",
                quality.missing_products(processed, masters.dim_promotion, hierarchy),
                quality.REPORT,
            ),
            quality.CheckResult(
                "missing_orders", quality.missing_orders(processed, masters.dim_promotion, masters.io), quality.REPORT
            ),
            quality.CheckResult(
                "brands_missing_in_masters",
                quality.brands_missing_in_masters(
                    processed, masters.dim_promotion, masters.io, masters.local_product, masters.article
                ),
                quality.REPORT,
            ),
        ],
        paths.exceptions,
    )


def build_daily(promos: DataFrame, masters: Masters, year: str | None = None, quarter: str | None = None) -> DataFrame:
    """Processed promotions -> typed daily promotion fact."""
    hierarchy = dims.standard_hierarchy(masters.local_product, masters.article)
    brands = promo.io_brands(masters.io, hierarchy)
    mapped = dims.channel_bridge(masters.outlets, masters.channels, masters.channel_map)
    off_lines = promo.dealt(promo.off_invoice_lines(promos, masters.dim_promotion, mapped))
    share = category_share(masters.split, year, quarter)
    off = promo.off_invoice_perstr(off_lines, share, brands).unionByName(promo.off_invoice_other(off_lines, brands))
    daily = promo.daily_promotions(
        promo.dealt(promo.on_invoice(promos, masters.dim_promotion, hierarchy, masters.io)),
        off,
        promo.gift_value(promos, brands, masters.gift_price, masters.gift_master, deal=True),
        promo.dealt(promo.unprocessed_mechanisms(promos)),
    )
    return promo.typed_daily_promotions(daily, dims.channel_bridge(masters.outlets, masters.channels))


def transform(
    spark: SparkSession, masters: Masters, paths: PromoPaths, month_id: int, quarter: str, threshold: float
) -> None:
    """Processed month -> daily fact (month reloaded), reconciled and exported."""
    month = F.col("month_id") == int(month_id)
    promos = spark.read.parquet(paths.processed).filter(month)
    quality.run_checks(
        [
            quality.CheckResult("unknown_types", quality.unknown_types(promos, masters.dim_promotion), quality.STOP),
            quality.CheckResult("unexpected_gifts", quality.unexpected_gifts(promos), quality.STOP),
        ]
    )
    daily = build_daily(promos, masters, str(month_id)[:4], quarter)
    writers.reload_months(daily, paths.daily, [month_id], writers.SALES_PARTITIONS)
    loaded = spark.read.parquet(paths.daily).filter(month)
    deltas = quality.processed_vs_transformed(promos, loaded)
    quality.run_checks([quality.CheckResult("layer_values", quality.breached_layers(deltas, threshold))])
    writers.export_window(loaded, f"{paths.export}/daily", "month_id", month_id, month_id)


def aggregate(
    spark: SparkSession, sales: DataFrame, masters: Masters, paths: PromoPaths, month_id: int, months: list[int]
) -> None:
    """Daily fact -> monthly aggregate (month reloaded), checked against the daily fact and exported."""
    month = F.col("month_id") == int(month_id)
    daily = spark.read.parquet(paths.daily).filter(month)
    sizes = monthly.store_size_codes(monthly.trailing_avg(sales, months), masters.coded)
    lookups = (masters.outlets, masters.distributors, masters.coded, sizes)
    rows = monthly.monthly_promotions(monthly.monthly_on(daily, *lookups), monthly.monthly_off(daily, *lookups))
    writers.reload_months(rows, paths.monthly, [month_id])
    loaded = spark.read.parquet(paths.monthly).filter(month)
    deltas = quality.daily_vs_monthly(daily, loaded)
    quality.run_checks([quality.CheckResult("daily_vs_monthly", quality.differing_layers(deltas))])
    writers.export_window(loaded, f"{paths.export}/monthly", "month_id", month_id, month_id)

"""Coded report axes and the trading calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.operators import coded_dims, dims
from promoledger.queries import views
from promoledger.queries.sales import outlet_channels


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = views.table(spark, sf_dir, "region").select(
        F.col("r_name").alias("region"), (F.col("r_regionkey") + 1).alias("region_code")
    )
    return coded_dims.coded_region(listed)


def dynamic_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report axes over region, channel, store size and category."""
    return coded_dims.dynamic_axis(
        regions(spark, sf_dir),
        coded_dims.coded_channel(outlet_channels(spark, sf_dir)),
        coded_dims.coded_store_size(views.store_sizes(spark)),
        coded_dims.coded_category(views.local_product(spark, sf_dir)),
    )


def promo_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotion axes: order priorities in detail, flags as summaries, segments as budget holders."""
    detailed = (
        views.table(spark, sf_dir, "orders")
        .select("o_orderpriority")
        .distinct()
        .select(
            F.lit("Detailed").alias("group"),
            F.col("o_orderpriority").alias("promo_type"),
            F.substring("o_orderpriority", 1, 1).alias("index"),
        )
    )
    summary = (
        views.table(spark, sf_dir, "lineitem")
        .select("l_returnflag")
        .distinct()
        .select(F.col("l_returnflag").alias("promo_summarized"), F.ascii("l_returnflag").alias("summarized_index"))
    )
    holders = coded_dims.coded_budget_holder(
        views.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("budget_holder_grp"))
    )
    return coded_dims.promo_axis(detailed, summary, holders)


def trading_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.trading_calendar(views.dim_time(spark, sf_dir))


def scope_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites and distributors in scope."""
    known = views.distributors(spark, sf_dir)
    sites = dims.site_list(known).select(F.lit("site").alias("kind"), F.col("site_code").alias("code"))
    traders = dims.distributor_list(known).select(
        F.lit("distributor").alias("kind"), F.col("distributor_code").alias("code")
    )
    return sites.unionByName(traders)


QUERIES = {
    "dynamic_axis": dynamic_axis,
    "promo_axis": promo_axis,
    "trading_calendar": trading_calendar,
    "scope_lists": scope_lists,
}

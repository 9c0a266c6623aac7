"""Monthly sales aggregate of the scoped sites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from promoledger import schemas
from promoledger.functions import keys
from promoledger.operators import dims
from promoledger.operators.joins import spread_join
from promoledger.operators.monthly import store_size_codes, trailing_avg
from promoledger.operators.sales import monthly_sales
from promoledger.plans.promotion_month import Masters
from promoledger.sinks import writers


def scoped_sales(fact: DataFrame, distributors: DataFrame) -> DataFrame:
    """Sales of the listed sites."""
    sites = dims.site_list(distributors).withColumnRenamed("site_code", "transactional_site_code")
    return spread_join(fact, sites, "transactional_site_code", "left_semi")


def load_month(spark: SparkSession, fact: DataFrame, masters: Masters, month_id: int, path: str, export: str) -> None:
    """Roll a month up and reload it; other months of the aggregate stay."""
    scoped = scoped_sales(fact, masters.distributors)
    sizes = store_size_codes(trailing_avg(scoped, keys.trailing_months(month_id)), masters.coded)
    rows = monthly_sales(
        scoped,
        month_id,
        dims.standard_hierarchy(masters.local_product, masters.article),
        masters.distributors,
        dims.channel_bridge(masters.outlets, masters.channels),
        masters.outlets,
        sizes,
        masters.coded,
    )
    writers.reload_months(schemas.conform(rows, schemas.MONTHLY_SALES), path, [month_id])
    writers.export_window(spark.read.parquet(path), export, "month_id", month_id, month_id)

"""Dimensions: standard product hierarchy, outlet-to-channel bridge, scope lists, trading calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoledger.functions import rules
from promoledger.operators.joins import spread_join

# Columns of the staged product hierarchy file -> our names (fixed values of that file).
LOCAL_PRODUCT_COLUMNS = {
    "Material": "product_code",
    "PH9": "PH9_code",
    "PH9_Desc": "PH9_description",
    "PH7": "PH7_code",
    "CD DP Name": "dp_name",
    "Portfolio": "cotc",
    "Brand": "brand",
    "Segment": "segment",
    "Small C": "category",
    "Big C": "division",
}


def local_product_view(staged: DataFrame) -> DataFrame:
    return staged.select(*[F.col(f"`{old}`").alias(new) for old, new in LOCAL_PRODUCT_COLUMNS.items()])


def standard_hierarchy(local_product: DataFrame, article: DataFrame) -> DataFrame:
    """Products with their brand, master categories, representative product and banded flag.

    The brand is hierarchy level 7 of the article master; each brand is
    represented by its lowest product code. Unassigned products are left out.
    """
    lph = local_product.filter(F.col("dp_name") != "Not Assigned")
    am = article.select(
        F.col("material_code").alias("product_code"),
        "material_desc",
        F.col("PH7_code").alias("__ph7"),
        "PH3_description",
        "PH4_description",
        "PH5_description",
        "PH7_description",
        "PH8_description",
    )
    joined = lph.join(am, "product_code", "left").withColumn("brand_code", rules.or_missing("__ph7"))
    representative = joined.groupBy("brand_code").agg(F.min("product_code").alias("standard_product_group_code"))
    flagged = joined.select(
        "product_code",
        rules.or_missing("material_desc").alias("product_desc"),
        "dp_name",
        "brand_code",
        rules.or_missing("PH7_description").alias("brand"),
        rules.or_missing("PH3_description").alias("master_product_category"),
        rules.or_missing("PH4_description").alias("master_market"),
        rules.or_missing("PH5_description").alias("master_brand"),
        rules.or_missing("PH8_description").alias("banded_PH8"),
        rules.or_missing("PH9_code").alias("lead_basepack_code"),
        rules.or_missing("PH9_description").alias("lead_basepack_desc"),
        rules.or_missing("category").alias("category"),
        rules.or_missing("division").alias("division"),
        F.when(rules.is_banded("material_desc", "PH8_description"), "Banded").otherwise("Non-Banded").alias("banded"),
    )
    return spread_join(flagged, representative, "brand_code")


def brand_attributes(hierarchy: DataFrame) -> DataFrame:
    """One row per distinct (brand, representative product, category, market)."""
    return hierarchy.select(
        "brand_code", "standard_product_group_code", "master_product_category", "master_market"
    ).distinct()


def brand_categories(local_product: DataFrame) -> DataFrame:
    """Distinct (brand code, category) pairs of the local hierarchy."""
    return local_product.select(F.col("PH7_code").alias("brand_code"), "category").distinct()


def reporting_channel(channel: str, group_channel: str) -> Column:
    """Professional outlets report under their group, all others under their own channel."""
    return F.when(F.upper(group_channel) == "PROFESSIONAL", "PROFESSIONAL").otherwise(F.col(channel))


def channel_bridge(outlets: DataFrame, channels: DataFrame, channel_map: DataFrame | None = None) -> DataFrame:
    """Distinct (outlet, reporting channel). With a map, channels it does not list become NA."""
    bridged = (
        outlets.select("outlet_code", "channel")
        .join(channels.select("channel", "group_channel"), "channel")
        .select("outlet_code", reporting_channel("channel", "group_channel").alias("channel"))
        .distinct()
    )
    if channel_map is None:
        return bridged
    mapped = channel_map.select(F.col("channel_org").alias("channel"), F.col("channel").alias("__mapped"))
    return (
        bridged.join(mapped, "channel", "left")
        .select("outlet_code", rules.or_missing("__mapped").alias("channel"))
        .distinct()
    )


def trading_calendar(time: DataFrame, month_id: int | None = None) -> DataFrame:
    """Days of a month (or all) with their trading flag, in day order."""
    days = time.select(
        F.col("Dt").alias("time_key"),
        F.col("year_month").cast("int").alias("year_month"),
        F.col("Trading_day").alias("trading_day"),
    )
    if month_id is not None:
        days = days.filter(F.col("year_month") == int(month_id))
    return days.orderBy("time_key")


def _in_scope(distributors: DataFrame, country: str, distributor_type: str) -> DataFrame:
    return distributors.filter(
        (F.col("country_code") == country) & (F.col("distributor_type") == distributor_type)
    )


def site_list(distributors: DataFrame, country: str = "VN", distributor_type: str = "C10000") -> DataFrame:
    return _in_scope(distributors, country, distributor_type).select("site_code").distinct()


def distributor_list(distributors: DataFrame, country: str = "VN", distributor_type: str = "C10000") -> DataFrame:
    scoped = _in_scope(distributors, country, distributor_type)
    return scoped.filter(F.col("distributor_code").isNotNull()).select("distributor_code").distinct()

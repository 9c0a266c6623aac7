"""Daily secondary sales: conform, enrich, restate onto masters, roll up to months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoledger import schemas
from promoledger.functions import keys, parse, rules
from promoledger.operators.joins import SALT, spread_join

# Conformed column -> source column (fixed values of the feed contract).
_DESCRIPTORS = {
    "country_code": "CountryCode",
    "invoice_number": "InvoiceNumber",
    "transactional_distributor_code": "DistributorCode",
    "transactional_site_code": "SiteCode",
    "transactional_outlet_code": "OutletCode",
    "transactional_salesman_code": "SalesmanCode",
    "invoicetype": "InvoiceType",
    "customer_ZRSS_flag": "CustomerZRSSFlag",
    "sales_ret_ref_invoice_number": "SalesReturnReferenceInvoiceNumber",
}
_VALUES = {
    "net_invoice_val": "NetInvoiceValue",
    "gross_sales_return_val": "GrossSalesWithReturnValue",
    "sales_return_val": "SalesReturnValue",
    "on_invoice_discount_val": "OnInvoiceDiscountValue",
    "value_added_tax": "ValueAddedTax",
    "off_inv_discount_val": "OffInvoiceDiscountValue",
    "turn_over_val": "TurnoverValue",
    "sales_cs_vol": "SalesCSVolume",
    "sales_kg_vol": "SalesKGVolume",
    "sales_lt_vol": "SalesLTVolume",
}
_QUANTITIES = {
    "sales_with_return_pc_qty": "SalesWithReturnPCQuantity",
    "sales_return_pc_qty": "SalesReturnPCQuantity",
    "sales_pc_qty": "SalesPCQuantity",
    "free_pc_qty": "FreePCQuantity",
}


def conform_sales(
    raw: DataFrame, country: str = "VN", day: int | None = None, keys_from_invoice_date: bool = False
) -> DataFrame:
    """Raw invoice lines -> conformed daily sales.

    The date keys come from the load folder columns (YYYY, MM, DD) or, for a
    backfill, from the invoice date. Missing and malformed measures become 0.
    """
    lines = raw.filter(F.col("CountryCode") == country)
    if keys_from_invoice_date:
        year, month, full = (f(F.col("InvoiceDate")) for f in (keys.year_key, keys.month_key, keys.time_key))
    else:
        if day is not None:
            text = str(day)
            # Folder columns stay bare in the predicate so that it prunes folders.
            lines = lines.filter(
                (F.col("YYYY") == text[:4]) & (F.col("MM") == text[4:6]) & (F.col("DD") == text[6:])
            )
        year = F.col("YYYY").cast("int")
        month = F.concat("YYYY", "MM").cast("int")
        full = F.concat("YYYY", "MM", "DD").cast("int")
    gross = F.coalesce(F.col("GrossSalesValue").try_cast("double") * 100, F.lit(0.0))
    return lines.select(
        *[F.col(source).alias(name) for name, source in _DESCRIPTORS.items()],
        keys.last_chars("ArticleCode", 8).alias("product_code"),
        F.concat("SiteCode", F.lit("_"), F.year("InvoiceDate").cast("string")).alias("site_code_year"),
        F.col("InvoiceDate").alias("invoice_date"),
        gross.alias("gross_sales_val"),
        (gross / 1_000_000).alias("gross_sales_val_mn"),
        *[parse.measure(source).alias(name) for name, source in _VALUES.items()],
        *[parse.measure(source, "int").alias(name) for name, source in _QUANTITIES.items()],
        *[F.col(c) for c in ("BDLLoadTimestamp", "BDLUpdateTimestamp") if c in raw.columns],
        year.alias("year_id"),
        month.alias("month_id"),
        full.alias("time_key"),
    )


def enrich_sales(
    fact: DataFrame,
    salesman: DataFrame,
    product: DataFrame,
    batch_ts: Column | None = None,
    salesman_codes: Sequence[str] = (),
    product_codes: Sequence[str] = (),
) -> DataFrame:
    """Add salesforce, brand attributes, date keys of the invoice and the batch time.

    Dimensions are reduced to distinct attribute rows first, so repeated master
    rows do not multiply invoice lines. ``salesman_codes`` and ``product_codes``
    are further columns of the two that the lines take along, such as the codes
    that ``monthly_sales`` would have to join to its sums.
    """
    sm = salesman.select(
        F.col("salesman_code").alias("transactional_salesman_code"), "salesforce", *salesman_codes
    ).distinct()
    pd = product.select(
        "product_code",
        "brand",
        "category_code",
        F.concat("brand", F.lit("_"), "category_code", F.lit("_"), "cotc").alias("brand_cat_core"),
        *product_codes,
    ).distinct()
    ts = batch_ts if batch_ts is not None else F.current_timestamp()
    joined = fact.join(sm, "transactional_salesman_code", "left").join(pd, "product_code", "left")
    return joined.withColumns(
        {
            "year_id": keys.year_key("invoice_date"),
            "month_id": keys.month_key("invoice_date"),
            "time_key": keys.time_key("invoice_date"),
            "insert_ts": ts,
            "update_ts": ts,
        }
    )


def master_restatement(
    fact: DataFrame, outlet_map: DataFrame, salesman: DataFrame, product: DataFrame, outlet_spg: DataFrame
) -> DataFrame:
    """Re-key sales onto master outlets, sites and distributors; unmapped outlets keep their own codes.

    Also adds the product's division and the sales group that serves the master
    outlet in that division. Join keys are padded in the small side, so the fact
    joins on a bare column.
    """
    om = outlet_map.select(
        keys.pad_code("old_outlet_code").alias("transactional_outlet_code"),
        keys.pad_code("master_outlet_code").alias("__outlet"),
        F.col("master_distributor_code").alias("__distributor"),
        F.col("master_site_code").alias("__site"),
    )
    sm = salesman.select(
        F.col("salesman_code").alias("transactional_salesman_code"),
        "salesman_product_group_code",
        F.col("standardised_salesman_product_group").alias("transactional_spg"),
        parse.measure("no_of_salespersons_serving_outlet_in_this_spg", "int").alias("__persons"),
    )
    pd = product.select("product_code", "division")
    spg = outlet_spg.select("master_outlet_code", "division", "master_spg", "master_salesman_code")
    restated = (
        fact.join(om, "transactional_outlet_code", "left")
        .join(sm, "transactional_salesman_code", "left")
        .join(pd, "product_code", "left")
        .withColumns(
            {
                "master_outlet_code": F.coalesce("__outlet", "transactional_outlet_code"),
                "master_distributor_code": F.coalesce("__distributor", "transactional_distributor_code"),
                "master_site_code": F.coalesce("__site", "transactional_site_code"),
                "no_of_salespersons": F.coalesce("__persons", F.lit(0)),
            }
        )
        .drop("__outlet", "__distributor", "__site", "__persons")
    )
    return restated.join(spg, ["master_outlet_code", "division"], "left")


def monthly_sales(
    fact: DataFrame,
    month_id: int | None,
    hierarchy: DataFrame,
    distributors: DataFrame,
    outlet_channels: DataFrame,
    outlets: DataFrame,
    store_sizes: DataFrame,
    coded: DataFrame,
    excluded_prefix: str = "75",
) -> DataFrame:
    """Month-end sales with coded channel, store size, perfect-store, region and banded attributes.

    Intent kept where the source job slips: days are rolled up to the month end
    *before* grouping, the region comes from the site (a distributor has several),
    and the perfect-store code follows the outlet's Y/N.

    The fact is aggregated first, on its own columns; every added attribute
    depends on one of them, so the (much smaller) result is what gets joined.
    Where the sums are no fewer than the lines and much wider, the lines should
    bring their codes (``PRODUCT_CODES``, ``SITE_CODES``, ``OUTLET_CODES``) along
    from joins of narrower or fewer rows: codes that ``fact`` has are grouped by
    and not joined again. ``month_id=None`` rolls up every month.
    """
    scoped = fact if month_id is None else fact.filter(F.col("month_id") == int(month_id))
    # Coalesced up front: a missing code is reported as NA and must pass the prefix test.
    scoped = scoped.withColumn("product_code", rules.or_missing("product_code")).filter(
        ~F.col("product_code").startswith(excluded_prefix)
    )
    group = [
        "country_code",
        "product_code",
        "invoice_number",
        "site_code_year",
        "transactional_distributor_code",
        "transactional_site_code",
        "transactional_outlet_code",
        "invoice_date",
        "transactional_salesman_code",
        "invoicetype",
        "customer_ZRSS_flag",
        "salesforce",
        "brand",
        "category_code",
        "brand_cat_core",
        "year_id",
        "month_id",
    ]
    group = [c for c in [*group, *PRODUCT_CODES, *SITE_CODES, *OUTLET_CODES, SALT] if c in fact.columns]
    measures = [c for c in schemas.SALES_MEASURES if c in fact.columns]
    monthly = (
        scoped.withColumn("time_key", keys.month_end_key("time_key"))
        .groupBy(*group, "time_key")
        .agg(*[F.sum(c).alias(c) for c in measures])
        .drop(SALT)
    )
    return code_sales(monthly, hierarchy, distributors, outlet_channels, outlets, store_sizes, coded)


# What month rows take from the masters of their product, site and outlet.
PRODUCT_CODES = ("standard_product_group_code", "banded")
SITE_CODES = ("region",)
OUTLET_CODES = ("channel_code", "store_size_code", "perfect_store_status_code", "outlet_copies")


def product_groups(hierarchy: DataFrame) -> DataFrame:
    """Sales group and banded mark of the products."""
    return hierarchy.select("product_code", *PRODUCT_CODES).distinct()


def site_regions(distributors: DataFrame) -> DataFrame:
    """One region per site."""
    return distributors.groupBy("site_code").agg(F.min("dt_region").alias("region"))


def outlet_report_codes(outlets: DataFrame, outlet_channels: DataFrame, store_sizes: DataFrame, coded: DataFrame) -> DataFrame:
    """Distinct report codes of the outlets. ``outlet_copies`` says how often the masters repeat a row: a month row is shown as often."""
    channel_codes = coded.filter(F.col("ref_type") == "CHANNEL").select(
        F.col("ref_desc").alias("channel"), F.col("ref_code").alias("channel_code")
    )
    perfect_codes = coded.filter(F.col("ref_type") == "PERFECT_STORE").select(
        F.substring("ref_desc", 1, 1).alias("perfect_store"), F.col("ref_code").alias("perfect_store_status_code")
    )
    return (
        outlets.select("outlet_code", "perfect_store")
        .distinct()
        .join(outlet_channels.select("outlet_code", "channel"), "outlet_code", "left")
        .join(store_sizes.select("outlet_code", "store_size_code"), "outlet_code", "left")
        .join(channel_codes, "channel", "left")
        .join(perfect_codes, "perfect_store", "left")
        .groupBy("outlet_code", *OUTLET_CODES[:3])
        .agg(F.count(F.lit(1)).alias("outlet_copies"))
    )


def code_sales(
    monthly: DataFrame,
    hierarchy: DataFrame,
    distributors: DataFrame,
    outlet_channels: DataFrame,
    outlets: DataFrame,
    store_sizes: DataFrame,
    coded: DataFrame,
) -> DataFrame:
    """Attach the codes of product, site and outlet that aggregated sales do not carry yet (one row in, one row out)."""
    out = monthly
    if not set(PRODUCT_CODES) <= set(monthly.columns):
        out = spread_join(out, product_groups(hierarchy), "product_code")
    if not set(SITE_CODES) <= set(monthly.columns):
        region = site_regions(distributors).withColumnRenamed("site_code", "transactional_site_code")
        out = spread_join(out, region, "transactional_site_code")
    if not set(OUTLET_CODES) <= set(monthly.columns):
        codes = outlet_report_codes(outlets, outlet_channels, store_sizes, coded)
        out = spread_join(out, codes.withColumnRenamed("outlet_code", "transactional_outlet_code"), "transactional_outlet_code")
    out = out.withColumn("outlet_copies", F.explode(F.sequence(F.lit(1), F.coalesce("outlet_copies", F.lit(1)).cast("int")))).drop("outlet_copies")
    return out.withColumns(
        {
            "channel_code": F.coalesce(F.col("channel_code").cast("int"), F.lit(0)),
            "store_size_code": F.col("store_size_code").cast("int"),
            "region_code": F.lit(0),
            "banded_code": rules.one_zero(F.col("banded") == "Banded"),
            "banded": rules.or_missing("banded"),
        }
    )

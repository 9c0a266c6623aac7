"""Promotion queries: feed, allocation, daily and monthly facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.operators import dims, feed, io_master, monthly, promo
from promoledger.operators.joins import spread_join
from promoledger.queries import views
from promoledger.queries.sales import code_table, size_table
from promoledger.queries.shape import ratio, rows, total, whole
from promoledger.sources import storage

VALUES = promo.VALUES


def feed_distinct_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export text with repeated lines, header rows and total rows -> distinct typed lines of listed sites."""
    shown = F.format_number(F.col("l_extendedprice"), 2)
    signed = F.when(F.col("l_returnflag") == "R", F.concat(shown, F.lit("-"))).otherwise(shown)
    item = views.table(spark, sf_dir, "lineitem")
    empty = F.lit(None).cast("string")
    lines = item.select(
        F.when(F.col("l_linestatus") == "O", "vn").otherwise("VN").alias("country"),
        F.date_format("l_shipdate", "dd.MM.yyyy").alias("calendar_day"),
        views.text("l_suppkey").alias("distributor"),
        views.text("l_suppkey").alias("site"),
        views.text("l_suppkey").alias("outlet"),
        views.text("l_orderkey").alias("billing_document"),
        F.col("l_linestatus").alias("billing_type"),
        views.text("l_linenumber").alias("billing_item"),
        views.product_code("l_partkey").alias("product"),
        F.concat(F.lit("LN"), views.scheme()).alias("promotion_id"),
        F.lit("promotion").alias("promotion_desc1"),
        F.lit("01.01.1995").alias("promo_start_date"),
        F.lit("31.12.2001").alias("promo_end_date"),
        F.col("l_returnflag").alias("promotion_type"),
        signed.alias("value_based_promo_disc"),
        F.col("l_quantity").cast("string").alias("free_qty_in_cs"),
        # every line arrives twice
        F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"),
    )
    nation = views.table(spark, sf_dir, "nation")
    header = nation.select(F.lit("Country").alias("country"), F.lit("Calendar day").alias("calendar_day"))
    footer = nation.select(F.lit("VN").alias("country"), F.lit("Overall Result").alias("calendar_day"))
    raw = lines.drop("copy")
    for junk in (header, footer):
        raw = raw.unionByName(junk, allowMissingColumns=True)
    raw = raw.withColumns(
        {
            c: empty
            for c in (
                "header_lvl_disc free_qty_in_pc free_qty_val_in_cs free_qty_val_in_pc free_qty_retail_price_cs "
                "free_qty_retail_price_pc"
            ).split()
        }
    )
    cleaned = feed.clean_promo_feed(raw, dims.site_list(views.distributors(spark, sf_dir)))
    return cleaned.select(
        "country",
        "time_key",
        "site_code",
        "invoice_no",
        "billing_item",
        "product_code",
        "promotion_mechanism",
        "promotion_type",
        F.round(F.col("value_based_promo_disc") * 100).cast("long").alias("value_cents"),
        whole("free_qty_in_cs"),
        whole("header_lvl_disc"),
    )


def harmonize_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valued promotion lines by type, mechanism and on/off flag."""
    valued = views.promos(spark, sf_dir)
    return valued.groupBy("promotion_type", "promotion_mechanism", "on_off_flag", "year_id").agg(
        rows(), *[total(c) for c in VALUES]
    )


def loyalty_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines after de-duplication: of loyalty one valued row per invoice and funding id, the others as they were."""
    deduped = feed.dedupe_loyalty(views.processed_promos(spark, sf_dir))
    return deduped.select(
        "promotion_type",
        "invoice_no",
        "IO",
        "product_code",
        "billing_item",
        "promotion_id",
        "time_key",
        *[whole(c) for c in VALUES],
        whole("free_qty_in_cs"),
        whole("free_qty_in_pc"),
    )


def bridge_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlets per reporting channel; unmapped channels fall under NA."""
    return views.bridge(spark, sf_dir).groupBy("channel").agg(rows("outlets"))


def std_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.build_hierarchy(spark, sf_dir).select(
        "product_code",
        "product_desc",
        "dp_name",
        "brand_code",
        "standard_product_group_code",
        "category",
        "division",
        "master_market",
        "lead_basepack_code",
        "banded",
    )


def latest_io_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two yearly order files: each customer keeps all rows of the newer file that knows them."""
    order = views.table(spark, sf_dir, "orders").select(
        views.text("o_custkey").alias("promotion_id"),
        F.col("o_orderpriority").alias("budget_holder"),
        F.col("o_orderstatus").alias("spend_type"),
        views.text("o_orderkey").alias("brand_code"),
        F.lit(0.0).alias("brand_percentage"),
        views.hundredths("o_totalprice").cast("double").alias("brand_investment"),
        views.hundredths("o_totalprice").cast("double").alias("investment_amount"),
        F.year("o_orderdate").alias("y"),
    )
    newer = order.filter(F.col("y") >= 2001)
    older = order.filter(F.col("y") < 2001)
    return io_master.latest_io(newer, older, 2001).select(
        "promotion_id", "brand_code", "budget_holder", whole("brand_investment")
    )


def brand_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Family 1 brands retired into their first brand; list value by remaining brand."""
    part = views.table(spark, sf_dir, "part")
    listed = part.select(
        F.col("p_brand").alias("brand_code"), views.hundredths("p_retailprice").alias("brand_investment")
    )
    retired = (
        part.select("p_brand")
        .distinct()
        .filter(views.family(views.brand_number()) == 1)
        .select(F.col("p_brand").alias("PH7_old"), F.lit("Brand#1").alias("PH7_latest"))
    )
    return io_master.remap_brand(listed, retired).groupBy("brand_code").agg(
        rows(), F.sum("brand_investment").alias("brand_investment")
    )


def io_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales by order priority and brand as investments; each brand's share of its order and category."""
    part = views.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    sold = views.lines(spark, sf_dir).select("l_partkey", "o_orderpriority", views.hundredths("l_extendedprice").alias("c"))
    invested = (
        sold.join(part, sold["l_partkey"] == part["p_partkey"])
        .groupBy("o_orderpriority", "p_brand")
        .agg(F.sum("c").cast("double").alias("brand_investment"))
    )
    holder = F.concat(F.lit("BH"), F.substring("o_orderpriority", 1, 1))
    order = invested.select(
        F.col("o_orderpriority").alias("promotion_id"),
        holder.alias("budget_holder"),
        F.lit("IO").alias("spend_type"),
        F.col("p_brand").alias("brand_code"),
        F.lit(None).cast("double").alias("brand_percentage"),
        "brand_investment",
        F.col("brand_investment").alias("investment_amount"),
    )
    # Category 5 is left unmapped, so its brands show up under NA.
    categories = dims.brand_categories(views.local_product(spark, sf_dir)).filter(F.col("category") != "Category 5")
    shares = io_master.io_proportions(order, views.budget_holders(spark), categories)
    return shares.select(
        "IO",
        "brand_code",
        "category",
        "budget_holder_grp",
        whole("brand_investment"),
        whole("brand_percentage"),
        whole("total_IO_amt_PERSTR"),
        whole("total_IO_amt"),
        ratio("proportion_PERSTR"),
        ratio("proportion"),
    )


def category_share_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category shares per year, quarter and channel from the wide split table."""
    share = io_master.category_share(views.split(spark, sf_dir, True), categories=views.CATEGORIES)
    return share.select("year", "quarter", "channel", "category", ratio("percent"))


def on_invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-invoice promotions by type, holder group, product group and banded."""
    on = promo.on_invoice(
        views.promos(spark, sf_dir), views.dim_promotion(spark), views.hierarchy(spark, sf_dir), views.io(spark, sf_dir)
    )
    return on.groupBy(
        "promotion_type",
        "promotion_mechanism",
        "budget_holder_group",
        "standard_product_group_code",
        "banded",
        "invoice_type",
    ).agg(rows(), *[total(c) for c in VALUES])


def _off_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Off-invoice lines summed to month, channel and funding id before they fan out over brands."""
    lines = promo.off_invoice_lines(views.promos(spark, sf_dir), views.dim_promotion(spark), views.bridge(spark, sf_dir))
    return lines.groupBy("month_id", "channel", "IO", "promotion_type", "promotion_mechanism").agg(
        *[F.sum(c).alias(c) for c in VALUES]
    )


def _build_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return promo.io_brands(views.io(spark, sf_dir), views.hierarchy(spark, sf_dir))


def brand_funds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.layer(spark, sf_dir, "io-brands", _build_brands)


def _build_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io_master.category_share(views.split(spark, sf_dir, False), "ALL", "ALL", views.CATEGORIES)


def category_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.layer(spark, sf_dir, "category-share", _build_share)


def _off_report(allocated: DataFrame) -> DataFrame:
    return allocated.groupBy(
        "month_id", "IO", "promotion_type", "brand_IO", "category_IO", "standard_product_group_code", "budget_holder_group"
    ).agg(rows(), *[total(c) for c in VALUES])


def off_invoice_perstr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perfect-store spend split by channel category share and the funding order's brands."""
    return _off_report(
        promo.off_invoice_perstr(_off_sums(spark, sf_dir), category_shares(spark, sf_dir), brand_funds(spark, sf_dir))
    )


def off_invoice_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other off-invoice spend split over the funding order's brands."""
    return _off_report(promo.off_invoice_other(_off_sums(spark, sf_dir), brand_funds(spark, sf_dir)))


def gift_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free gifts valued by scheme price, else item price, else 0, split over brands."""
    gifts = promo.gift_value(
        views.promos(spark, sf_dir),
        brand_funds(spark, sf_dir),
        views.gift_prices(spark, sf_dir),
        views.gift_master(spark, sf_dir),
    )
    return gifts.groupBy(
        "year_id", "promotion_type", "standard_product_group_code", "budget_holder_group", "gift_price_available"
    ).agg(rows(), *[total(c) for c in VALUES])


def _off_allocated(spark: SparkSession, sf_dir: str, off_lines: DataFrame, funds: DataFrame | None = None) -> DataFrame:
    brands = brand_funds(spark, sf_dir) if funds is None else funds
    return promo.off_invoice_perstr(off_lines, category_shares(spark, sf_dir), brands).unionByName(
        promo.off_invoice_other(off_lines, brands)
    )


def daily_branches(
    spark: SparkSession,
    sf_dir: str,
    lines: DataFrame,
    off_funds: DataFrame | None = None,
    folders: list[str] | None = None,
    spent: str | None = None,
) -> DataFrame:
    """The daily fact of processed lines; off-invoice spend may be given funds of its own.

    Each branch stores its lines with what they get from joins before they are
    dealt and fan out; ``folders`` gets the folders, which the fact is read from.
    ``spent`` is the folder of the lines, where nobody else reads it: it is deleted
    once all branches have stored theirs.
    """
    folders = [] if folders is None else folders
    on = promo.on_invoice(lines, views.dim_promotion(spark), views.hierarchy(spark, sf_dir), views.io(spark, sf_dir))
    off = promo.off_invoice_lines(lines, views.dim_promotion(spark), views.bridge(spark, sf_dir))
    prices, packs = views.gift_prices(spark, sf_dir), views.gift_master(spark, sf_dir)
    other = promo.unprocessed_mechanisms(lines)
    daily = promo.daily_promotions(
        promo.dealt(promo.held(on, "on-lines", folders)),
        _off_allocated(spark, sf_dir, promo.dealt(promo.held(off, "off-lines", folders)), off_funds),
        promo.gift_value(lines, brand_funds(spark, sf_dir), prices, packs, deal=True, folders=folders),
        promo.dealt(other if spent is None else promo.held(other, "other-lines", folders)),
    )
    if spent is not None:
        storage.delete_folder(spark, spent)
    return daily


def daily_fact(
    spark: SparkSession, sf_dir: str, off_funds: DataFrame | None = None, folders: list[str] | None = None
) -> DataFrame:
    """The daily promotion fact at invoice grain."""
    return daily_branches(spark, sf_dir, views.processed_promos(spark, sf_dir), off_funds, folders)


def daily_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily promotions of all four branches, profiled by day, type and mechanism."""
    return (
        daily_fact(spark, sf_dir)
        .groupBy("time_key", "invoice_type", "promotion_type", "promotion_mechanism", "gift_price_available")
        .agg(rows(), *[total(c) for c in VALUES])
    )


def _monthly_lookups(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return (
        views.outlets(spark, sf_dir),
        views.distributors(spark, sf_dir),
        code_table(spark, sf_dir),
        size_table(spark, sf_dir),
    )


def monthly_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-invoice promotions per month end with report codes."""
    on = promo.on_invoice(
        views.promos(spark, sf_dir), views.dim_promotion(spark), views.hierarchy(spark, sf_dir), views.io(spark, sf_dir)
    )
    daily = spread_join(on, views.bridge(spark, sf_dir, mapped=False), "outlet_code")
    coded = monthly.monthly_on(daily, *_monthly_lookups(spark, sf_dir))
    return coded.groupBy(
        "time_key",
        "region",
        "channel_code",
        "store_size_code",
        "perfect_store_status_code",
        "banded_code",
        "promotion_type",
        "has_occdis",
    ).agg(rows(), total("promotion_value"), total("tot_display"))


def monthly_off_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Off-invoice month rows: totals and flags sit on one marker row per month, outlet and product."""
    lines = views.processed_promos(spark, sf_dir)
    lookups = _monthly_lookups(spark, sf_dir)
    channels = views.bridge(spark, sf_dir, mapped=False)
    # Lines are told of their outlet before they fan out over brands.
    told = lambda df, label: promo.held(monthly.with_outlets(df, lookups[0], lookups[3], channels), label)
    off_lines = told(promo.off_invoice_lines(lines, views.dim_promotion(spark), views.bridge(spark, sf_dir)), "off-lines")
    off = _off_allocated(spark, sf_dir, off_lines)
    other = told(promo.unprocessed_mechanisms(lines), "other-lines")
    booked = off.withColumn("product_code", F.col("standard_product_group_code"))
    union = booked.unionByName(other, allowMissingColumns=True)
    coded = monthly.monthly_off(promo.opened_channels(union), *lookups)
    return coded.groupBy("time_key", "promotion_type", "promotion_mechanism", "channel_code").agg(
        rows(),
        F.count("tot_occdis").alias("marker_rows"),
        total("promotion_value"),
        *[total(c) for c in monthly.INDICATORS],
        *[F.sum(c).cast("long").alias(c) for c in monthly.FLAGS],
    )


QUERIES = {
    "feed_distinct_clean": feed_distinct_clean,
    "harmonize_value": harmonize_value,
    "loyalty_dedupe": loyalty_dedupe,
    "bridge_channel": bridge_channel,
    "std_hierarchy": std_hierarchy,
    "latest_io_rank": latest_io_rank,
    "brand_remap": brand_remap,
    "io_proportions": io_proportions,
    "category_share_unpivot": category_share_unpivot,
    "on_invoice": on_invoice,
    "off_invoice_perstr": off_invoice_perstr,
    "off_invoice_other": off_invoice_other,
    "gift_value": gift_value,
    "daily_promotions": daily_promotions,
    "monthly_on": monthly_on,
    "monthly_off_indicators": monthly_off_indicators,
}

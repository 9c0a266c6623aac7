"""The provided star schema, seen as the sales and promotion domain.

lineitem is the invoice line, orders the invoice, customer the outlet, supplier
the distributor site, part the product. Money is in whole hundredths (and value
times percent in whole ten-thousandths), held in doubles, so sums are exact and
do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger.functions import keys
from promoledger.operators import dims, feed, io_master
from promoledger.session import stage
from promoledger.sources import storage
from promoledger.sources.readers import constant_relation, read_parquet

CATEGORIES = [f"Category {n}" for n in range(1, 6)]
CHANNEL_MAP = {"PROFESSIONAL": "PROFESSIONAL", "BUILDING": "BUILDING", "FURNITURE": "FURNITURE"}
CHANNEL_GROUPS = {
    "AUTOMOBILE": "GENERAL",
    "BUILDING": "GENERAL",
    "FURNITURE": "GENERAL",
    "HOUSEHOLD": "GENERAL",
    "MACHINERY": "PROFESSIONAL",
}
REGIONS = {"AFRICA": 1, "AMERICA": 2, "ASIA": 3, "EUROPE": 4, "MIDDLE EAST": 5}
HOLDER_GROUPS = {"BH1": "Brand", "BH2": "Trade Marketing", "BH3": "Customer", "BH4": "Brand"}
STORE_SIZES = [("SMALL", 1, 0.0, 5_000_000.0), ("MEDIUM", 2, 5_000_000.5, 12_000_000.0), ("LARGE", 3, 12_000_000.5, 30_000_000.0)]
DIM_PROMOTION = [
    ("PERSTR", "OFF", "DISPLAY", 1),
    ("OCCDIS", "OFF", "DISPLAY", 1),
    ("LTYPRG", "ON", "LOYALTY", 2),
    ("DTRDIS", "ON", "TRADE", 3),
    ("BASKET", "ON", "BASKET", 4),
    ("BASKET", "OFF", "BASKET", 4),
]


_known_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided tables. Its schema is read from the files once, not by a job per use."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _known_schemas:
        _known_schemas[path] = spark.read.parquet(path).schema
    return read_parquet(spark, path, _known_schemas[path])


_layers: dict[tuple[str, str, str], tuple[tuple, DataFrame, str]] = {}


def layer(spark: SparkSession, sf_dir: str, label: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """A reference table or processed layer, written once per application and read by all that need it.

    This is how the warehouse holds them: masters, funding proportions, codes and
    the processed promotions are stored tables, so a job that reads one in
    several branches scans it, and does not derive it anew per branch. A layer is
    built again, and the old one deleted, once a table in ``sf_dir`` has changed.
    """
    key = (spark.sparkContext.applicationId, sf_dir, label)
    version = storage.listing(spark, sf_dir)
    known = _layers.get(key)
    if known is None or known[0] != version:
        built, path = stage(build(spark, sf_dir), label)
        if known is not None:
            storage.delete_folder(spark, known[2])
        _layers[key] = (version, built, path)
    return _layers[key][1]


def text(column: str) -> Column:
    return F.col(column).cast("string")


def hundredths(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("long")


def product_code(column: str) -> Column:
    return F.lpad(text(column), 8, "0")


def outlet_code(column: str) -> Column:
    return F.lpad(text(column), 10, "0")


def brand_number(column: str = "p_brand") -> Column:
    return F.substring(F.col(column), 7, 10).cast("int")


def family(number: Column) -> Column:
    """Brands 1-5 are family 1, 6-10 family 2 and so on."""
    return F.floor((number + 4) / 5).cast("int")


def category_name(number: Column) -> Column:
    return F.concat(F.lit("Category "), ((number - 1) % 5 + 1).cast("string"))


def lines(spark: SparkSession, sf_dir: str, scope: Column | None = None) -> DataFrame:
    """Invoice lines with their outlet: the two facts joined once, on the invoice. ``scope`` is a range of the stored ship date."""
    item = table(spark, sf_dir, "lineitem")
    item = item if scope is None else item.filter(scope)
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    return item.join(order, item["l_orderkey"] == order["o_orderkey"])


def sales_fact(spark: SparkSession, sf_dir: str, scope: Column | None = None) -> DataFrame:
    cents, disc, tax = hundredths("l_extendedprice"), hundredths("l_discount"), hundredths("l_tax")
    return lines(spark, sf_dir, scope).select(
        F.lit("VN").alias("country_code"),
        product_code("l_partkey").alias("product_code"),
        text("l_orderkey").alias("invoice_number"),
        F.concat(text("l_suppkey"), F.lit("_"), F.year("l_shipdate").cast("string")).alias("site_code_year"),
        text("l_suppkey").alias("transactional_distributor_code"),
        text("l_suppkey").alias("transactional_site_code"),
        outlet_code("o_custkey").alias("transactional_outlet_code"),
        F.col("l_shipdate").cast("date").alias("invoice_date"),
        text("l_suppkey").alias("transactional_salesman_code"),
        F.col("l_linestatus").alias("invoicetype"),
        F.col("l_returnflag").alias("customer_ZRSS_flag"),
        cents.cast("double").alias("gross_sales_val"),
        (cents * (100 - disc)).cast("double").alias("net_invoice_val"),
        (cents * disc).cast("double").alias("on_invoice_discount_val"),
        (cents * tax).cast("double").alias("value_added_tax"),
        F.col("l_quantity").cast("int").alias("sales_pc_qty"),
        keys.year_key("l_shipdate").alias("year_id"),
        keys.month_key("l_shipdate").alias("month_id"),
        keys.time_key("l_shipdate").alias("time_key"),
    )


def mechanism() -> Column:
    flag = F.col("l_returnflag")
    gift = F.when(F.col("l_linestatus") == "F", "FQ").otherwise("JR")
    return F.when(flag == "A", gift).when(flag == "N", "BD").otherwise("LN")


def promotion_type() -> Column:
    rank = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(rank == "1", "PERSTR")
        .when(rank == "2", "LTYPRG")
        .when(rank == "3", "OCCDIS")
        .when(rank == "4", "DTRDIS")
        .otherwise("BASKET")
    )


def scheme(line_number: str = "l_linenumber") -> Column:
    return F.lpad(((F.col(line_number) - 1) % 5 + 1).cast("string"), 8, "0")


def promo_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned promotion lines: type by order priority, mechanism by flag and status."""
    cents = hundredths("l_extendedprice")
    quantity = F.col("l_quantity")
    return lines(spark, sf_dir).select(
        F.lit("VN").alias("country"),
        keys.time_key("l_shipdate").alias("time_key"),
        text("l_suppkey").alias("distributor_code"),
        text("l_suppkey").alias("site_code"),
        text("o_custkey").alias("outlet_code"),
        text("l_orderkey").alias("invoice_no"),
        text("l_linenumber").alias("billing_item"),
        product_code("l_partkey").alias("product_code"),
        F.concat(mechanism(), scheme(), F.lit("-"), F.substring("o_orderpriority", 1, 1)).alias("promotion_id"),
        mechanism().alias("promotion_mechanism"),
        promotion_type().alias("promotion_type"),
        (cents * hundredths("l_discount")).cast("double").alias("value_based_promo_disc"),
        (cents * hundredths("l_tax")).cast("double").alias("header_lvl_disc"),
        F.floor(quantity / 10).cast("double").alias("free_qty_in_cs"),
        (quantity - 10 * F.floor(quantity / 10)).cast("double").alias("free_qty_in_pc"),
    )


def promos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.harmonize_promo(promo_feed(spark, sf_dir), article(spark, sf_dir))


def processed_promos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored processed layer, for jobs that read it in several branches."""
    return layer(spark, sf_dir, "promos", promos)


def pieces_per_unit(size: str = "p_size") -> Column:
    """0 for the smallest parts, else a power of two, so that values per unit stay exact."""
    s = F.col(size)
    return F.when(s <= 10, 0).when(s <= 20, 1).when(s <= 30, 2).when(s <= 40, 4).otherwise(8)


def article(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = brand_number()
    return table(spark, sf_dir, "part").select(
        product_code("p_partkey").alias("material_code"),
        F.when(F.col("p_size") <= 7, F.concat("p_name", F.lit(" (1+A)"))).otherwise(F.col("p_name")).alias(
            "material_desc"
        ),
        hundredths("p_retailprice").cast("double").alias("price_per_su"),
        pieces_per_unit().alias("PC_per_SU"),
        F.col("p_size").alias("PC_per_CS"),
        category_name(number).alias("PH3_description"),
        F.concat(F.lit("Market "), family(number).cast("string")).alias("PH4_description"),
        F.col("p_brand").alias("PH5_description"),
        F.col("p_brand").alias("PH7_code"),
        F.col("p_brand").alias("PH7_description"),
        F.when(F.col("p_type") == "PROMO", "PROMO Banded").otherwise(F.col("p_type")).alias("PH8_description"),
    )


def local_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = brand_number()
    return table(spark, sf_dir, "part").select(
        product_code("p_partkey").alias("product_code"),
        F.col("p_type").alias("PH9_code"),
        F.col("p_name").alias("PH9_description"),
        F.col("p_brand").alias("PH7_code"),
        F.when(F.col("p_size") == 50, "Not Assigned").otherwise(F.col("p_name")).alias("dp_name"),
        category_name(number).alias("category"),
        F.concat(F.lit("Division "), (number % 2 + 1).cast("string")).alias("division"),
    )


def build_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.standard_hierarchy(local_product(spark, sf_dir), article(spark, sf_dir))


def hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer(spark, sf_dir, "hierarchy", build_hierarchy)


def outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        outlet_code("c_custkey").alias("outlet_code"),
        F.col("c_mktsegment").alias("channel"),
        F.when(F.col("c_acctbal") >= 5000, "Y").otherwise("N").alias("perfect_store"),
    )


def channels(spark: SparkSession) -> DataFrame:
    return constant_relation(spark, CHANNEL_GROUPS, "channel string, group_channel string")


def channel_map(spark: SparkSession) -> DataFrame:
    return constant_relation(spark, CHANNEL_MAP, "channel_org string, channel string")


def bridge(spark: SparkSession, sf_dir: str, mapped: bool = True) -> DataFrame:
    return dims.channel_bridge(outlets(spark, sf_dir), channels(spark), channel_map(spark) if mapped else None)


def distributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    supplier = table(spark, sf_dir, "supplier")
    return (
        supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            text("s_suppkey").alias("distributor_code"),
            text("s_suppkey").alias("site_code"),
            F.lit("VN").alias("country_code"),
            F.when(F.col("s_acctbal") >= 0, "C10000").otherwise("C20000").alias("distributor_type"),
            F.col("r_name").alias("dt_region"),
        )
    )


def dim_promotion(spark: SparkSession) -> DataFrame:
    return constant_relation(
        spark,
        DIM_PROMOTION,
        "promotion_type string, promo_invoice string, promo_summarized string, summarized_index int",
    )


def budget_holders(spark: SparkSession) -> DataFrame:
    return constant_relation(spark, HOLDER_GROUPS, "budget_holder string, budget_holder_grp string")


def store_sizes(spark: SparkSession) -> DataFrame:
    rows = [("STORE_SIZE_CLASS", *r) for r in STORE_SIZES]
    return constant_relation(
        spark, rows, "ref_type string, ref_desc string, ref_code int, param1 double, param2 double"
    )


def io_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funding per mechanism and brand family: each brand invests the list value of its parts.

    Family 5 has no order for mechanism BD, so its lines find no funding.
    """
    number = brand_number("brand_code")
    brands = (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_brand").alias("brand_code"))
        .agg(F.sum(hundredths("p_retailprice")).cast("double").alias("brand_investment"))
    )
    return (
        brands.select("*", F.explode(F.array(*[F.lit(m) for m in ("BD", "FQ", "JR", "LN")])).alias("spend_type"))
        .filter(~((F.col("spend_type") == "BD") & (family(number) == 5)))
        .select(
            F.lpad(family(number).cast("string"), 8, "0").alias("promotion_id"),
            F.concat(F.lit("BH"), family(number).cast("string")).alias("budget_holder"),
            "spend_type",
            "brand_code",
            F.lit(0.0).alias("brand_percentage"),
            "brand_investment",
            F.col("brand_investment").alias("investment_amount"),
        )
    )


def build_io(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = dims.brand_categories(local_product(spark, sf_dir))
    return io_master.io_proportions(io_raw(spark, sf_dir), budget_holders(spark), categories)


def io(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer(spark, sf_dir, "io", build_io)


def split(spark: SparkSession, sf_dir: str, by_period: bool) -> DataFrame:
    """Wide split table: sales of each category as a column, per channel (and quarter)."""
    part = table(spark, sf_dir, "part").select("p_partkey", category_name(brand_number()).alias("__category"))
    sold = lines(spark, sf_dir).select(
        "l_partkey",
        outlet_code("o_custkey").alias("outlet_code"),
        hundredths("l_extendedprice").alias("__cents"),
        F.year("l_shipdate").cast("string").alias("__year"),
        keys.quarter_label("l_shipdate").alias("__quarter"),
    )
    joined = sold.join(part, sold["l_partkey"] == part["p_partkey"]).join(
        bridge(spark, sf_dir).filter(F.col("channel") != "NA"), "outlet_code"
    )
    period = ["__year", "__quarter"] if by_period else []
    wide = joined.groupBy(*period, "channel").agg(
        *[
            F.sum(F.when(F.col("__category") == c, F.col("__cents")).otherwise(0)).cast("double").alias(c)
            for c in CATEGORIES
        ]
    )
    year = F.col("__year") if by_period else F.lit("ALL")
    quarter = F.col("__quarter") if by_period else F.lit("ALL")
    return wide.select(year.alias("year"), quarter.alias("quarter"), "channel", *[f"`{c}`" for c in CATEGORIES])


def gift_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price list from all sales: unit price of an item under the scheme of its line; later prices stand under new item codes."""
    item = table(spark, sf_dir, "lineitem")
    early = F.col("l_shipdate") < F.lit("1995-10-01").cast("timestamp_ntz")
    code = product_code("l_partkey")
    return item.select(
        scheme().alias("scheme_id"),
        F.when(early, code).otherwise(F.concat(F.lit("new "), code)).alias("item_code"),
        F.floor(hundredths("l_extendedprice") / F.col("l_quantity")).cast("double").alias("price_vnd"),
    )


def gift_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .filter(F.col("p_size") > 5)
        .select(product_code("p_partkey").alias("gift_code"), F.col("p_size").alias("packing_per_case"))
    )


def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last shipment; Sundays are not traded."""
    span = table(spark, sf_dir, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("first"), F.max("l_shipdate").cast("date").alias("last")
    )
    days = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    return days.select(
        keys.time_key("day").alias("Dt"),
        keys.month_key("day").alias("year_month"),
        F.when(F.dayofweek("day") == 1, 0).otherwise(1).alias("Trading_day"),
    )

"""Promotion lines -> on-invoice, allocated off-invoice and gift values -> daily promotion fact.

The operators accept lines at any grain that carries the columns they use:
allocation is linear in the measures, so lines may be summed to the grain a
report needs *before* they fan out over brands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger import schemas, session
from promoledger.functions import rules
from promoledger.operators.dims import brand_attributes
from promoledger.operators.joins import spread_join

VALUES = ["value_based_promo_disc", "header_lvl_disc", "free_quantity_value", "promotion_value"]
# Descriptive columns that every branch hands on, where present.
LINE_COLUMNS = [
    "invoice_no",
    "product_code",
    "promotion_id",
    "IO",
    "promotion_mechanism",
    "promotion_desc",
    "promotion_type",
    "promo_start_date",
    "promo_end_date",
    "distributor_code",
    "site_code",
    "outlet_code",
    "country",
    "year_id",
    "month_id",
    "time_key",
    "outlet_channels",
    # What month rows are told of their outlet, where lines bring it along.
    "__known",
    "__perfect",
    "__sizes",
]
BRANCH_COLUMNS = [
    "standard_product_group_code",
    "budget_holder_group",
    "invoice_type",
    "banded",
    "gift_price_available",
]


def _lines(df: DataFrame) -> list[str]:
    return [c for c in LINE_COLUMNS if c in df.columns]


def dealt(lines: DataFrame) -> DataFrame:
    """Lines dealt by what stays the same when they are allocated, for the daily sum to need no shuffle of its own.

    Allocation makes several rows of a line, which differ in the product they book
    on and in values. Joins with funds and shares, which are small, leave rows where
    they are, so rows that the daily fact sums are together already: a line is
    shuffled, not the rows made of it. Were the funds large, Spark would shuffle
    once more. All branches have to be dealt.
    """
    return lines.repartition(*[c for c in _lines(lines) if c != "product_code"])


def held(lines: DataFrame, label: str, folders: list[str] | None = None) -> DataFrame:
    """Lines of a branch with what they got from joins, stored as far as branches use them: the shuffles of the joins go
    before lines are dealt. ``folders`` gets the folder, for who wants to delete it."""
    used = {*LINE_COLUMNS, *BRANCH_COLUMNS, *VALUES, "channel", "__value"}
    stored, path = session.stage(lines.select(*[c for c in lines.columns if c in used]), label)
    if folders is not None:
        folders.append(path)
    return stored


def promotion_keys(dim_promotion: DataFrame, invoice: str | None = None) -> DataFrame:
    """(promo_invoice, promotion_type) with off-invoice baskets under their own type."""
    dim = dim_promotion if invoice is None else dim_promotion.filter(F.col("promo_invoice") == invoice)
    return dim.select(
        "promo_invoice",
        rules.recode_basket("promotion_type", F.col("promo_invoice") == "OFF").alias("promotion_type"),
    ).distinct()


def io_brands(io: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """IO brand shares with the brand's representative product. Built once and passed to every branch."""
    return io.join(brand_attributes(hierarchy), "brand_code", "left")


def on_invoice(promos: DataFrame, dim_promotion: DataFrame, hierarchy: DataFrame, io: DataFrame) -> DataFrame:
    """Lines of on-invoice promotion types whose product is in the hierarchy, with a budget holder group."""
    holders = io.select("IO", "budget_holder_grp").distinct()
    products = hierarchy.select("product_code", "standard_product_group_code", "banded")
    lines = (
        promos.filter(F.col("on_off_flag") == 1)
        .join(promotion_keys(dim_promotion, "ON"), "promotion_type")
        .join(products, "product_code")
        .join(holders, "IO", "left")
    )
    return lines.select(
        *_lines(promos),
        *VALUES,
        "standard_product_group_code",
        rules.default_holder_group("budget_holder_grp", "promotion_type").alias("budget_holder_group"),
        F.col("promo_invoice").alias("invoice_type"),
        "banded",
        F.lit(rules.MISSING).alias("gift_price_available"),
    )


def off_invoice_lines(promos: DataFrame, dim_promotion: DataFrame, bridge: DataFrame) -> DataFrame:
    """Priced lines of off-invoice promotion types, with the outlet's channel.

    Lines that already carry a ``channel`` (summed beyond the outlet) keep it.
    """
    lines = promos.filter(F.col("on_off_flag") == 1).join(promotion_keys(dim_promotion, "OFF"), "promotion_type")
    if "channel" not in promos.columns:
        lines = lines.join(bridge, "outlet_code")
    return lines


def _allocated(lines: DataFrame, proportion, base: Sequence[str]) -> DataFrame:
    """Scale the values by the proportion. A component that scales to 0 keeps its original value."""
    scaled = lines.withColumn("__p", proportion)

    def component(name: str):
        part = F.coalesce(F.col(name) * F.col("__p"), F.lit(0.0))
        return F.when(part == 0, F.col(name)).otherwise(part).alias(name)

    return scaled.select(
        *base,
        *[component(c) for c in VALUES[:3]],
        (rules.zero_if_null("promotion_value") * F.col("__p")).alias("promotion_value"),
        "standard_product_group_code",
        rules.default_holder_group("budget_holder_grp", "promotion_type").alias("budget_holder_group"),
        F.lit("OFF").alias("invoice_type"),
        F.lit("Non-Banded").alias("banded"),
        F.lit(rules.MISSING).alias("gift_price_available"),
        rules.or_missing("category").alias("category_IO"),
        rules.or_missing("brand_code").alias("brand_IO"),
    )


def off_invoice_perstr(off_lines: DataFrame, share: DataFrame, brands: DataFrame) -> DataFrame:
    """PERSTR lines, split over categories by channel share and then over the IO's brands of that category.

    A channel without a split, or a category the IO does not fund, leaves a row
    of value 0: the value leaks and the reconciliation gate reports it.
    """
    lines = off_lines.filter(F.col("promotion_type") == "PERSTR")
    splits = share.select("channel", F.col("category").alias("__cat"), F.col("percent").alias("__percent"))
    funds = brands.withColumn("__cat", F.upper("category")).select(
        "IO",
        "__cat",
        "category",
        "brand_code",
        "budget_holder_grp",
        "standard_product_group_code",
        F.col("proportion_PERSTR").alias("__share"),
    )
    fanned = spread_join(spread_join(lines, splits, "channel"), funds, ["IO", "__cat"])
    proportion = rules.zero_if_null("__share") * rules.zero_if_null("__percent")
    return _allocated(fanned, proportion, _lines(off_lines))


def off_invoice_other(off_lines: DataFrame, brands: DataFrame) -> DataFrame:
    """All other off-invoice lines, split over the IO's brands by investment proportion."""
    lines = off_lines.filter(F.col("promotion_type") != "PERSTR")
    funds = brands.select(
        "IO",
        "category",
        "brand_code",
        "budget_holder_grp",
        "standard_product_group_code",
        F.col("proportion").alias("__share"),
    )
    fanned = spread_join(lines, funds, "IO")
    return _allocated(fanned, rules.zero_if_null("__share"), _lines(off_lines))


def gift_value(
    promos: DataFrame,
    brands: DataFrame,
    gift_price: DataFrame,
    gift_master: DataFrame,
    deal: bool = False,
    folders: list[str] | None = None,
) -> DataFrame:
    """Gift lines valued at the scheme's price of the item, else the item's highest price, else 0.

    Value = (cases * pieces per case + pieces) * price, split over the IO's brands;
    with ``deal`` the valued lines are dealt before, for the daily sum, and with
    ``folders``, a list for the folder, they are stored before that (``held``).
    """
    scheme_price = gift_price.groupBy(F.col("item_code").alias("product_code"), "scheme_id").agg(
        F.max("price_vnd").alias("__scheme_price")
    )
    item_price = scheme_price.groupBy("product_code").agg(F.max("__scheme_price").alias("__item_price"))
    pack = gift_master.select(F.col("gift_code").alias("product_code"), F.col("packing_per_case").alias("__pack"))
    funds = brands.select(
        "IO",
        "brand_code",
        "standard_product_group_code",
        F.coalesce("budget_holder_grp", F.lit("Trade Category")).alias("budget_holder_group"),
        F.col("proportion").alias("__share"),
    )
    gifts = promos.filter(
        (F.col("on_off_flag") == 0) & ~F.col("promotion_mechanism").isin(rules.UNPROCESSED_MECHANISMS)
    ).withColumn("scheme_id", F.substring("promotion_id", 3, 8))
    # Prices and packs attach to the line before it fans out over brands.
    priced = spread_join(gifts, scheme_price, ["product_code", "scheme_id"])
    priced = spread_join(priced, item_price, "product_code").join(pack, "product_code", "left")
    price = F.coalesce("__scheme_price", "__item_price")
    value = (
        rules.zero_if_null("free_qty_in_cs") * F.coalesce("__pack", F.lit(0)) + rules.zero_if_null("free_qty_in_pc")
    ) * F.coalesce(price, F.lit(0.0))
    priced = priced.withColumns(
        {"__value": value, "gift_price_available": rules.yes_no(price.isNotNull())}
    )
    priced = priced if folders is None else held(priced, "gift-lines", folders)
    return spread_join(dealt(priced) if deal else priced, funds, "IO").select(
        *_lines(promos),
        *VALUES[:3],
        (F.col("__value") * rules.zero_if_null("__share")).alias("promotion_value"),
        "standard_product_group_code",
        F.coalesce("budget_holder_group", F.lit("Trade Category")).alias("budget_holder_group"),
        F.lit("OFF").alias("invoice_type"),
        F.lit("Non-Banded").alias("banded"),
        "gift_price_available",
        rules.or_missing("brand_code").alias("brand_IO"),
    )


def unprocessed_mechanisms(promos: DataFrame) -> DataFrame:
    """Non-priced mechanisms other than gifts go straight from the processed layer into the daily fact."""
    return promos.filter((F.col("on_off_flag") == 0) & (F.col("promotion_mechanism") != "FQ")).select(
        *_lines(promos),
        *VALUES,
        F.lit(rules.MISSING).alias("standard_product_group_code"),
        F.lit(rules.MISSING).alias("budget_holder_group"),
        F.lit("OFF").alias("invoice_type"),
        F.lit("Non-Banded").alias("banded"),
        F.lit(rules.MISSING).alias("gift_price_available"),
    )


def daily_promotions(on: DataFrame, off: DataFrame, gift: DataFrame, other: DataFrame) -> DataFrame:
    """Union of the four branches, summed at invoice, product and promotion grain.

    Allocated branches book on the brand's representative product. The branches
    never share a key (mechanism, on/off type and gift flag differ), so one
    group-by after the union equals four before it and shuffles once, or not at
    all where the lines of every branch were dealt.
    """
    booked = [
        on,
        off.withColumn("product_code", F.col("standard_product_group_code")),
        gift.withColumn("product_code", F.col("standard_product_group_code")),
        other,
    ]
    wanted = [c for c in LINE_COLUMNS if c in on.columns] + BRANCH_COLUMNS
    union = booked[0].select(*wanted, *VALUES)
    for branch in booked[1:]:
        union = union.unionByName(branch.select(*wanted, *VALUES))
    return union.groupBy(*wanted).agg(*[rules.zero_if_null(F.sum(c)).alias(c) for c in VALUES])


def outlet_channels(bridge: DataFrame) -> DataFrame:
    """The list of channels of each outlet."""
    return bridge.groupBy("outlet_code").agg(F.sort_array(F.collect_list(F.struct("channel"))).alias("outlet_channels"))


def opened_channels(rows: DataFrame) -> DataFrame:
    """Rows that carry the channels of their outlet, one for each; a row without any is kept."""
    opened = rows.withColumn("__channel", F.explode_outer("outlet_channels")).withColumn("channel", F.col("__channel.channel"))
    return opened.drop("__channel", "outlet_channels")


def with_outlet_channels(lines: DataFrame, bridge: DataFrame) -> DataFrame:
    """Lines with all channels of their outlet, which every branch hands on: lines are fewer than the daily rows made of them."""
    return spread_join(lines, outlet_channels(bridge), "outlet_code")


def typed_daily_promotions(daily: DataFrame, bridge: DataFrame) -> DataFrame:
    """Daily promotions with the outlet's channel, under the declared contract of the fact.

    Rows that carry the channels of their outlet get those, a row each; others look them up.
    """
    dated = daily.withColumns(
        {
            c: F.try_to_timestamp(F.col(c), F.lit("dd.MM.yyyy")).cast("date")
            for c in ("promo_start_date", "promo_end_date")
        }
    ).withColumnRenamed("invoice_no", "invoice_number")
    if "outlet_channels" in daily.columns:
        placed = opened_channels(dated)
    else:
        placed = spread_join(dated, bridge, "outlet_code")
    return schemas.conform(placed, schemas.DAILY_PROMOTIONS)

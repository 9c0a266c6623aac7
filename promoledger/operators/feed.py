"""Promotion feed: clean the raw export, value it, and de-duplicate loyalty promotions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.functions import keys, parse, rules
from promoledger.operators.joins import first_per_group, spread_join
from promoledger.sources.readers import control_rows, report_rows

# Column names of the export and the names that the layers use for them: fixed by the feed contract.
_MEASURES = [
    "value_based_promo_disc",
    "header_lvl_disc",
    "free_qty_in_cs",
    "free_qty_in_pc",
    "free_qty_val_in_cs",
    "free_qty_val_in_pc",
    "free_qty_retail_price_cs",
    "free_qty_retail_price_pc",
]
_RENAMED = {
    "distributor": "distributor_code",
    "site": "site_code",
    "outlet": "outlet_code",
    "billing_document": "invoice_no",
    "billing_type": "invoice_category",
    "product": "product_code",
    "promotion_desc1": "promotion_desc",
}


def clean_promo_feed(raw: DataFrame, sites: DataFrame, country: str = "VN") -> DataFrame:
    """Export lines -> typed, distinct promotion lines of the listed sites.

    The feed repeats lines, so whole rows are made distinct. The site filter
    runs before that shuffle.
    """
    data = report_rows(raw, country)
    typed = data.select(
        "country",
        parse.report_day_key("calendar_day").alias("time_key"),
        "calendar_day",
        *[F.col(old).alias(new) for old, new in _RENAMED.items()],
        "billing_item",
        "promotion_id",
        F.substring("promotion_id", 1, 2).alias("promotion_mechanism"),
        "promo_start_date",
        "promo_end_date",
        "promotion_type",
        *[rules.zero_if_null(parse.report_number(c)).alias(c) for c in _MEASURES],
    )
    return spread_join(typed, sites.select("site_code").distinct(), "site_code", "left_semi").distinct()


def clean_control_totals(raw: DataFrame) -> DataFrame:
    """Control-total lines with unsigned measures and integer day keys."""
    measures = ["value_based_promo_disc", "header_lvl_disc", "free_qty_in_cs", "free_qty_in_pc"]
    return control_rows(raw).select(
        parse.report_day_key("calendar_day").alias("time_key"),
        "site_code",
        *[parse.unsigned_number(c).alias(c) for c in measures],
    )


def harmonize_promo(feed: DataFrame, article: DataFrame) -> DataFrame:
    """Value every promotion line and derive its funding id, keys, type and on/off flag.

    Free goods are valued at the article's price per sales unit: cases count
    PC_per_CS pieces each, and a sales unit holds PC_per_SU pieces (0 or missing
    makes the value 0).
    """
    am = article.select(
        F.col("material_code").alias("product_code"), "price_per_su", "PC_per_SU", "PC_per_CS"
    )
    su = F.when(F.coalesce("PC_per_SU", F.lit(0)) != 0, F.col("PC_per_SU"))
    cases = rules.zero_if_null(F.col("free_qty_in_cs") * F.col("PC_per_CS") * F.col("price_per_su") / su)
    pieces = rules.zero_if_null(F.col("free_qty_in_pc") * F.col("price_per_su") / su)
    mechanism = F.col("promotion_mechanism")
    valued = feed.join(am, "product_code", "left").withColumns(
        {
            "year_id": F.floor(F.col("time_key") / 10000).cast("int"),
            "month_id": F.floor(F.col("time_key") / 100).cast("int"),
            "outlet_code": keys.pad_code("outlet_code"),
            "IO": F.substring("promotion_id", 1, 10),
            "promotion_type": rules.recode_basket("promotion_type", mechanism == "BD"),
            "free_quantity_value": cases + pieces,
            "on_off_flag": rules.on_off_flag(mechanism),
        }
    )
    return valued.drop("price_per_su", "PC_per_SU", "PC_per_CS", "free_qty_retail_price_cs").withColumn(
        "promotion_value",
        rules.zero_if_null("value_based_promo_disc")
        + rules.zero_if_null("header_lvl_disc")
        + F.col("free_quantity_value"),
    )


_LOYALTY_VALUES = ["value_based_promo_disc", "header_lvl_disc", "free_quantity_value", "promotion_value"]
_LOYALTY_QUANTITIES = [
    "free_qty_in_cs",
    "free_qty_in_pc",
    "free_qty_val_in_cs",
    "free_qty_val_in_pc",
    "free_qty_retail_price_pc",
]


def dedupe_loyalty(promos: DataFrame, loyalty_type: str = "LTYPRG") -> DataFrame:
    """Count each loyalty reward once per (invoice, funding id).

    The reward is repeated on every product of the invoice. Kept is the summed
    value of the first product, put on one row (first by product, billing item,
    promotion); the other rows keep their quantities and get value 0. Rows equal
    on all descriptive columns collapse. Other promotion types pass untouched;
    rows without a type drop, as in any ``!=`` filter.

    Written as two aggregations and a union: the valued row is computed per
    group and then added to the zero-valued rows by the final group-by. Rows are
    dealt by invoice and funding id, which all of these groups share, so nothing
    else is shuffled. Rows that lack one of the two get no value; they may be many,
    and are only collapsed. No group is ever sorted or joined as a whole.
    """
    others = promos.filter(F.col("promotion_type") != loyalty_type)
    rewards = promos.filter(F.col("promotion_type") == loyalty_type)
    known = F.col("invoice_no").isNotNull() & F.col("IO").isNotNull()
    loyalty = rewards.filter(known).repartition("invoice_no", "IO")
    quantities = [c for c in _LOYALTY_QUANTITIES if c in promos.columns]
    descriptive = [c for c in promos.columns if c not in _LOYALTY_VALUES and c not in quantities]
    order = [c for c in ("product_code", "billing_item", "promotion_id") if c in descriptive]
    group = ["invoice_no", "IO"]
    rest = [c for c in descriptive if c not in order and c not in group]

    per_product = loyalty.groupBy(*group, "product_code").agg(
        F.min(F.struct(*order[1:], *rest)).alias("__row"),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in _LOYALTY_VALUES],
    )
    marked = (
        first_per_group(per_product, group, ["product_code"])
        .select(*group, "product_code", "__row.*", *_LOYALTY_VALUES)
        .withColumns({c: F.lit(None).cast("double") for c in quantities})
    )
    zeros = {c: F.lit(0.0) for c in _LOYALTY_VALUES}

    def collapsed(rows: DataFrame) -> DataFrame:
        summed = rows.groupBy(*descriptive).agg(*[F.sum(c).alias(c) for c in _LOYALTY_VALUES + quantities])
        return summed.select(*promos.columns)

    valued = collapsed(loyalty.withColumns(zeros).unionByName(marked))
    return others.unionByName(valued).unionByName(collapsed(rewards.filter(~known).withColumns(zeros)))

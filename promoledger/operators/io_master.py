"""Internal orders: newest version per promotion, brand remap, allocation proportions, channel shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger import schemas
from promoledger.functions import rules
from promoledger.operators.joins import newest_rows_per_key, spread_join

IO_COLUMNS = [
    "promotion_id",
    "budget_holder",
    "spend_type",
    "brand_code",
    "brand_percentage",
    "brand_investment",
    "investment_amount",
]


def needs_previous_year(month: int | str) -> bool:
    """January and February files do not yet carry the promotions still running from last year."""
    return int(month) in (1, 2)


def latest_io(current: DataFrame, previous: DataFrame | None, year: int) -> DataFrame:
    """Distinct IO rows; with last year's file, every promotion keeps all rows of its newest year."""
    rows = current.select(*IO_COLUMNS)
    if previous is None:
        return rows.distinct()
    dated = rows.withColumn("year", F.lit(year)).unionByName(
        previous.select(*IO_COLUMNS).withColumn("year", F.lit(year - 1))
    )
    return newest_rows_per_key(dated.distinct(), ["promotion_id"], "year").drop("year")


def remap_brand(io: DataFrame, brand_map: DataFrame) -> DataFrame:
    """Replace retired brand codes by their latest code. Old codes must be unique in the map (see the gate)."""
    mapped = brand_map.select(F.col("PH7_old").alias("brand_code"), F.col("PH7_latest").alias("__new"))
    return (
        io.join(mapped, "brand_code", "left")
        .withColumn("brand_code", F.coalesce("__new", "brand_code"))
        .select(*io.columns)
    )


def io_proportions(
    io: DataFrame, budget_holder: DataFrame, brand_category: DataFrame, keep_unmapped: bool = True
) -> DataFrame:
    """Share of each brand in its IO (``proportion``) and in its IO and category (``proportion_PERSTR``).

    Brands without a category are kept under NA, or dropped with
    ``keep_unmapped=False``. Missing or zero totals give share 0. Totals are
    grouped at both grains (the coarse one from the fine one) and joined back,
    not computed by a window that would gather one IO in one task.
    """
    base = (
        io.join(budget_holder.select("budget_holder", "budget_holder_grp").distinct(), "budget_holder", "left")
        .join(brand_category.select("brand_code", "category").distinct(), "brand_code", "left")
        .select(
            F.concat("spend_type", "promotion_id").alias("IO"),
            "budget_holder",
            "budget_holder_grp",
            "brand_code",
            "category",
            "brand_percentage",
            "brand_investment",
            "investment_amount",
        )
    )
    if not keep_unmapped:
        base = base.filter(F.col("category").isNotNull())
    by_category = base.groupBy("IO", "category").agg(F.sum("brand_investment").alias("total_IO_amt_PERSTR"))
    by_io = by_category.groupBy("IO").agg(F.sum("total_IO_amt_PERSTR").alias("total_IO_amt"))
    joined = spread_join(spread_join(base, by_category, ["IO", "category"]), by_io, "IO")
    return joined.select(
        "IO",
        "budget_holder",
        "budget_holder_grp",
        "brand_code",
        rules.or_missing("category").alias("category"),
        *[rules.zero_if_null(c).alias(c) for c in ("brand_percentage", "brand_investment", "investment_amount")],
        rules.zero_if_null("total_IO_amt_PERSTR").alias("total_IO_amt_PERSTR"),
        rules.zero_if_null("total_IO_amt").alias("total_IO_amt"),
        rules.share("brand_investment", "total_IO_amt_PERSTR").alias("proportion_PERSTR"),
        rules.share("brand_investment", "total_IO_amt").alias("proportion"),
    )


def category_share(
    split: DataFrame,
    year: str | None = None,
    quarter: str | None = None,
    categories: Sequence[str] = schemas.SPLIT_CATEGORIES,
) -> DataFrame:
    """Wide split table -> share of each category in its channel (0 when the channel total is 0).

    One (year, quarter) when given; otherwise shares are taken per year, quarter and channel.
    """
    period = ["year", "quarter"]
    scoped = split
    if year is not None:
        scoped = scoped.filter((F.col("year") == str(year)) & (F.col("quarter") == quarter))
    group = ["channel"] if year is not None else [*period, "channel"]
    long = scoped.select(*group, *[F.col(f"`{c}`").cast("double").alias(c) for c in categories]).unpivot(
        group, list(categories), "category", "__share"
    )
    totals = long.groupBy(*group).agg(F.sum("__share").alias("__total"))
    return spread_join(long, totals, group).select(
        *[F.col(c) for c in group if c != "channel"],
        F.upper("channel").alias("channel"),
        F.upper("category").alias("category"),
        F.when(F.col("__total") == 0, 0.0).otherwise(F.try_divide("__share", "__total")).alias("percent"),
    )

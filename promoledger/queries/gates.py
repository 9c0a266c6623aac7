"""Quality gates over the domain views; each query returns what the gate would report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.functions import keys
from promoledger.operators import dims, monthly, promo, quality
from promoledger.queries import views
from promoledger.queries.shape import rows, total, whole


def trading_days_without_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trading days without a line where those of every 13th are booked a day late."""
    shipped = F.col("l_shipdate").cast("date")
    booked = F.when(F.dayofmonth(shipped) == 13, F.date_add(shipped, 1)).otherwise(shipped)
    fact = views.table(spark, sf_dir, "lineitem").select(keys.time_key(booked).alias("time_key"))
    return quality.trading_days_without_sales(dims.trading_calendar(views.dim_time(spark, sf_dir)), fact)


def multi_distributor_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product-months that more than one supplier delivered, with their invoices."""
    lines = views.table(spark, sf_dir, "lineitem").select(
        keys.time_key("l_shipdate").alias("time_key"),
        views.text("l_suppkey").alias("distributor_code"),
        F.concat_ws("-", views.text("l_partkey"), keys.month_key("l_shipdate").cast("string")).alias("site_code"),
        views.text("l_orderkey").alias("invoice_no"),
    )
    return quality.multi_distributor_sites(lines)


def _site_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = views.hundredths("l_extendedprice")
    return views.table(spark, sf_dir, "lineitem").select(
        views.text("l_suppkey").alias("site_code"),
        keys.time_key("l_shipdate").alias("time_key"),
        cents.cast("double").alias("value"),
        F.col("l_quantity").alias("pieces"),
    )


def control_total_recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual sales per site and day against a control feed that lacks a tenth at sites in debt."""
    actual = _site_days(spark, sf_dir)
    debt = views.table(spark, sf_dir, "supplier").select(
        views.text("s_suppkey").alias("site_code"), (F.col("s_acctbal") < 0).alias("in_debt")
    )
    control = actual.join(debt, "site_code", "left").withColumn(
        "value", F.when(F.col("in_debt"), F.col("value") - F.floor(F.col("value") / 10)).otherwise(F.col("value"))
    )
    deltas = quality.control_total_deltas(actual, control, {"value": "VALUE", "pieces": "QTY"})
    return quality.breached(deltas, 5).select(
        "site_code",
        "time_key",
        whole("act_VALUE"),
        whole("tgt_VALUE"),
        whole("delta_VALUE"),
        "delta_VALUE_prcntg",
        whole("act_QTY"),
        whole("tgt_QTY"),
        whole("delta_QTY"),
        "delta_QTY_prcntg",
    )


def missing_dim_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts nobody sold in January 1996."""
    sold = (
        views.table(spark, sf_dir, "lineitem")
        .filter(keys.month_range("l_shipdate", 199601))
        .select(F.col("l_partkey").alias("p_partkey"))
    )
    return quality.missing_keys(views.table(spark, sf_dir, "part"), sold, "p_partkey")


def missing_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-invoice products outside the standard hierarchy."""
    return quality.missing_products(
        views.promos(spark, sf_dir), views.dim_promotion(spark), views.hierarchy(spark, sf_dir)
    )


def missing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funding ids without an internal order."""
    return quality.missing_orders(views.promos(spark, sf_dir), views.dim_promotion(spark), views.io(spark, sf_dir))


def presence_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products not sold in both January 1996 and January 1997."""
    def sold(month_id: int) -> DataFrame:
        return views.table(spark, sf_dir, "lineitem").filter(keys.month_range("l_shipdate", month_id)).select(views.product_code("l_partkey").alias("product_code"))

    parts = views.table(spark, sf_dir, "part").select(views.product_code("p_partkey").alias("product_code"))
    return quality.presence_flags(
        parts,
        "product_code",
        {
            "sold_in_199601": sold(199601),
            "sold_in_199701": sold(199701),
        },
    )


def brands_missing_in_masters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Funded brands that the local hierarchy or the article master hold under another code."""
    retired = lambda gone: F.when(gone, F.concat(F.lit("old "), F.col("PH7_code"))).otherwise(F.col("PH7_code"))
    local = views.local_product(spark, sf_dir).withColumn("PH7_code", retired(F.col("category") == "Category 2"))
    article = views.article(spark, sf_dir).withColumn("PH7_code", retired(F.col("PH4_description") == "Market 3"))
    return quality.brands_missing_in_masters(
        views.promos(spark, sf_dir), views.dim_promotion(spark), views.io(spark, sf_dir), local, article
    )


def unknown_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotion types missing from a promotion dimension that names display types otherwise."""
    renamed = F.when(F.col("promo_summarized") == "DISPLAY", F.concat(F.lit("D_"), F.col("promotion_type"))).otherwise(F.col("promotion_type"))
    known = views.dim_promotion(spark).withColumn("promotion_type", renamed)
    return quality.unknown_types(views.promos(spark, sf_dir), known)


def unexpected_gifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gift-flagged lines of other mechanisms, with the on/off flag taken from the invoice status."""
    flagged = views.promo_feed(spark, sf_dir).withColumn(
        "on_off_flag", F.when(F.col("promotion_mechanism") == "LN", 0).otherwise(1)
    )
    return quality.unexpected_gifts(flagged).groupBy("promotion_type", "promotion_mechanism").agg(rows())


def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice and product pairs that occur on several lines."""
    return quality.duplicate_keys(views.table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidation check that fails: invoices against invoice lines."""
    return quality.row_count_mismatch(views.table(spark, sf_dir, "orders"), views.table(spark, sf_dir, "lineitem"))


def type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts by promotion type; an always-empty subset check rides along."""
    typed = views.lines(spark, sf_dir).select(views.promotion_type().alias("promotion_type"))
    profile = quality.counts_by(typed, "promotion_type")
    gap = quality.subset_count_mismatch(typed, "promotion_type", ["DTRDIS", "BASKET"]).select(
        F.lit("subset mismatch").alias("promotion_type"), F.col("rows_total").alias("row_count")
    )
    return profile.unionByName(gap)


def missing_salesman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose salesman the master knows under another code, as it does those in debt."""
    code = F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey")).otherwise(-F.col("s_suppkey"))
    salesman = views.table(spark, sf_dir, "supplier").select(code.alias("l_suppkey"), F.col("s_name").alias("salesforce"))
    joined = views.table(spark, sf_dir, "lineitem").join(salesman, "l_suppkey", "left")
    return quality.null_count(joined, "salesforce")


def _layers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    processed = views.promos(spark, sf_dir)
    # The on-invoice branch alone: everything off-invoice is missing downstream.
    transformed = processed.join(promo.promotion_keys(views.dim_promotion(spark), "ON"), "promotion_type", "left_semi")
    return processed, transformed


def layer_recon_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed against transformed value, off by ten percent or more."""
    deltas = quality.processed_vs_transformed(*_layers(spark, sf_dir))
    return quality.breached_layers(deltas, 10).select(
        "promotion_type",
        "promotion_mechanism",
        whole("prc_promotion_value"),
        whole("trn_promotion_value"),
        F.round("delta_prcntg", 4).alias("delta_prcntg"),
    )


def layer_recon_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily against monthly totals with every delta shown; the roll-up must lose nothing."""
    daily = promo.on_invoice(
        views.promos(spark, sf_dir), views.dim_promotion(spark), views.hierarchy(spark, sf_dir), views.io(spark, sf_dir)
    )
    rolled = monthly.month_rows(daily, "ON")
    return quality.daily_vs_monthly(daily, rolled).select(
        "promotion_type",
        "promotion_mechanism",
        whole("trn_promotion_value"),
        whole("agg_promotion_value"),
        whole("delta_promotion_value"),
    )


def layer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of two layers by type and mechanism, in order."""
    processed, transformed = _layers(spark, sf_dir)
    named = [("1 processed", processed), ("2 transformed", transformed)]
    union = None
    for name, layer in named:
        sums = quality.layer_totals(layer).select(
            F.lit(name).alias("layer"), "promotion_type", "promotion_mechanism", whole("promotion_value")
        )
        union = sums if union is None else union.unionByName(sums)
    return union.orderBy("layer", "promotion_type", "promotion_mechanism")


def ungrouped_off_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Off-invoice rows whose funding found no product group."""
    lines = promo.off_invoice_lines(views.promos(spark, sf_dir), views.dim_promotion(spark), views.bridge(spark, sf_dir))
    off = promo.off_invoice_other(lines, promo.io_brands(views.io(spark, sf_dir), views.hierarchy(spark, sf_dir)))
    return quality.ungrouped_off_rows(off)


def scope_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site list against a hand-kept list of the larger sites."""
    listed = views.table(spark, sf_dir, "supplier").select(
        views.text("s_suppkey").alias("Site"),
        F.when(F.col("s_acctbal") >= -500, "DT DISTRIBUTOR").otherwise("OTHER").alias("Distributor Type"),
    )
    return quality.scope_mismatch(dims.site_list(views.distributors(spark, sf_dir)), listed)


def returned_invoice_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which the originals of returned lines were sold."""
    from promoledger.queries.sales import returns_fact

    fact = returns_fact(spark, sf_dir)
    return quality.returned_invoice_days(fact, fact)


def latest_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the newest load in a six-week window, per day."""
    fact = views.table(spark, sf_dir, "lineitem").filter(keys.day_range("l_shipdate", 20000115, 20000225)).select(
        keys.time_key("l_shipdate").alias("time_key"),
        keys.month_key("l_shipdate").alias("insert_ts"),
        F.year("l_shipdate").alias("update_ts"),
    )
    return quality.latest_batch_counts(fact, 20000115, 20000225)


def invoice_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every loyalty line of one funding id, as an auditor would pull it."""
    return (
        quality.trace(views.promos(spark, sf_dir), promotion_type="LTYPRG", IO="LN00000003")
        .groupBy("time_key")
        .agg(rows(), total("promotion_value"))
    )


QUERIES = {
    f.__name__: f
    for f in (
        trading_days_without_sales,
        multi_distributor_sites,
        control_total_recon,
        missing_dim_keys,
        missing_products,
        missing_orders,
        presence_flags,
        brands_missing_in_masters,
        unknown_types,
        unexpected_gifts,
        dup_keys,
        row_counts,
        type_profile,
        missing_salesman,
        layer_recon_pct,
        layer_recon_exact,
        layer_totals,
        ungrouped_off_rows,
        scope_mismatch,
        returned_invoice_days,
        latest_batch_counts,
        invoice_trace,
    )
}

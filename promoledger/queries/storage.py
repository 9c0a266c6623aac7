"""Queries that go through storage: writes land in the cluster's shared folder and are read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger import schemas
from promoledger.functions import crypto, keys
from promoledger.operators import dims, feed
from promoledger.operators.joins import in_calendar, latest_per_key
from promoledger.plans import daily_sales, reference_data
from promoledger.queries import views
from promoledger.queries.sales import returns_fact
from promoledger.queries.shape import rows, whole
from promoledger.session import new_work_path, stage
from promoledger.sinks import tables, writers
from promoledger.sources import readers, snapshots

# A key for the round-trip query only; jobs take theirs from a secret store.
_EXAMPLE_KEY = b"0123456789abcdef"


def _monthly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        views.hundredths("l_extendedprice").alias("gross_cents"),
        keys.time_key("l_shipdate").alias("time_key"),
        keys.year_key("l_shipdate").alias("year_id"),
        keys.month_key("l_shipdate").alias("month_id"),
        "l_shipdate",
    )


def month_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of the table is reloaded with corrected values; all other months stay."""
    path = new_work_path(spark, "month-reload")
    lines = _monthly_lines(spark, sf_dir)
    writers.append_partitions(lines.drop("l_shipdate"), path, ("year_id", "month_id"))
    march = lines.filter(keys.month_range("l_shipdate", 199803)).drop("l_shipdate")
    corrected = march.filter(F.col("time_key") % 100 != 1).withColumn("gross_cents", F.col("gross_cents") * 2)
    writers.reload_months(corrected, path, [199803])
    return spark.read.parquet(path).groupBy("month_id").agg(rows(), F.sum("gross_cents").alias("gross_cents"))


def partition_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned write, dynamic overwrite of one month, read back of one partition next to the whole."""
    path = new_work_path(spark, "partitions")
    lines = _monthly_lines(spark, sf_dir).drop("l_shipdate")
    writers.overwrite_partitions(lines, path, ("year_id", "month_id"))
    negated = lines.filter(F.col("month_id") == 199702).withColumn("gross_cents", -F.col("gross_cents"))
    writers.overwrite_partitions(negated, path, ("year_id", "month_id"))
    one = readers.read_partition(spark, path, year_id=1997, month_id=199702)
    whole_table = spark.read.parquet(path)

    def profile(df: DataFrame, scope: str) -> DataFrame:
        return df.groupBy("month_id").agg(rows(), F.sum("gross_cents").alias("gross_cents")).withColumn(
            "scope", F.lit(scope)
        )

    return profile(one, "partition").unionByName(profile(whole_table, "table"))


def calendar_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored fact on the last months of quarters with 26 trading days or more: the calendar says which folders are read."""
    root = new_work_path(spark, "calendar")
    writers.append_partitions(_monthly_lines(spark, sf_dir).drop("l_shipdate"), f"{root}/fact", ("year_id", "month_id"))
    days = dims.trading_calendar(views.dim_time(spark, sf_dir))
    days.groupBy(F.col("year_month").alias("month_id")).agg(F.sum("trading_day").alias("trading_days")).write.parquet(f"{root}/calendar")
    months = spark.read.parquet(f"{root}/calendar").filter((F.col("month_id") % 100 % 3 == 0) & (F.col("trading_days") >= 26))
    return in_calendar(spark.read.parquet(f"{root}/fact"), months, "month_id").groupBy("month_id").agg(rows(), F.sum("gross_cents").alias("gross_cents"))


def export_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven days exported to part files and read back."""
    path = new_work_path(spark, "export")
    first, last = keys.day_window(20000304, 7)
    writers.export_window(_monthly_lines(spark, sf_dir), path, "time_key", first, last, date="l_shipdate")
    return spark.read.parquet(path).select("l_orderkey", "l_partkey", "time_key", "gross_cents")


def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily merge against a stored table booked at month ends: a reload of a day, then its merge.

    Two loads are told apart per month (odd and even amounts): the reload drops
    the later one, the merge updates what is left of the earlier one.
    """
    path = new_work_path(spark, "upsert")
    lines = views.table(spark, sf_dir, "lineitem").select(
        views.product_code("l_partkey").alias("product_code"),
        views.text("l_orderkey").alias("invoice_number"),
        keys.time_key("l_shipdate").alias("day"),
        views.hundredths("l_extendedprice").alias("gross_cents"),
    )
    table = latest_per_key(lines, ["product_code", "invoice_number"], ["day", "gross_cents"]).select(
        "product_code",
        "invoice_number",
        "gross_cents",
        (F.floor(F.col("day") / 100) * 10 + F.col("gross_cents") % 2).alias("insert_ts"),
        F.floor(F.col("day") / 10000).cast("int").alias("year_id"),
        F.floor(F.col("day") / 100).cast("int").alias("month_id"),
        keys.month_end_key("day").alias("time_key"),
    )
    writers.append_partitions(table, path)
    feed_rows = spark.read.parquet(path).filter(F.col("time_key") == 20000331).withColumns(
        {"gross_cents": F.col("gross_cents") + 7, "insert_ts": F.lit(2099010).cast("long")}
    )
    staged_feed, _ = stage(feed_rows, "upsert-feed")
    tables.upsert_days(spark, path, staged_feed, 20000331)
    return spark.read.parquet(path).groupBy("month_id", "insert_ts").agg(
        rows(), F.sum("gross_cents").cast("long").alias("gross_cents")
    )


def returns_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns of a month restated in a fact stored by ten days: their rows leave their folders and enter those of their originals."""
    path = new_work_path(spark, "returns")
    fact = returns_fact(spark, sf_dir).drop("original").withColumn("time_key", (F.floor(F.col("time_key") / 10) * 10).cast("int"))
    writers.append_partitions(fact, path)
    tables.restate_returns_in_place(spark, path, month=200003)
    stored = spark.read.parquet(path)
    returned = F.count_if(F.col("sales_ret_ref_invoice_number") != "0").alias("returned_rows")
    return stored.groupBy("year_id", "month_id", "time_key").agg(rows(), F.sum("gross_cents").alias("gross_cents"), returned)


def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three daily loads and a reload of the last: conform, enrich, merge, restate returns, export; the fact and what was exported.

    Brands are the products, lines the invoices; a return refers to the first sale
    of its brand in the month, which the job knows if it was loaded by then.
    """
    root = new_work_path(spark, "daily")
    paths = daily_sales.SalesPaths(*[f"{root}/{layer}" for layer in ("processed", "fact", "export")])
    part = views.table(spark, sf_dir, "part").select("p_partkey", views.brand_number().alias("brand"))
    item = views.table(spark, sf_dir, "lineitem").join(part, F.col("p_partkey") == F.col("l_partkey"))
    lines = item.select(
        F.concat_ws("-", views.text("l_orderkey"), views.text("l_linenumber")).alias("invoice"), "brand", "l_returnflag", views.text("l_suppkey").alias("supplier"),
        F.col("l_shipdate").cast("date").alias("day"), views.hundredths("l_extendedprice").alias("cents"), keys.month_key("l_shipdate").alias("month"),
    )
    first = lines.filter(F.col("l_returnflag") != "R").groupBy("brand", "month").agg(F.min(F.struct("day", "invoice")).alias("first"))
    returned = (F.col("l_returnflag") == "R") & F.col("first").isNotNull()
    day = lambda fmt: F.date_format("day", fmt)
    text = lines.join(first, ["brand", "month"], "left").select(
        F.lit("VN").alias("CountryCode"), F.lpad(views.text("brand"), 18, "0").alias("ArticleCode"), F.col("invoice").alias("InvoiceNumber"), F.col("supplier").alias("SiteCode"),
        F.col("supplier").alias("SalesmanCode"), F.when(returned, F.col("first.invoice")).otherwise("0").alias("SalesReturnReferenceInvoiceNumber"), F.col("day").alias("InvoiceDate"),
        views.text("cents").alias("GrossSalesValue"), day("yyyy").alias("YYYY"), day("MM").alias("MM"), day("dd").alias("DD"),
    )
    raw, _ = stage(schemas.conform(text, schemas.RAW_INVOICE_LINES), "raw-lines")
    salesman = views.table(spark, sf_dir, "supplier").select(views.text("s_suppkey").alias("salesman_code"), F.concat(F.lit("SF"), views.text("s_nationkey")).alias("salesforce"))
    product = part.select(F.lpad(views.text("brand"), 8, "0").alias("product_code"), F.concat(F.lit("B"), views.text("brand")).alias("brand"), F.lit("C").alias("category_code"), F.lit("K").alias("cotc"))
    for run, load in enumerate((20000301, 20000302, 20000303, 20000303)):
        daily_sales.load_day(spark, raw, salesman, product, load, paths, batch_ts=F.lit(f"2000-03-0{run + 1} 12:00:00").cast("timestamp"))
    shown = ["invoice_number", "product_code", "time_key", "month_id", F.round("gross_sales_val").cast("long").alias("gross_value"), "salesforce", "brand_cat_core", F.dayofmonth("insert_ts").alias("run")]
    fact = spark.read.parquet(paths.fact).select(*shown, F.lit("fact").alias("layer"))
    return fact.unionByName(spark.read.parquet(paths.export).select(*shown, F.lit("export").alias("layer")))


def history_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two backfills that share all months, the first run again: rows by batch and month, undated lines of both without one."""
    root = new_work_path(spark, "history")
    paths = daily_sales.SalesPaths(*[f"{root}/{layer}" for layer in ("processed", "fact", "export")])
    cents = views.hundredths("l_extendedprice")
    undated = (F.col("l_linenumber") == 1) & (F.col("l_tax") >= 0.08)
    raw = schemas.conform(
        views.table(spark, sf_dir, "lineitem").select(
            F.lit("VN").alias("CountryCode"),
            F.lpad(views.text("l_partkey"), 18, "0").alias("ArticleCode"),
            views.text("l_orderkey").alias("InvoiceNumber"),
            views.text("l_suppkey").alias("SiteCode"),
            views.text("l_suppkey").alias("SalesmanCode"),
            F.col("l_returnflag").alias("CustomerZRSSFlag"),
            F.when(~undated, F.trunc("l_shipdate", "month")).alias("InvoiceDate"),
            cents.cast("string").alias("GrossSalesValue"),
        ),
        schemas.RAW_INVOICE_LINES,
    )
    salesman = views.table(spark, sf_dir, "supplier").select(views.text("s_suppkey").alias("salesman_code"), F.concat(F.lit("SF"), views.text("s_nationkey")).alias("salesforce"))
    product = views.table(spark, sf_dir, "part").select(views.product_code("p_partkey").alias("product_code"), F.col("p_brand").alias("brand"), F.col("p_type").alias("category_code"), views.text("p_size").alias("cotc"))
    stamp = F.lit("2001-12-01 00:00:00").cast("timestamp")
    returned = F.col("CustomerZRSSFlag") == "R"
    for name, batch in (("sales", ~returned), ("returns", returned), ("sales", ~returned)):
        daily_sales.load_history(spark, raw.filter(batch), salesman, product, paths, batch_ts=stamp, batch_id=name)
    value = F.sum(F.round("gross_sales_val").cast("long")).alias("gross_value")
    fact = spark.read.parquet(paths.fact).groupBy("batch_id", "month_id").agg(rows(), value, F.count("salesforce").alias("with_salesforce"))
    left = spark.read.parquet(daily_sales.undated_path(paths)).groupBy("batch_id", "month_id").agg(rows(), value)
    return fact.unionByName(left.withColumn("with_salesforce", F.lit(0).cast("long")))


def pii_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names encrypted, stored, read back and decrypted."""
    path = new_work_path(spark, "pii")
    named = views.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    csv_path, parquet_path = f"{path}/csv", f"{path}/parquet"
    writers.write_copies(crypto.encrypt_columns(named, ["c_name"], _EXAMPLE_KEY), csv_path, parquet_path)
    stored = readers.read_csv_back(spark, csv_path, ["c_custkey", "c_name"])
    opened = crypto.decrypt_columns(stored, ["c_name"], _EXAMPLE_KEY)
    return opened.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name")


def snapshot_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article file in dated folders: the newest month is resolved, conformed and stored."""
    root = new_work_path(spark, "article-master")
    part = views.table(spark, sf_dir, "part").select(
        F.lpad(views.text("p_partkey"), 8, "0").alias("material_code"),
        F.col("p_name").alias("material_desc"),
        F.concat(F.format_number("p_retailprice", 2), F.when(F.col("p_size") > 40, "-").otherwise("")).alias(
            "price_per_su"
        ),
        views.text("p_size").alias("PC_per_SU"),
        F.lit("2019-01-28 00:00:00").alias("creation_date"),
        F.col("p_brand").alias("PH7_code"),
    )
    text = schemas.struct(s=" ".join(schemas.ARTICLE_MASTER.fieldNames()))
    for folder, price in (("2018/12", "1"), ("2019/2", None)):
        shown = part if price is None else part.withColumn("price_per_su", F.lit(price))
        schemas.conform(shown, text).write.option("header", True).csv(f"{root}/in/{folder}")
    reference_data.conform_article_master(spark, f"{root}/in", f"{root}/out")
    return spark.read.parquet(f"{root}/out").select(
        "material_code",
        F.round(F.col("price_per_su") * 100).cast("long").alias("price_cents"),
        "PC_per_SU",
        "creation_date",
        "PH7_code",
        "param1",
    )


def report_export_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as ;-separated text with preamble, header and total lines, read back and cleaned."""
    path = new_work_path(spark, "report-export")
    shown = F.format_number(F.col("l_extendedprice"), 2)
    signed = F.when(F.col("l_returnflag") == "R", F.concat(shown, F.lit("-"))).otherwise(shown)
    item = views.table(spark, sf_dir, "lineitem").select(
        F.lit("VN").alias("country"),
        F.date_format("l_shipdate", "dd.MM.yyyy").alias("calendar_day"),
        views.text("l_suppkey").alias("distributor"),
        views.text("l_suppkey").alias("site"),
        views.text("l_suppkey").alias("outlet"),
        views.text("l_orderkey").alias("billing_document"),
        views.text("l_linenumber").alias("billing_item"),
        views.product_code("l_partkey").alias("product"),
        F.concat(F.lit("LN"), views.scheme()).alias("promotion_id"),
        F.col("l_returnflag").alias("promotion_type"),
        signed.alias("value_based_promo_disc"),
    )
    nation = views.table(spark, sf_dir, "nation")
    preamble = nation.select(F.concat(F.lit("Report "), "n_name").alias("country"))
    header = nation.select(F.lit("Country").alias("country"), F.lit("Calendar day").alias("calendar_day"))
    footer = nation.select(F.lit("VN").alias("country"), F.lit("Overall Result").alias("calendar_day"))
    feed_text = schemas.conform(item, schemas.PROMO_FEED)
    for junk in (preamble, header, footer):
        feed_text = feed_text.unionByName(schemas.conform(junk, schemas.PROMO_FEED))
    feed_text.write.option("sep", ";").csv(path)
    raw = readers.read_report_export(spark, path, schemas.PROMO_FEED)
    cleaned = feed.clean_promo_feed(raw, dims.site_list(views.distributors(spark, sf_dir)))
    return cleaned.groupBy("promotion_type", F.floor(F.col("time_key") / 100).alias("month_id")).agg(
        rows(), F.sum(F.round(F.col("value_based_promo_disc") * 100).cast("long")).alias("value_cents")
    )


def newest_stored_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers stored as two dated snapshots; the newest folder is found and read."""
    root = new_work_path(spark, "snapshots")
    customer = views.table(spark, sf_dir, "customer").select(views.text("c_custkey").alias("code"), "c_mktsegment")
    customer.withColumn("c_mktsegment", F.lit("OLD")).write.option("header", True).csv(f"{root}/2020/9/30")
    customer.write.option("header", True).csv(f"{root}/2020/10/2")
    return readers.read_csv_text(spark, snapshots.latest_snapshot(spark, root)).groupBy("c_mktsegment").agg(
        rows(), F.sum(F.col("code").cast("long")).alias("code_sum")
    )


QUERIES = {
    "month_reload": month_reload,
    "partition_write_read": partition_write_read,
    "export_window": export_window,
    "calendar_scope": calendar_scope,
    "upsert_stored": upsert_stored,
    "returns_in_place": returns_in_place,
    "daily_job": daily_job,
    "history_two_batches": history_two_batches,
    "pii_roundtrip": pii_roundtrip,
    "snapshot_master": snapshot_master,
    "report_export_read": report_export_read,
    "newest_stored_snapshot": newest_stored_snapshot,
}

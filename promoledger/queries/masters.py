"""Masters with rejects, snapshots with fallback, and catalog tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger import schemas
from promoledger.functions import keys
from promoledger.plans import reference_data
from promoledger.queries import views
from promoledger.queries.shape import rows
from promoledger.session import new_work_path
from promoledger.sinks import writers
from promoledger.sources import readers, snapshots


def _master_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Five master files as text, each with rows that break its contract."""
    part, order = views.table(spark, sf_dir, "part"), views.table(spark, sf_dir, "orders")
    nation = views.table(spark, sf_dir, "nation")
    split = order.groupBy(F.year("o_orderdate").cast("string").alias("year"), keys.quarter_label("o_orderdate").alias("quarter"), F.col("o_orderpriority").alias("channel")).agg(F.count(F.lit(1)).alias("n"))
    return {
        "budget_holder": nation.select(F.when(F.col("n_regionkey") != 2, F.col("n_name")).alias("budget_holder"), views.text("n_regionkey").alias("budget_holder_grp")),
        "gift_master": part.select(
            views.product_code("p_partkey").alias("gift_code"),
            F.col("p_name").alias("gift_name"),
            F.when(F.col("p_size") > 45, F.lit("dozen")).when(F.col("p_size") > 40, F.lit("1.5")).otherwise(F.concat(views.text("p_size"), F.lit(".0"))).alias("packing_per_case"),
            F.when(F.col("p_size") > 48, F.lit("tall")).otherwise(views.text("p_retailprice")).alias("size_h"),
        ),
        "io_master": order.select(
            views.text("o_orderkey").alias("promotion_id"),
            F.when(F.col("o_orderpriority") != "5-LOW", views.text("o_custkey")).alias("brand_code"),
            F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(views.hundredths("o_totalprice").cast("string")).alias("brand_investment"),
        ),
        "local_product": part.select(F.when(F.col("p_size") < 50, views.product_code("p_partkey")).alias("material"), F.col("p_brand").alias("PH7")),
        "promotion_split": split.select("year", "quarter", "channel", *[F.when((F.col("year") == "1996") & F.lit(c == "Tea"), F.lit("half")).otherwise(F.col("n").cast("string")).alias(c) for c in schemas.SPLIT_CATEGORIES]),
    }


_CHECKED = {"budget_holder": "budget_holder_grp", "gift_master": "packing_per_case", "io_master": "brand_investment", "local_product": "PH7", "promotion_split": "Tea"}


def masters_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, rejects and reasons of the five masters, each conformed from its newest file by two runs."""
    root = new_work_path(spark, "masters")
    out = None
    for name, file in _master_files(spark, sf_dir).items():
        schema, levels, _ = reference_data.MASTER_FILES[name]
        schemas.conform(file, schemas.as_text(schema)).write.option("header", True).csv(f"{root}/{name}/" + "/".join(["2020", "2", "9"][:levels]))
        for run in ("first", "second"):
            reference_data.conform_master(spark, name, f"{root}/{name}", f"{root}/out/{name}", f"{root}/rejects/{name}", run)
        checked = F.col(_CHECKED[name])
        number = (F.regexp_extract(checked, r"\d+$", 0) if name == "local_product" else checked.cast("double")).cast("long")
        typed = spark.read.parquet(f"{root}/out/{name}").agg(rows(), F.sum(number).alias("checksum"))
        found = spark.read.option("header", True).csv(f"{root}/rejects/{name}")
        reasons = found.agg(F.count_if(F.col("run") == "first").alias("n_first"), F.count_if(F.col("run") == "second").alias("n_second"), F.sum(F.size(F.split("reasons", "; "))).alias("n_reasons"))
        part = typed.join(reasons, how="cross").select(F.lit(name).alias("master"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def month_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly snapshots of the outlets: a month that is there is read, one that is not falls back to the newest before it."""
    root = new_work_path(spark, "months")
    outlets = views.table(spark, sf_dir, "customer").select(views.text("c_custkey").alias("code"), "c_mktsegment", "c_nationkey")
    for month in (8, 10):
        outlets.filter(F.col("c_nationkey") < month).drop("c_nationkey").write.option("header", True).csv(f"{root}/2020/{month:02d}")
    out = None
    for asked in ("202008", "202009", "202012"):
        found = readers.read_csv_text(spark, snapshots.month_snapshot(spark, root, asked, fallback=True))
        part = found.groupBy("c_mktsegment").agg(rows()).select(F.lit(asked).alias("month_id"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def _name(label: str) -> str:
    return f"promoledger_{label}_{uuid.uuid4().hex}"


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "lineitem").select("l_orderkey", views.hundredths("l_extendedprice").alias("gross_cents"), keys.year_key("l_shipdate").alias("year_id"), keys.month_key("l_shipdate").alias("month_id"))


def catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table over a partitioned path: folders written after it was declared are recovered, then read by name."""
    path, name, parts = new_work_path(spark, "catalog"), _name("months"), ("year_id", "month_id")
    months = _months(spark, sf_dir)
    writers.append_partitions(months.filter("year_id < 1999"), path, parts)
    writers.register_table(spark, name, months.schema, path, parts)
    writers.append_partitions(months.filter("year_id >= 1999"), path, parts)
    writers.register_table(spark, name, months.schema, path, parts)
    return readers.read_table(spark, name).groupBy("year_id", "month_id").agg(rows(), F.sum("gross_cents").alias("gross_cents"))


def exception_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declared table of offenders, filled by two runs: it holds those of the second."""
    name, schema = _name("offenders"), schemas.struct(s="segment", l="outlet")
    spark.sql(writers.table_ddl(name, schema, new_work_path(spark, "offenders")))
    customer = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("outlet"), F.col("c_mktsegment").alias("segment"), "c_acctbal")
    for bad in (F.col("c_acctbal") >= 0, F.col("c_acctbal") < 0):
        writers.insert_exceptions(customer.filter(bad), name)
    return readers.read_table(spark, name).select("outlet", "segment")


def catalog_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of the newest outlets, both sides catalog tables with column statistics."""
    path = new_work_path(spark, "statistics")
    lines = views.lines(spark, sf_dir).select("o_custkey", views.hundredths("l_extendedprice").alias("gross_cents"))
    outlets = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    named = {}
    for label, df, columns in (("lines", lines, ["o_custkey"]), ("outlets", outlets, ["o_custkey", "c_acctbal"])):
        writers.write_small(df, f"{path}/{label}")
        named[label] = writers.register_table(spark, _name(label), df.schema, f"{path}/{label}", statistics=columns)
    rich = named["outlets"].filter(F.col("c_acctbal") > 9000)
    return named["lines"].join(rich, "o_custkey").groupBy("c_mktsegment").agg(rows(), F.sum("gross_cents").alias("gross_cents"))


QUERIES = {
    "masters_with_rejects": masters_with_rejects,
    "month_fallback": month_fallback,
    "catalog_partitions": catalog_partitions,
    "exception_table": exception_table,
    "catalog_statistics": catalog_statistics,
}

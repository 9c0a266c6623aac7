"""Masters and references: file -> typed parquet, the IO proportions, and the coded dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger import schemas, session
from promoledger.functions import parse
from promoledger.operators import coded_dims, dims, io_master, quality
from promoledger.sinks import writers
from promoledger.sources import readers, snapshots, storage

# name -> (contract, folder levels of the snapshot, key columns)
MASTER_FILES = {
    "budget_holder": (schemas.BUDGET_HOLDER, 3, ["budget_holder"]),
    "gift_master": (schemas.GIFT_MASTER, 2, ["gift_code"]),
    "io_master": (schemas.IO_MASTER, 2, ["promotion_id", "brand_code"]),
    "local_product": (schemas.LOCAL_PRODUCT_FILE, 2, ["material"]),
    "promotion_split": (schemas.PROMOTION_SPLIT, 3, ["year", "quarter", "channel"]),
}
_DAMAGED = "damaged_line"


def conform_master(spark: SparkSession, name: str, root: str, path: str, rejects: str | None = None, run: str = "1") -> None:
    """Newest file of a master under its declared contract -> parquet, without the rows that do not meet it.

    Those are appended to the headed CSV table ``rejects``, under the folder of this
    ``run``, as they came and with the reasons; a run that is repeated replaces its
    own. The file is read once.
    """
    schema, levels, keys = MASTER_FILES[name]
    folder = snapshots.latest_snapshot(spark, root, levels)
    text = schemas.as_text(schema).add(_DAMAGED, "string")
    reader = spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE")
    raw = reader.option("columnNameOfCorruptRecord", _DAMAGED).option("columnPruning", "false").csv(folder)
    staged, staged_path = session.stage(schemas.judged(raw, schema, keys, F.col(_DAMAGED).isNotNull()), f"master-{name}")
    try:
        writers.write_small(staged.filter(F.size("reasons") == 0).select("typed.*"), path)
        if rejects:
            bad = staged.filter(F.size("reasons") > 0)
            columns = [F.col(f.name) for f in schema]
            writers.append_exceptions(bad.select(F.concat_ws("; ", "reasons").alias("reasons"), *columns), rejects, run)
    finally:
        storage.delete_folder(spark, staged_path)


def conform_article(raw: DataFrame) -> DataFrame:
    """Article file (all text, contract order) -> typed article master.

    The price may carry commas and a trailing minus, the date comes as a
    timestamp text, pack sizes as text.
    """
    dated = F.to_date(
        F.coalesce(
            F.try_to_timestamp("creation_date"), F.try_to_timestamp("creation_date", F.lit("M/d/yyyy"))
        )
    )
    typed = raw.withColumns(
        {
            "price_per_su": parse.report_number("price_per_su"),
            "PC_per_SU": F.col("PC_per_SU").try_cast("double").try_cast("int"),
            "PC_per_CS": F.col("PC_per_CS").try_cast("double").try_cast("int"),
            "creation_date": F.date_format(dated, "yyyy-MM-dd"),
        }
    )
    return schemas.conform(typed, schemas.ARTICLE_MASTER)


def conform_article_master(spark: SparkSession, root: str, path: str) -> None:
    text = schemas.struct(s=" ".join(schemas.ARTICLE_MASTER.fieldNames()))
    raw = readers.read_csv(spark, snapshots.latest_month(spark, root), text)
    writers.write_small(conform_article(raw), path)


def build_io_reference(
    spark: SparkSession,
    io_root: str,
    budget_holder: DataFrame,
    local_product: DataFrame,
    path: str,
    year: int,
    month: int,
    brand_map: DataFrame | None = None,
) -> None:
    """IO master -> allocation proportions of the month, with brand remap when a map is given."""
    current = spark.read.parquet(snapshots.latest_month(spark, io_root))
    previous = None
    if io_master.needs_previous_year(month):
        previous = spark.read.parquet(snapshots.latest_month(spark, io_root, year - 1))
    io = io_master.latest_io(current, previous, year)
    if brand_map is not None:
        duplicates = quality.duplicate_keys(brand_map, "PH7_old")
        quality.run_checks([quality.CheckResult("duplicate_old_brand_codes", duplicates, quality.STOP)])
        io = io_master.remap_brand(io, brand_map)
    proportions = io_master.io_proportions(
        io, budget_holder, dims.brand_categories(local_product), keep_unmapped=brand_map is not None
    )
    writers.write_small(proportions, f"{path}/{year}/{month:02d}")


def build_dimensions(
    channels: DataFrame,
    regions: DataFrame,
    local_product: DataFrame,
    budget_holder: DataFrame,
    store_size: DataFrame,
    promo_all: DataFrame,
    dim_promotion: DataFrame,
    path: str,
) -> None:
    """Coded lists -> consolidated codes, dynamic axis and flexible promotion axis."""
    channel = coded_dims.coded_channel(channels)
    region = coded_dims.coded_region(regions)
    category = coded_dims.coded_category(local_product)
    size = coded_dims.coded_store_size(store_size)
    holder = coded_dims.coded_budget_holder(budget_holder)
    writers.write_small(
        coded_dims.coded_consolidated(channel, region, category, holder, store_size), f"{path}/dim_coded_consolidated"
    )
    writers.write_small(coded_dims.dynamic_axis(region, channel, size, category), f"{path}/dim_dynamic_axis")
    writers.write_small(coded_dims.promo_axis(promo_all, dim_promotion, holder), f"{path}/dim_promo_flexible")

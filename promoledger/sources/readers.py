"""Readers for masters, feeds and facts. A schema is always declared or all-string: never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger import schemas
from promoledger.functions import parse


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Headed CSV, every column a string (codes keep their leading zeros)."""
    return spark.read.option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, sep: str = ",") -> DataFrame:
    """CSV under a declared schema; columns match by position."""
    return spark.read.option("header", header).option("sep", sep).schema(schema).csv(path)


def read_csv_back(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Headless CSV (as written by ``write_copies``) read back under the given names."""
    return read_csv(spark, path, schemas.struct(s=" ".join(columns)), header=False)


def read_report_export(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """``;``-delimited report exports with preamble, header and total lines still inside.

    Files are read as one splittable multi-file scan. Which lines are data is
    decided by content (``report_rows``), not by position, so files may be split
    anywhere and no line order is needed.
    """
    reader = spark.read.option("sep", ";").option("pathGlobFilter", "*csv*").schema(schema)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


DATA, HEADER, TOTAL, REJECT, PREAMBLE = "data", "header", "total", "reject", "preamble"
_DAMAGED = "__damaged"


def read_report_files(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, ours: Column, header: Column, total: Column, day: Column
) -> DataFrame:
    """Lines of report exports with ``source_file`` and ``line_kind``, so every line of every file can be accounted for.

    ``ours`` tells the lines that belong to the table, ``header`` and ``total`` the
    export's own; ``day`` is the parsed day of a data line. A line of ours with too
    few or too many fields, or without a day, is a reject: it is kept with what it
    holds, and counted, but it is no data. Whatever else there is, is preamble.
    """
    damaged = T.StructType([*schema.fields, T.StructField(_DAMAGED, T.StringType())])
    reader = spark.read.schema(damaged).option("sep", ";").option("pathGlobFilter", "*csv*").option("recursiveFileLookup", "true")
    # Without column pruning: fields are only counted where all of them are parsed.
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _DAMAGED).option("columnPruning", "false")
    raw = reader.csv(list(paths) if not isinstance(paths, str) else paths).select("*", F.col("_metadata.file_path").alias("source_file"))
    yes = lambda c: F.coalesce(c, F.lit(False))
    whole = F.col(_DAMAGED).isNull() & day.isNotNull()
    kind = F.when(yes(header), HEADER).when(yes(total), TOTAL).when(yes(ours), F.when(whole, DATA).otherwise(REJECT)).otherwise(PREAMBLE)
    return raw.withColumn("line_kind", kind).drop(_DAMAGED)


def read_promo_files(spark: SparkSession, paths: str | Sequence[str], country: str = "VN") -> DataFrame:
    """The promotion export, line by line, with file and kind."""
    first = F.upper(F.trim("country"))
    total = (first == country.upper()) & (F.upper("calendar_day") == "OVERALL RESULT")
    return read_report_files(spark, paths, schemas.PROMO_FEED, first == country.upper(), first == "COUNTRY", total, parse.report_day_key("calendar_day"))


def read_control_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The control-total export, line by line, with file and kind; distributors of all types are lines of ours."""
    first = F.upper(F.trim("calendar_day"))
    ours = first.rlike(r"^\d")
    return read_report_files(spark, paths, schemas.CONTROL_TOTALS, ours, first == "CALENDAR DAY", first == "OVERALL RESULT", parse.report_day_key("calendar_day"))


def data_lines(lines: DataFrame) -> DataFrame:
    """The data lines alone, as the plain reader returns them."""
    return lines.where(F.col("line_kind") == DATA).drop("source_file", "line_kind")


def line_accounts(lines: DataFrame) -> DataFrame:
    """For each file: how many lines it has, and of which kind; a column a kind, adding up to ``n_lines``."""
    kinds = [F.count_if(F.col("line_kind") == kind).alias(f"n_{kind}") for kind in (DATA, HEADER, TOTAL, REJECT, PREAMBLE)]
    return lines.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_lines"), *kinds)


def report_rows(raw: DataFrame, country: str = "VN") -> DataFrame:
    """Data lines of the promotion export: of the country, and no 'Overall Result' total."""
    return raw.filter(
        (F.upper("country") == country.upper()) & (F.upper("calendar_day") != "OVERALL RESULT")
    )


def control_rows(raw: DataFrame) -> DataFrame:
    """Data lines of the control-total export: distributor types starting with DT."""
    return raw.filter(F.upper("distributor_type").startswith("DT"))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def read_partition(spark: SparkSession, root: str, **keys: int | str) -> DataFrame:
    """Rows of one partition sub-tree. Typed literals prune folders; nothing else is listed as data."""
    df = spark.read.parquet(root)
    for name, value in keys.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table with its file listing refreshed."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def constant_relation(spark: SparkSession, rows: Sequence[tuple] | dict, schema: str | T.StructType) -> DataFrame:
    """Small fixed relation (code maps, axis lists) written down in the program.

    Built from literals over a one-row range. Unlike rows shipped from Python, whose
    size the optimizer takes as unknown, it is seen as tiny, so joins to it broadcast.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    data = list(rows.items()) if isinstance(rows, dict) else list(rows)
    entries = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in data
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))


def parameter_row(spark: SparkSession, **values) -> DataFrame:
    """One-row relation of literals."""
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).alias(k) for k, v in values.items()])

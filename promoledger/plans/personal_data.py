"""Salesforce hierarchy with its personal columns encrypted at rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.functions.crypto import decrypt_columns, encrypt_columns
from promoledger.sinks.writers import write_copies

# File column -> our name (fixed values of the file).
SALESFORCE_COLUMNS = {
    "Sold-to party": "sold_to_party",
    "Ship-to party": "ship_to_party",
    "Role": "role",
    "Role ID": "role_id",
    "Role Name": "role_name",
    "Role Business Scope Assignment": "role_business_scope_assignment",
    "Role Email": "email",
    "Role Phone": "role_phone",
    "Role Title": "role_title",
    "LSR 2 Area": "lsr2_area",
    "Primary Sales Organisation": "primary_sales_organisation",
    "Banner": "banner",
    "TFML 2": "tmfl2",
    "Created by": "created_by",
    "Created Time Stamp": "created_ts",
    "Changed by": "changed_by",
    "Changed Time Stamp": "changed_ts",
}
PERSONAL = ("role_name", "email")


def conform_salesforce(raw: DataFrame) -> DataFrame:
    return raw.select(*[F.col(f"`{old}`").alias(new) for old, new in SALESFORCE_COLUMNS.items()])


def protect(raw: DataFrame, key: bytes | Column, csv_path: str, parquet_path: str) -> None:
    """Encrypt names and e-mail addresses and store the rows as CSV and parquet."""
    write_copies(encrypt_columns(conform_salesforce(raw), PERSONAL, key), csv_path, parquet_path)


def reveal(spark: SparkSession, parquet_path: str, key: bytes | Column) -> DataFrame:
    return decrypt_columns(spark.read.parquet(parquet_path), PERSONAL, key)

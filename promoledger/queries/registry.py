"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from promoledger.queries import (
    controls,
    controls_sql,
    dimensions,
    dimensions_sql,
    full_grain,
    full_grain_sql,
    gates,
    gates_sql,
    masters,
    masters_sql,
    promotions,
    promotions_sql,
    sales,
    sales_sql,
    storage,
    storage_sql,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **sales.QUERIES,
    **promotions.QUERIES,
    **dimensions.QUERIES,
    **gates.QUERIES,
    **storage.QUERIES,
    **controls.QUERIES,
    **masters.QUERIES,
    **full_grain.QUERIES,
}
SQL: dict[str, str] = {
    **sales_sql.SQL,
    **promotions_sql.SQL,
    **dimensions_sql.SQL,
    **gates_sql.SQL,
    **storage_sql.SQL,
    **controls_sql.SQL,
    **masters_sql.SQL,
    **full_grain_sql.SQL,
}

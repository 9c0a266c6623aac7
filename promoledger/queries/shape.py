"""Output helpers: whole numbers instead of floating sums, fixed decimals for ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(column: str, name: str | None = None) -> Column:
    """Rounded to a whole number of the unit the value is held in."""
    return F.round(F.col(column)).cast("long").alias(name or column)


def total(column: str, name: str | None = None) -> Column:
    """Sum of the rounded values, exact whatever the row order."""
    return F.sum(F.round(F.col(column)).cast("long")).alias(name or column)


def rows(name: str = "row_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def ratio(column: str, name: str | None = None) -> Column:
    return F.round(F.col(column), 6).alias(name or column)

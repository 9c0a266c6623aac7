"""Text-to-number parsing that turns malformed input into a missing value, never into an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def report_number(text: Column | str) -> Column:
    """``'1,234.50-'`` -> -1234.5: thousands commas go, a dash after the digits negates."""
    plain = F.trim(F.regexp_replace(_col(text), ",", ""))
    unsigned = F.regexp_replace(plain, "-", "").try_cast("double")
    return F.when(F.instr(plain, "-") > 1, -unsigned).otherwise(plain.try_cast("double"))


def unsigned_number(text: Column | str) -> Column:
    """Control-total numbers: commas and any dash are dropped, so the sign is discarded."""
    return F.trim(F.regexp_replace(_col(text), "[,-]", "")).try_cast("double")


def measure(text: Column | str, kind: str = "double") -> Column:
    """Cast or zero. Whole numbers go through double so ``'12.0'`` counts as 12."""
    number = _col(text).try_cast("double")
    if kind != "double":
        number = number.try_cast(kind)
    return F.coalesce(number, F.lit(0).cast(kind))


def report_day_key(text: Column | str, fmt: str = "dd.MM.yyyy") -> Column:
    """``'28.01.2019'`` -> 20190128; anything that is no such date -> null."""
    day = F.try_to_timestamp(_col(text), F.lit(fmt))
    return F.date_format(day, "yyyyMMdd").cast("int")

"""Business rules that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data contract.
GIFT_MECHANISMS = ["FQ", "JR", "NU"]
UNPROCESSED_MECHANISMS = ["JR", "NU"]
# Promotion types that the feed is split by; all others are one more subset.
FEED_SUBSETS = ["DTRDIS", "LINDIS", "BASKET", "VOLDIS"]
MISSING = "NA"
NO_RETURN_REFERENCE = "0"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def or_missing(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(MISSING))


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0.0))


def share(part: Column | str, whole: Column | str) -> Column:
    """part / whole, 0 when the whole is null or 0."""
    return F.coalesce(F.try_divide(_col(part), _col(whole)), F.lit(0.0))


def yes_no(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def one_zero(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def on_off_flag(mechanism: Column | str) -> Column:
    """0 for gifts and non-priced mechanisms, 1 for everything else."""
    return F.when(_col(mechanism).isin(GIFT_MECHANISMS), 0).otherwise(1)


def recode_basket(promotion_type: Column | str, is_off: Column) -> Column:
    """Off-invoice baskets are told apart from on-invoice ones by their own type."""
    t = _col(promotion_type)
    return F.when((t == "BASKET") & is_off, "BASKET_BD").otherwise(t)


def default_holder_group(group: Column | str, promotion_type: Column | str) -> Column:
    fallback = F.when(_col(promotion_type) == "DTRDIS", "Distributor").otherwise("Trade Category")
    return F.coalesce(_col(group), fallback)


def is_banded(description: Column | str, ph8_description: Column | str) -> Column:
    """Bundles: a ``(1+A``-like pattern in the text, or BANDED in hierarchy level 8."""
    by_text = _col(description).rlike(r"\([1-9]\+[A-z0-9]")
    by_level = F.upper(_col(ph8_description)).contains("BANDED")
    return F.coalesce(by_text, F.lit(False)) | F.coalesce(by_level, F.lit(False))

"""Resolve dated snapshot folders (``root/YYYY/MM/DD`` and ``root/YYYY/MM``).

Folder names compare as numbers, so unpadded months and days resolve right.
Only folder names are listed; no data file is opened before the choice is made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.sources.storage import child_folders, exists


def _newest_child(spark: SparkSession, path: str) -> str:
    numbered = [name for name in child_folders(spark, path) if name.isdigit()]
    if not numbered:
        raise FileNotFoundError(f"no dated folder below {path}")
    return f"{path}/{max(numbered, key=int)}"


def latest_snapshot(spark: SparkSession, root: str, levels: int = 3) -> str:
    """Newest ``YYYY/MM/DD`` folder: newest year, then newest month in it, then newest day."""
    path = root.rstrip("/")
    for _ in range(levels):
        path = _newest_child(spark, path)
    return path


def latest_month(spark: SparkSession, root: str, year: int | str | None = None) -> str:
    """Newest ``YYYY/MM`` folder, or the newest month inside a given year."""
    if year is None:
        return latest_snapshot(spark, root, levels=2)
    return _newest_child(spark, f"{root.rstrip('/')}/{year}")


def month_snapshot(spark: SparkSession, root: str, month_id: int | str, fallback: bool = False) -> str:
    """The folder of one month; with ``fallback`` the newest earlier month of that year when absent."""
    year, month = str(month_id)[:4], str(month_id)[4:]
    base = f"{root.rstrip('/')}/{year}"
    exact = f"{base}/{month}"
    if exists(spark, exact) or not fallback:
        return exact
    earlier = [name for name in child_folders(spark, base) if name.isdigit() and int(name) <= int(month)]
    if not earlier:
        raise FileNotFoundError(f"no month folder up to {month_id} below {base}")
    return f"{base}/{max(earlier, key=int)}"


def newest_rows(df: DataFrame, columns: Sequence[str] = ("y", "m", "d")) -> DataFrame:
    """Rows of the newest snapshot when the snapshot keys are (partition) columns.

    The newest key is a scalar subquery over the key columns alone, so for
    partition columns the second scan is pruned to one folder.
    """
    key = F.struct(*columns)
    newest = df.agg(F.max(key)).scalar()
    return df.filter(key == newest)

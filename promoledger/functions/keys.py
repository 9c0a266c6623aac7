"""Integer calendar keys: time_key = yyyyMMdd, month_id = yyyyMM, year_id = yyyy."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_key(date: Column | str) -> Column:
    d = _col(date)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_key(date: Column | str) -> Column:
    d = _col(date)
    return F.year(d) * 100 + F.month(d)


def year_key(date: Column | str) -> Column:
    return F.year(_col(date))


def key_to_date(key: Column | str) -> Column:
    return F.try_to_timestamp(_col(key).cast("string"), F.lit("yyyyMMdd")).cast("date")


def month_end_key(key: Column | str) -> Column:
    """Day key -> day key of the last day of its month."""
    return time_key(F.last_day(key_to_date(key)))


def quarter_label(date: Column | str) -> Column:
    return F.concat(F.lit("Quarter "), F.quarter(_col(date)).cast("string"))


def pad_code(code: Column | str, width: int = 10) -> Column:
    """Zero-pad on the left; like SQL ``lpad`` it also truncates longer codes."""
    return F.lpad(_col(code), width, "0")


def last_chars(text: Column | str, n: int) -> Column:
    return F.right(_col(text), F.lit(n))


# --- the same arithmetic on the driver, for job parameters -------------------


def parse_day(day_key: int | str) -> dt.date:
    return dt.datetime.strptime(str(day_key), "%Y%m%d").date()


def shift_day(day_key: int | str, days: int) -> int:
    return int((parse_day(day_key) + dt.timedelta(days=days)).strftime("%Y%m%d"))


def day_window(day_key: int | str, days: int) -> tuple[int, int]:
    """First and last key of the ``days``-long window that ends on ``day_key``."""
    return shift_day(day_key, 1 - days), int(day_key)


def shift_month(month_id: int | str, months: int) -> int:
    index = int(month_id) // 100 * 12 + int(month_id) % 100 - 1 + months
    return index // 12 * 100 + index % 12 + 1


def previous_month(month_id: int | str) -> int:
    """Calendar month before ``month_id``, whatever the length of either month."""
    return shift_month(month_id, -1)


def trailing_months(month_id: int | str, n: int = 3) -> list[int]:
    """The ``n`` months ending with ``month_id``, oldest first."""
    return [shift_month(month_id, -back) for back in range(n - 1, -1, -1)]


def quarter_of(month: int | str) -> str:
    return f"Quarter {(int(month) - 1) // 3 + 1}"


# --- scopes in terms of the stored date, which files and row groups are sorted out by ---


def day_range(date: Column | str, first: int | str, last: int | str) -> Column:
    """The days ``first`` to ``last`` as a range of a stored date or timestamp.

    Says the same as a scope on ``time_key(date)``, but on the column itself, so that
    it reaches the scan: row groups are left out by their statistics.
    """
    return (_col(date) >= F.lit(parse_day(first))) & (_col(date) < F.lit(parse_day(last) + dt.timedelta(days=1)))


def month_range(date: Column | str, first: int | str, last: int | str | None = None) -> Column:
    """The months ``first`` to ``last`` (one month if there is no last) as a range of a stored date or timestamp."""
    after = shift_month(last if last is not None else first, 1)
    return (_col(date) >= F.lit(parse_day(int(first) * 100 + 1))) & (_col(date) < F.lit(parse_day(after * 100 + 1)))

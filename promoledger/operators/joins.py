"""Join and first-row helpers that hold up when one key owns a third of the rows.

No broadcast hint appears anywhere: Catalyst broadcasts a side when its size
statistics are below ``spark.sql.autoBroadcastJoinThreshold`` and AQE does so
when the measured shuffle output is. Above that the join shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger import session
from promoledger.operators.intervals import interval_join, reject_overlaps

_HASH = "__hash"


def spread_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Join whose left side may have hot keys and whose right side is grouped by the join keys.

    AQE splits skewed partitions only when both sides come straight from a
    shuffle; a right side that was just aggregated on the join keys does not,
    since its partitioning is reused. A hash of the keys as one more join key
    makes that partitioning insufficient, so both sides are freshly shuffled and
    AQE splits the hot ones into as many tasks as their size asks for. One bit of
    the hash does that, and a whole one would be a fifth of a narrow row. No row is
    repeated, and a small side still broadcasts as in any join. Valid for inner,
    left, left_semi and left_anti.
    """
    keys = [on] if isinstance(on, str) else list(on)
    kinds = {k: _compared_type(left.schema[k].dataType, right.schema[k].dataType, k) for k in keys}
    key_hash = F.xxhash64(*[F.col(f"`{k}`").cast(kinds[k]) for k in keys]).bitwiseAND(F.lit(1))
    return left.withColumn(_HASH, key_hash).join(right.withColumn(_HASH, key_hash), [*keys, _HASH], how).drop(_HASH)


SALT = "join_salt"


def salted_join(left: DataFrame, right: DataFrame, on: str, by: Sequence[str], salts: int = 16) -> DataFrame:
    """Left join after which a sum by ``on``, ``by`` and ``SALT`` needs no shuffle of its own, nor a hot key one task.

    Rows are dealt by the key and by a salt, a small hash of ``by``, which stays in
    the result; the right side, which should be the far smaller one, is repeated
    for every salt. A key that owns a third of the rows is so dealt to ``salts``
    tasks as far as its rows differ in ``by``. The repeats are missing from Spark's
    estimate of that side, and a broadcast would pass the driver, so there is none.
    """
    salt = F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int")
    repeated = right.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return left.withColumn(SALT, salt).join(repeated, [on, SALT], "left")


_WIDTH = {t: i for i, t in enumerate((T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType))}


def _compared_type(a: T.DataType, b: T.DataType, key: str) -> T.DataType:
    """The type in which Spark compares the two sides of a join key; the hash is taken in it.

    Equal types stay, of two plain numbers the wider counts (an integer beside a
    float is a double), text beside another type is read as that type, a date
    beside a timestamp is a timestamp. Other pairs are refused: a hash of unlike
    types would lose matches without a word.
    """
    if a == b:
        return a
    if type(a) in _WIDTH and type(b) in _WIDTH:
        wider = max(a, b, key=lambda t: _WIDTH[type(t)])
        return T.DoubleType() if isinstance(wider, T.FloatType) else wider
    if isinstance(a, T.StringType) or isinstance(b, T.StringType):
        other = b if isinstance(a, T.StringType) else a
        # Text beside an integer is read as a long, beside a fraction as a double.
        if type(other) in _WIDTH:
            return T.LongType() if _WIDTH[type(other)] <= _WIDTH[T.LongType] else T.DoubleType()
        if isinstance(other, (T.DateType, T.TimestampType, T.BooleanType)):
            return other
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    raise TypeError(f"join key {key} is {a.simpleString()} on the left and {b.simpleString()} on the right; cast one of them")


def in_calendar(fact: DataFrame, calendar: DataFrame, key: str = "time_key") -> DataFrame:
    """Rows of the fact on the days or months of a calendar selection.

    Where ``key`` is a partition column of a stored fact and the calendar is stored
    too, Spark evaluates the selection first and reads the folders it names alone.
    """
    return fact.join(calendar.select(key), key, "left_semi")


def null_safe_semi(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-semi join that lets null keys match each other."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys])
    condition = None
    for k in keys:
        equal = left[k].eqNullSafe(F.col(f"__r_{k}"))
        condition = equal if condition is None else condition & equal
    return left.join(r, condition, "left_semi")


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per group: the first by ``order``, ties broken by all other columns.

    A ``min`` over a struct instead of ``row_number() = 1``: it combines on the
    map side, so no task ever holds or sorts a whole group.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("__first")
    return df.groupBy(*keys).agg(first).select(*keys, "__first.*").select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key: the last by ``order``, ties broken by all other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    last = F.max(F.struct(*order, *rest)).alias("__last")
    return df.groupBy(*keys).agg(last).select(*keys, "__last.*").select(*df.columns)


def newest_rows_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """All rows that carry the highest ``order`` of their key (rank = 1 descending)."""
    newest = df.groupBy(*keys).agg(F.max(order).alias(order))
    return null_safe_semi(df, newest, [*keys, order])


def dense_code(df: DataFrame, column: str, code: str) -> DataFrame:
    """Number the distinct values of ``column`` 1, 2, 3 … in sort order, without one global sort.

    Values are dealt by range, numbered inside their range, and each range starts
    after the sizes of those before it. The dealt values are written first, since
    both steps have to see the same ranges; only their sizes, one a partition, are
    ordered as a whole.
    """
    dealt = df.select(column).distinct().repartitionByRange(F.col(column)).withColumn("__p", F.spark_partition_id())
    values, _ = session.stage(dealt, "ranges")
    inside = values.withColumn("__n", F.row_number().over(Window.partitionBy("__p").orderBy(column)))
    sizes = values.groupBy("__p").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__p", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    return inside.join(starts, "__p").select(column, (F.col("__start") + F.col("__n")).cast("int").alias(code))


def band(df: DataFrame, value: str, bands: DataFrame, code: str = "ref_code", out: str = "band_code", unique: bool = False) -> DataFrame:
    """Left range lookup: the codes of all bands with ``param1 <= value <= param2``, null when none fits.

    Only the distinct values meet the bands, by an equality join on buckets; the
    rows then look their value up. A value in several bands yields one row each;
    with ``unique`` bands that overlap are refused, so each row stays one row.
    """
    if unique:
        reject_overlaps(bands)
    limits = bands.select(F.col("param1").alias("__low"), F.col("param2").alias("__high"), F.col(code).alias(out))
    distinct = df.select(value).where(F.col(value).isNotNull()).distinct()
    hits = interval_join(distinct, value, limits, "__low", "__high").select(value, out)
    return spread_join(df, hits, value).select(*df.columns, out)

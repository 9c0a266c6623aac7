"""Upsert, batch delete and return restatement as pure DataFrame operators.

They compute the new content of the touched slice; ``sinks.tables`` puts it in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger import session
from promoledger.functions import keys, rules
from promoledger.operators.joins import latest_per_key, spread_join
from promoledger.sources.readers import constant_relation

SALES_KEYS = ("product_code", "invoice_number")
# Columns a match never changes: the partition a row lives in, its date, its first load time and what backfill brought it.
KEPT_ON_UPDATE = ("invoice_date", "year_id", "month_id", "time_key", "insert_ts", "batch_id")


#: A key that owns this share of all rows is merged apart.
HOT_SHARE = 0.01
#: Share of the rows that are looked at to find such keys, and how often a key has to be among them.
_SAMPLE, _LEAST_SEEN = 0.01, 1000


def hot_keys(target: DataFrame, source: DataFrame, on: Sequence[str] = SALES_KEYS, share: float = HOT_SHARE, sample: float = _SAMPLE, least: int = _LEAST_SEEN) -> list[tuple]:
    """Keys that own about ``share`` of the rows of both tables, at most ``1 / share`` of them.

    Reads the key columns of a sample. What it finds decides how a key is merged,
    never with what result.
    """
    seen = target.select(*on).unionByName(source.select(*on)).sample(sample, seed=1).dropna()
    counts = seen.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    often = counts.filter(F.col("__n") >= least).orderBy(F.desc("__n")).limit(int(1 / share)).collect()
    total = seen.count() if often else 0
    return [tuple(row[c] for c in on) for row in often if row["__n"] >= share * total]


def upsert(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str] = SALES_KEYS,
    keep: Sequence[str] = KEPT_ON_UPDATE,
    order: Sequence[str] = (),
    hot: Sequence[tuple] = (),
) -> DataFrame:
    """Target rows with matching source rows applied, plus the source rows that match nothing.

    A matched target row takes every source column except the keys and ``keep``.
    Neither side needs unique keys: every unmatched source row is inserted, and a
    key with several source rows updates its matches from the last of them (by
    ``order``, then by all columns). Null keys match nothing.

    Both tables are one tagged union that is partitioned by key once: the last
    source row (a struct's maximum) and whether there is any target row come from
    one window over whole keys, so each side is scanned and shuffled once. Rows
    of null keys are dealt by their content. ``hot`` keys (see ``hot_keys``) stay out
    of that shuffle: each side of them meets a table of one row a key instead.
    """
    if not hot:
        return _merged(target, source, on, keep, order)
    names = list(on)
    listed = constant_relation(target.sparkSession, list(hot), T.StructType([target.schema[c] for c in names]))
    cold = _merged(*[df.join(listed, names, "left_anti") for df in (target, source)], on, keep, order)
    owners, incoming = (df.join(listed, names, "left_semi") for df in (target, source))
    updated = _updated(target, on, keep)
    last = latest_per_key(incoming.select(*dict.fromkeys([*on, *order, *updated])), names, list(order))
    found = last.select(*on, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in updated])
    # One row a listed key on either side, so at most 1 / HOT_SHARE rows.
    changed = owners.join(F.broadcast(found), names, "left").select(
        *[F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c) for c in target.columns]
    )
    inserted = incoming.join(F.broadcast(owners.select(*on).distinct()), names, "left_anti").select(*target.columns)
    return cold.unionByName(changed).unionByName(inserted)


def _updated(target: DataFrame, on: Sequence[str], keep: Sequence[str]) -> list[str]:
    return [c for c in target.columns if c not in on and c not in keep]


def _merged(target: DataFrame, source: DataFrame, on: Sequence[str], keep: Sequence[str], order: Sequence[str]) -> DataFrame:
    columns, updated = target.columns, _updated(target, on, keep)
    more = [c for c in order if c not in columns]
    kinds = {f.name: f.dataType for f in target.schema.fields}
    ours = target.select(*columns, *[F.lit(None).cast(source.schema[c].dataType).alias(c) for c in more], F.lit(False).alias("__new"))
    theirs = source.select(*[F.col(c).cast(kinds[c]).alias(c) for c in columns], *more, F.lit(True).alias("__new"))
    lacking = F.lit(False)
    for c in on:
        lacking = lacking | F.col(c).isNull()
    tagged = ours.unionByName(theirs).withColumn("__spread", F.when(lacking, F.xxhash64(*columns)).otherwise(F.lit(0)))
    whole = Window.partitionBy(*on, "__spread")
    usable = F.col("__spread") == 0
    # Under a hash that happens to be 0 a null key would still be null.
    for c in on:
        usable = usable & F.col(c).isNotNull()
    rest = [c for c in updated if c not in order]
    seen = tagged.withColumns(
        {
            "__last": F.max(F.when(F.col("__new") & usable, F.struct(*order, *rest))).over(whole),
            "__owned": F.max(~F.col("__new") & usable).over(whole),
        }
    )
    hit = ~F.col("__new") & F.col("__last").isNotNull()
    values = [F.when(hit, F.col(f"__last.{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c) for c in columns]
    return seen.filter(~F.col("__new") | ~F.col("__owned")).select(*values)


def delete_latest_batch(fact: DataFrame, first: int, last: int, ts: str = "insert_ts", date: str | None = None) -> DataFrame:
    """All rows but those of the newest load inside the day window.

    With the stored ``date`` that the day keys come from, the search for that load
    reads the window's files alone.
    """
    inside = F.col("time_key").between(first, last)
    window = inside if date is None else inside & keys.day_range(date, first, last)
    newest = fact.filter(window).agg(F.max(ts)).scalar()
    doomed = inside & (F.col(ts) == newest)
    return fact.filter(~F.coalesce(doomed, F.lit(False)))


def returned_lines(fact: DataFrame, returned: Column) -> DataFrame:
    """``invoice_number, __original, product_code`` of the returns of a period."""
    return (
        fact.filter(returned & (F.col("sales_ret_ref_invoice_number") != rules.NO_RETURN_REFERENCE))
        .select("invoice_number", F.col("sales_ret_ref_invoice_number").alias("__original"), "product_code")
        .distinct()
    )


def restatement_source(fact: DataFrame, returns: DataFrame, months: Sequence[int]) -> DataFrame:
    """New date keys per (invoice, product) of ``returns``: those of the original invoice's line.

    Originals are looked up in ``months``. Returns are few: their keys reduce the
    months' lines before anything is grouped, by broadcast or Spark's Bloom filter.
    When a line has several originals the earliest wins, so the result is unique
    per (invoice, product).
    """
    dates = ["invoice_date", "time_key", "month_id", "year_id"]
    wanted = returns.select("__original", "product_code").distinct()
    originals = (
        fact.filter(F.col("month_id").isin([int(m) for m in months]) & F.col("invoice_date").isNotNull())
        .select(F.col("invoice_number").alias("__original"), "product_code", F.struct(*dates).alias("__dates"))
        .join(wanted, ["__original", "product_code"], "left_semi")
        .groupBy("__original", "product_code")
        .agg(F.min("__dates").alias("__dates"))
    )
    return (
        spread_join(returns, originals, ["__original", "product_code"], "inner")
        .groupBy("invoice_number", "product_code")
        .agg(F.min("__dates").alias("__dates"))
    )


def restate_returns(
    fact: DataFrame, day: int | None = None, month: int | None = None, batch_ts: Column | None = None
) -> DataFrame:
    """The current and previous month of the fact with returned lines dated like their originals.

    Give the load ``day`` (daily run) or a whole ``month`` (backfill). Every line
    of a matched (invoice, product) moves; all other lines stay as they are.
    """
    if day is None and month is None:
        raise ValueError("give a day or a month")
    current = int(month) if month is not None else int(day) // 100
    months = [keys.previous_month(current), current]
    returned = F.col("month_id") == current
    if day is not None:
        returned = returned & (F.col("time_key") == int(day))
    scoped = fact.filter(F.col("month_id").isin(months))
    # Written first: their size is known then, and the fact is read for its originals and for the result alone.
    returns, _ = session.stage(returned_lines(scoped, returned), "returns")
    return apply_restatement(scoped, restatement_source(scoped, returns, months), batch_ts)


def apply_restatement(scoped: DataFrame, source: DataFrame, batch_ts: Column | None = None) -> DataFrame:
    dates = ["invoice_date", "time_key", "month_id", "year_id"]
    moved = F.col("__dates").isNotNull()
    changes = {c: F.when(moved, F.col(f"__dates.{c}")).otherwise(F.col(c)) for c in dates}
    if "update_ts" in scoped.columns:
        ts = batch_ts if batch_ts is not None else F.current_timestamp()
        changes["update_ts"] = F.when(moved, ts).otherwise(F.col("update_ts"))
    joined = spread_join(scoped, source, ["invoice_number", "product_code"])
    return joined.withColumns(changes).select(*scoped.columns)

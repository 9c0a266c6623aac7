"""Packing by optimal length buckets and token-budget batches, in DataFrame functions.

Documents are cut into pieces of at most ``max_tokens`` words. From the histogram
of piece lengths a dynamic program picks at most ``buckets`` upper bounds so that
padding every piece to the bound of its bucket wastes the fewest tokens. Inside a
bucket the pieces stand in an order that a hash of their id fixes, and every
``budget // bound`` of them make a batch; only a bucket's last batch may be short.

Cases: documents without a word (null, empty, blank) get one row of length 0 with
null bucket, batch and slot; equal costs go to the lower bound; repeated rows are
packed each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promoledger.llm.common import table
from promoledger.session import stage

MAX_TOKENS = 2048
BUCKETS = 8
BUDGET = 16_384
#: Pieces ordered by one window task, about.
SLICE = 65_536
# The pattern of a word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def optimal_bounds(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Upper bounds that minimise the total of (bound - length) over all lengths; ties to the lower bound.

    The table has ``buckets`` rows of one entry per distinct length; the caller
    caps lengths, so its size does not depend on the number of documents.
    """
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[x] for x in lengths.tolist()], np.int64)
    number = np.concatenate([[0], np.cumsum(counts)])
    total = np.concatenate([[0], np.cumsum(counts * lengths)])
    size = len(lengths)
    # cost[j]: least waste of the first j lengths; the row before has one bucket fewer.
    big = np.iinfo(np.int64).max // 4
    cost = np.full(size + 1, big, np.int64)
    cost[0] = 0
    came_from = []
    best_row = []
    for _ in range(min(buckets, size)):
        fresh = np.full(size + 1, big, np.int64)
        source = np.zeros(size + 1, np.int64)
        for j in range(1, size + 1):
            waste = cost[:j] + lengths[j - 1] * (number[j] - number[:j]) - (total[j] - total[:j])
            source[j] = int(waste.argmin())
            fresh[j] = waste[source[j]]
        cost = fresh
        came_from.append(source)
        best_row.append(int(cost[size]))
    row = int(np.argmin(best_row))
    bounds, j = [], size
    while row >= 0:
        bounds.append(int(lengths[j - 1]))
        j, row = int(came_from[row][j]), row - 1
    return bounds[::-1]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``doc_id, piece, start, length`` of every piece, lengths in words; one empty piece where there is no word."""
    counted = docs.select(F.col(id_col).alias("doc_id"), word_count(F.col(text_col)).alias("words"))
    last = F.greatest(F.lit(0), F.ceil(F.col("words") / max_tokens).cast("long") - 1)
    cut = counted.select("doc_id", "words", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * max_tokens
    return cut.select("doc_id", "piece", start.alias("start"), F.least(F.lit(max_tokens), F.col("words") - start).alias("length"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """``doc_id, piece, start, length, bucket, batch, slot`` of every piece.

    The only data at the driver is the histogram, at most ``max_tokens`` rows.
    Places in a bucket come from short windows: pieces are dealt by leading digits
    of their hash, as many as keep a window near ``SLICE`` pieces, and each window
    starts after the sizes of those before it.
    """
    found, _ = stage(pieces(docs, id_col, text_col, max_tokens), "pieces")
    filled = found.where(F.col("length") > 0)
    histogram = {int(r["length"]): int(r["n"]) for r in filled.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    bounds = optimal_bounds(histogram, buckets)
    total = sum(histogram.values())
    digits = max(2, math.ceil(math.log(max(1, total / SLICE), 16)))
    bucket = F.lit(None).cast("int")
    for bound in reversed(bounds):
        bucket = F.when(F.col("length") <= bound, F.lit(bound)).otherwise(bucket)
    order = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("piece").cast("string")).cast("binary"))
    keyed = filled.withColumn("bucket", bucket).withColumn("order", order).withColumn("slice", F.substring("order", 1, digits))
    sizes = keyed.groupBy("bucket", "slice").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", "slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket", "slice").orderBy("order", "doc_id", "piece", "length")
    placed = keyed.withColumn("n", F.row_number().over(inside)).join(starts, ["bucket", "slice"])
    place = F.col("before") + F.col("n") - 1
    rows = F.floor(F.lit(budget) / F.col("bucket")).cast("long")
    in_batch = F.greatest(F.lit(1), rows)
    columns = ["doc_id", "piece", "start", "length", "bucket"]
    batches = placed.select(*columns, F.floor(place / in_batch).cast("long").alias("batch"), (place % in_batch).cast("long").alias("slot"))
    nothing = F.lit(None)
    empty = found.where(F.col("length") <= 0).select(
        *columns[:-1], nothing.cast("int").alias("bucket"), nothing.cast("long").alias("batch"), nothing.cast("long").alias("slot")
    )
    return batches.unionByName(empty)


def query(spark, sf_dir: str) -> DataFrame:
    """op8: where every piece of every document is packed."""
    return pack(table(spark, sf_dir, "documents"))


def packing_sql(documents: str = "documents") -> str:
    """The same result by a recursive query: state (buckets used, last length) with least cost and its bounds."""
    return rf"""
with recursive counted as (
  select doc_id, coalesce(len(regexp_extract_all(text, '{WORD}')), 0) as words from {documents}),
cut as (
  select doc_id, words, unnest(range(0, greatest(1, ceil(words / {MAX_TOKENS})::bigint))) as piece from counted),
parts as (
  select doc_id, piece, piece * {MAX_TOKENS} as start, least({MAX_TOKENS}, words - piece * {MAX_TOKENS}) as length from cut),
lengths as (
  select length, row_number() over (order by length) as j, sum(count(*)) over (order by length) as number,
         sum(count(*) * length) over (order by length) as total
  from parts where length > 0 group by length),
edge as (select j, length, number, total from lengths union all select 0, 0, 0, 0),
program(k, j, cost, bounds) as (
  select 0, 0::bigint, 0::hugeint, []::bigint[]
  union all
  select k, j, min(cost), arg_min(bounds, (cost, i))
  from (
    select p.k + 1 as k, e.j as j, p.j as i, p.cost + e.length * (e.number - b.number) - (e.total - b.total) as cost, list_append(p.bounds, e.length) as bounds
    from program p join edge b on b.j = p.j join edge e on e.j > p.j
    where p.k < {BUCKETS}) steps
  group by k, j),
best as (
  select arg_min(bounds, (cost, k)) as bounds from program where j = (select max(j) from edge) and k > 0),
bucketed as (
  select doc_id, piece, start, length, (select list_min(list_filter(bounds, lambda b: b >= length)) from best) as bucket,
         md5(coalesce(doc_id::varchar, '') || ':' || piece::varchar) as place
  from parts where length > 0),
placed as (
  select *, row_number() over (partition by bucket order by place, doc_id, piece, length) - 1 as n,
         greatest(1, {BUDGET} // bucket) as rows_
  from bucketed)
select doc_id, piece, start, length, bucket::integer as bucket, n // rows_ as batch, n % rows_ as slot from placed
union all
select doc_id, piece, start, length, null, null, null from parts where length <= 0
"""


SQL = packing_sql()

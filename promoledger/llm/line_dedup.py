"""Site-relative line dedup, in DataFrame functions only.

A line that stands on more than a given share of a host's pages is boilerplate
of that host and goes from all its pages. A page counts once for a line however
often it repeats it; lines are compared without leading and trailing spaces, by
96 bits of hash.

Cases: blank lines are never boilerplate and stay; a null text stays null and its
page still counts in the host's total; a page of boilerplate alone becomes empty;
rows of null host are one host of their own; repeated rows are pages of their
own, unless copies are to count once, so that a group of copies does not make its
own lines boilerplate; a line on fewer than ``min_pages`` pages of a host stays, so small hosts
keep their text; an input column called like an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoledger.llm.common import spread_lookup, table, with_outputs
from promoledger.session import stage

MAX_RATIO = 0.1
MIN_PAGES = 3


def _line_key(line: Column) -> Column:
    bare = F.trim(line)
    return F.struct(F.xxhash64(bare).alias("a"), F.hash(bare).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _host_key(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("h"), host.cast("string")), F.lit("n"))


def boilerplate(docs: DataFrame, text_col: str, host_col: str, max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """``__host, __boilerplate``: the keys of each host's boilerplate lines.

    Counts are combined before the shuffle, rare lines go before host totals are
    looked up, and a host's list is short by nature: every line on it takes more
    than ``max_ratio`` of the host's pages, so it has at most the mean number of
    lines of a page divided by ``max_ratio``.
    """
    visible = F.filter(_lines(F.col(text_col)), lambda line: F.trim(line) != "")
    keys = F.array_distinct(F.transform(visible, _line_key))
    pages = docs.select(_host_key(F.col(host_col)).alias("__host"), keys.alias("keys"), F.xxhash64(text_col).alias("p"), F.xxhash64(F.lit(1), text_col).alias("q"))
    if copies_once:
        pages = pages.groupBy("__host", "p", "q").agg(F.first("keys").alias("keys"))
    counts = pages.select("__host", F.explode("keys").alias("key")).groupBy("__host", "key").agg(F.count(F.lit(1)).alias("n"))
    totals = pages.groupBy("__host").agg(F.count(F.lit(1)).alias("total"))
    frequent = spread_lookup(counts.where(F.col("n") >= min_pages), totals, ["__host"], "inner")
    return frequent.where(F.col("n") / F.col("total") > max_ratio).groupBy("__host").agg(F.collect_set("key").alias("__boilerplate"))


def drop_boilerplate(docs: DataFrame, text_col: str = "text", host_col: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, dropped_col: str = "n_dropped", copies_once: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and how many; pages of equal text may count as one.

    The hosts' lists are written first; their measured size lets Spark broadcast
    them where they are small, so that texts need no shuffle, and shuffle by host
    and salt where they are not.
    """
    lists, _ = stage(boilerplate(docs.select(text_col, host_col), text_col, host_col, max_ratio, min_pages, copies_once), "boilerplate")
    keyed = docs.withColumn("__host", _host_key(F.col(host_col)))
    found = spread_lookup(keyed, lists, ["__host"])
    lines = _lines(F.col(text_col))
    kept = F.filter(lines, lambda line: ~F.array_contains("__boilerplate", _line_key(line)))
    changed = F.col("__boilerplate").isNotNull() & F.col(text_col).isNotNull()
    found = found.withColumn("__kept", F.when(changed, kept))
    text = F.when(F.col("__kept").isNull(), F.col(text_col)).otherwise(F.array_join("__kept", "\n"))
    count = F.when(F.col("__kept").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size("__kept"))
    result = {c: text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns}
    keep = [result[c.strip("`")] for c in with_outputs(docs, [dropped_col])]
    return found.select(*keep, count.alias(dropped_col))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every document without its source's boilerplate lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return drop_boilerplate(docs).select("doc_id", "source", "text", "n_dropped")


SQL = f"""
with pages as (select *, row_number() over () as row_id from documents),
lines as (select row_id, source, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as place from pages),
totals as (select source, count(*) as total from documents group by source),
counts as (select source, trim(line) as bare, count(distinct row_id) as n from lines where trim(line) <> '' group by source, trim(line)),
boilerplate as (
  select c.source, c.bare from counts c join totals t on c.source is not distinct from t.source
  where c.n >= {MIN_PAGES} and c.n / t.total > {MAX_RATIO}),
marked as (
  select l.row_id, l.line, l.place, b.bare is not null as gone
  from lines l left join boilerplate b on l.source is not distinct from b.source and trim(l.line) = b.bare),
texts as (
  select row_id, coalesce(string_agg(line, chr(10) order by place) filter (not gone), '') as text,
         count(*) filter (gone) as n_dropped
  from marked group by row_id)
select p.doc_id, p.source, case when p.text is null then null else t.text end as text, coalesce(t.n_dropped, 0)::integer as n_dropped
from pages p left join texts t using (row_id)
"""

"""The prefix trie of conversations, with totals of every node's subtree by centroid decomposition.

A node is a distinct sequence of first turns. It is named by its depth and its
least member, since a conversation runs through one node at each depth. Which
rows stand in one node is told by two 64-bit hashes of the prefix: the exclusive
or of the hashes of its turns, each with its place, so a long conversation is
hashed in pieces on many tasks.

Subtree totals do not climb the trie level by level, which a chain of turns would
make as long as itself. The trie is cut at centroids: the centroid of a component
is the deepest node with over half the component's size below it, the nodes with
over half are just those on the way from it to the top, and what hangs below it
is over after that. So per round each component adds up what is below its
centroid, adds that to the nodes on that way, and falls apart into the rest above
and one component for each child of the centroid, of half the size at most.
Components of up to ``LOCAL`` are finished likewise, each in one task's memory. A
node's size is how many turns of its members stand at it or below, which is known
beforehand without any climbing.

Cases: rows of null id belong to no conversation; a null turn comes first, then
equal turns by role and text; a null role or text is empty; repeated rows are
turns of their own; a conversation that is rebuilt to no turn is a member of the
root alone; an empty table has no node; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoledger.llm.common import Scratch, sorted_groups, table

#: Conversations that share one beginning in the query, and the most turns they share plus one.
FAMILY, SHARED = 5, 9
#: Size of a component that one task finishes in memory.
LOCAL = 4096
#: Rows of turns in a range, about; a conversation may take many ranges.
RANGE = 100_000
#: Least number of ranges.
RANGES = 64
#: Conversation ids that are joined to one text at a time, as a power of two.
_ID_BITS = 12


def ordered_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, place, piece, role, text``: each row's place (from 1) in its conversation.

    Rows are dealt by ranges of conversation and turn, so that even one
    conversation of a third of all rows is ordered by many tasks; places go on
    where the ranges before end. ``piece`` numbers the ranges, and equal rows are
    dealt by their number in the input.
    """
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    key = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    ranges = max(RANGES, rows.count() // RANGE)
    dealt = rows.withColumn("number", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(ranges, *key, "number")
    ranged = scratch.stage(dealt.withColumn("piece", F.spark_partition_id()), "turns")
    sizes = ranged.groupBy("conv_id", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv_id", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv_id", "piece").orderBy(key[1], "role", "text", "number")
    placed = ranged.withColumn("in_piece", F.row_number().over(inside)).join(starts, ["conv_id", "piece"])
    return placed.select("conv_id", (F.col("in_piece") + F.col("before")).alias("place"), "piece", "role", "text")


def rebuild(turns: DataFrame, scratch: Scratch, family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """``conv_id, depth, piece, role, text`` of every rebuilt conversation; one row of depth 0 for each, which is its root.

    Conversation c takes the first h turns of c - c % family, all if it has fewer
    and none if there is no such conversation, and goes on with its own turns
    after its first h; h is the CRC-32 of its decimal id modulo ``shared``.
    """
    own = scratch.stage(ordered_turns(turns, scratch), "placed")
    every = own.groupBy("conv_id").agg(F.lit(0).alias("depth"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    wanted = every.select("conv_id", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), h.alias("h"))
    heads = own.where((F.col("place") < shared) & (F.col("conv_id") % family == 0)).select(F.col("conv_id").alias("base"), "place", "role", "text")
    taken = wanted.join(heads, "base").where(F.col("place") <= F.col("h"))
    begun = taken.select("conv_id", F.col("place").alias("depth"), F.lit(-1).alias("piece"), "role", "text")
    lengths = begun.groupBy("conv_id").agg(F.max("depth").alias("have"))
    cut = wanted.join(lengths, "conv_id", "left").select("conv_id", "h", F.coalesce("have", F.lit(0)).alias("have"))
    rest = own.join(scratch.stage(cut, "shared-turns"), "conv_id").where(F.col("place") > F.col("h"))
    gone_on = rest.select("conv_id", (F.col("place") - F.col("h") + F.col("have")).alias("depth"), "piece", "role", "text")
    nothing = F.lit("")
    roots = every.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(-2).alias("piece"), nothing.alias("role"), nothing.alias("text"))
    return roots.unionByName(begun.withColumn("depth", F.col("depth").cast("long"))).unionByName(gone_on)


def prefixes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, depth, a, b, up_a, up_b, bytes, below``: names of each row's prefix and of the one before, and how many rows of the conversation stand at it or after.

    ``turns`` has ``conv_id, depth, piece, role, text``; pieces of a conversation follow one another.
    """
    hashes = turns.select(
        "conv_id",
        "depth",
        "piece",
        F.octet_length("text").cast("long").alias("bytes"),
        F.when(F.col("depth") > 0, F.xxhash64(F.lit(1), "depth", "role", "text")).otherwise(F.lit(0)).alias("x"),
        F.when(F.col("depth") > 0, F.xxhash64(F.lit(2), "text", "role", "depth")).otherwise(F.lit(0)).alias("y"),
    )
    rows = scratch.stage(hashes, "hashes")
    pieces = rows.groupBy("conv_id", "piece").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.max("depth").alias("last"))
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    starts = pieces.select(
        "conv_id",
        "piece",
        F.coalesce(F.bit_xor("x").over(earlier), zero).alias("from_x"),
        F.coalesce(F.bit_xor("y").over(earlier), zero).alias("from_y"),
        F.max("last").over(Window.partitionBy("conv_id")).alias("last"),
    )
    inside = Window.partitionBy("conv_id", "piece").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.withColumn("px", F.bit_xor("x").over(inside)).withColumn("py", F.bit_xor("y").over(inside)).join(starts, ["conv_id", "piece"])
    named = running.withColumn("a", F.col("px").bitwiseXOR(F.col("from_x"))).withColumn("b", F.col("py").bitwiseXOR(F.col("from_y")))
    return named.select(
        "conv_id",
        "depth",
        "a",
        "b",
        F.col("a").bitwiseXOR(F.col("x")).alias("up_a"),
        F.col("b").bitwiseXOR(F.col("y")).alias("up_b"),
        "bytes",
        (F.col("last") - F.col("depth") + 1).alias("below"),
    )


def build(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The trie of ``conv_id, depth, piece, role, text``: its nodes and its rows, both written.

    Nodes: ``rep, depth, up`` (least members of the node and of its parent),
    ``n_convs, bytes, size``. Rows: ``conv_id, depth, rep, up, last`` (whether the
    conversation ends there). Both sides of a lookup are written tables, so that
    Spark may split a node that many rows or nodes hang on.
    """
    rows = scratch.stage(prefixes(turns, scratch), "prefixes")
    name = ["depth", "a", "b"]
    members = rows.groupBy(*name).agg(
        F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"), F.sum("below").alias("size"), F.max("up_a").alias("up_a"), F.max("up_b").alias("up_b")
    )
    found = scratch.stage(members, "members")
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("rep").alias("up"))
    linked = found.join(above, ["depth", "up_a", "up_b"], "left")
    named = scratch.stage(linked.select("rep", "depth", "up", "n_convs", "bytes", "size", "a", "b"), "nodes")
    placed = rows.select("conv_id", *name, "below").join(named.select(*name, "rep", "up"), name)
    kept = scratch.stage(placed.select("conv_id", "depth", "rep", "up", (F.col("below") == 1).alias("last")), "members-of-nodes")
    return named.drop("a", "b"), kept


def split(parents: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree totals of one component by centroid decomposition, in memory.

    Nodes are numbered by depth, the top first; ``parents`` holds their parents'
    numbers, -1 for the top. ``sizes`` are those of the component: a node's is more
    than that of each child by what the node itself counts, at least one.
    """
    sizes, totals = sizes.copy(), np.zeros_like(values)
    above = parents.tolist()
    waiting = [list(range(len(parents)))]
    while waiting:
        nodes = waiting.pop()
        half = sizes[nodes[0]]
        way = [v for v in nodes if 2 * sizes[v] > half]
        centre = way[-1]
        upper, lower, part = [], {}, {}
        for v in nodes:
            p = above[v]
            if p == centre or p in part:
                part[v] = v if p == centre else part[p]
                lower.setdefault(part[v], []).append(v)
            elif v != centre:
                upper.append(v)
        total = values[[centre, *part]].sum(axis=0)
        totals[way] += total
        sizes[way[:-1]] -= sizes[centre]
        waiting.extend(lower.values())
        if upper:
            waiting.append(upper)
    return totals


_TOTALS = "rep long, depth long, n_leaves long, saved_tokens long"


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of small components, whose rows stand together, by depth."""
    for part in sorted_groups(batches, ["top_depth", "top_rep"]):
        rep, depth, up, size, leaves, saved = (part[c].fill_null(0).to_numpy() for c in ("rep", "depth", "up", "size", "leaves", "saved"))
        number = {(d, r): i for i, (d, r) in enumerate(zip(depth.tolist(), rep.tolist(), strict=True))}
        parents = np.array([-1 if i == 0 else number[d - 1, int(u)] for i, (d, u) in enumerate(zip(depth.tolist(), up.tolist(), strict=True))])
        totals = split(parents, size, np.stack([leaves, saved], axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(depth), pa.array(totals[:, 0]), pa.array(totals[:, 1])], ["rep", "depth", "n_leaves", "saved_tokens"])


def subtree_totals(nodes: DataFrame, rows: DataFrame, local: int = LOCAL) -> DataFrame:
    """``rep, depth, n_leaves, saved_tokens`` of every node: ``leaves`` and ``saved`` added up over its subtree.

    ``nodes`` has ``rep, depth, up, size, leaves, saved``, ``rows`` what ``build``
    gives. Rounds grow with the logarithm of the number of turns. A round adds up
    by component before it shuffles, and looks each node's ancestor just below the
    centroid up by its least member; per-component tables are written first, so
    that Spark may broadcast them if small and split a large component if not.
    """
    scratch = Scratch(nodes.sparkSession)
    top = ["top_rep", "top_depth"]
    columns = ["rep", "depth", "up", "size", "leaves", "saved"]
    root = nodes.agg(F.min("rep")).first()[0]
    left = nodes.select(*columns, F.lit(root).cast("long").alias("top_rep"), F.lit(0).cast("long").alias("top_depth"))
    steps = rows.select(F.col("conv_id").alias("rep"), F.col("depth").alias("look"), F.col("rep").alias("child"), F.col("up").alias("child_up"))
    done: list[DataFrame] = []
    round_ = Scratch(nodes.sparkSession)
    while True:
        before, round_ = round_, Scratch(nodes.sparkSession)
        wholes = round_.stage(left.groupBy(*top).agg(F.max("size").alias("whole")), "wholes")
        sized = round_.stage(left.join(wholes, top), "sized")
        before.clear()
        small = sized.where(F.col("whole") <= local).select(*columns, *top)
        by_top = small.repartition(*top).sortWithinPartitions(*top[::-1], "depth", "rep")
        done.append(scratch.stage(by_top.mapInArrow(_finish, _TOTALS), "finished"))
        large = sized.where(F.col("whole") > local)
        if not large.limit(1).count():
            round_.clear()
            break
        heavy = large.where(2 * F.col("size") > F.col("whole"))
        best = heavy.groupBy(*top).agg(F.max(F.struct("depth", "rep", "size")).alias("centre"))
        centres = round_.stage(best.select(*top, F.col("centre.depth").alias("c_depth"), F.col("centre.rep").alias("c_rep"), F.col("centre.size").alias("c_size")), "centres")
        marked = large.join(centres, top)
        is_centre = (F.col("depth") == F.col("c_depth")) & (F.col("rep") == F.col("c_rep"))
        looked = marked.where(F.col("depth") > F.col("c_depth")).withColumn("look", F.col("c_depth") + 1).join(steps, ["rep", "look"])
        below = F.col("child_up") == F.col("c_rep")
        same = [*columns, *top, "c_size", is_centre.alias("is_centre")]
        moved = looked.select(
            *same, below.alias("below"), F.lit(False).alias("way"), F.when(below, F.col("child")).otherwise(F.col("top_rep")).alias("new_rep"), F.when(below, F.col("look")).otherwise(F.col("top_depth")).alias("new_depth")
        )
        way = 2 * F.col("size") > F.col("whole")
        stayed = marked.where(F.col("depth") <= F.col("c_depth")).select(
            *same, is_centre.alias("below"), way.alias("way"), F.col("top_rep").alias("new_rep"), F.col("top_depth").alias("new_depth")
        )
        cut = round_.stage(moved.unionByName(stayed), "cut")
        hanging = round_.stage(cut.where("below").groupBy(*top).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")), "hanging")
        done.append(scratch.stage(cut.where("way").select("rep", "depth", *top).join(hanging, top).select("rep", "depth", "n_leaves", "saved_tokens"), "added"))
        size = F.when(F.col("way"), F.col("size") - F.col("c_size")).otherwise(F.col("size")).alias("size")
        left = cut.where(~F.col("is_centre")).select("rep", "depth", "up", size, "leaves", "saved", F.col("new_rep").alias("top_rep"), F.col("new_depth").alias("top_depth"))
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    return scratch.result(every.groupBy("rep", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")), "totals")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of each node, in order; keeps the state of one node."""
    key, state, out = None, None, []
    for batch in batches:
        for depth, rep, text in zip(*(batch.column(c).to_pylist() for c in ("depth", "rep", "ids")), strict=True):
            if (depth, rep) != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (depth, rep), hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist([dict(zip(("depth", "rep", "ends_sha256"), r, strict=True)) for r in out])
            out = []
    if key is not None:
        out.append((*key, state.hexdigest()))
        yield pa.RecordBatch.from_pylist([dict(zip(("depth", "rep", "ends_sha256"), r, strict=True)) for r in out])


def end_digests(rows: DataFrame) -> DataFrame:
    """``depth, rep, ends_sha256`` of the nodes at which conversations end: SHA-256 of their ids, ascending, with commas.

    Ids of a node are joined to texts of bounded length where they are close;
    SHA-256 takes its input in order, so a node's texts pass one task, one by one.
    """
    ends = rows.where("last").select("depth", "rep", "conv_id", F.shiftright("conv_id", _ID_BITS).alias("chunk"))
    texts = ends.groupBy("depth", "rep", "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = texts.repartition("depth", "rep").sortWithinPartitions("depth", "rep", "chunk")
    return ordered.mapInArrow(_digests, "depth long, rep long, ends_sha256 string")


def rollup(turns: DataFrame, scratch: Scratch, local: int = LOCAL) -> DataFrame:
    """All nodes of the trie of ``conv_id, depth, piece, role, text`` with members, children, subtree totals and the digest of the conversations that end there.

    The turn that a node adds is the row of ``turns`` of its ``rep`` and ``depth``.
    """
    nodes, rows = build(turns, scratch)
    children = nodes.where(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("up").alias("rep")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(scratch.stage(children, "children"), ["depth", "rep"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    saved = (F.col("n_convs") - 1) * F.col("bytes")
    full = scratch.stage(counted.withColumn("leaves", (F.col("n_children") == 0).cast("long")).withColumn("saved", saved), "counted")
    totals = subtree_totals(full.select("rep", "depth", "up", "size", "leaves", "saved"), rows, local)
    joined = full.drop("leaves", "saved", "size", "bytes").join(totals, ["depth", "rep"]).join(end_digests(rows), ["depth", "rep"], "left")
    return joined.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))


def query(spark, sf_dir: str) -> DataFrame:
    """op13: every node of the trie of the rebuilt conversations."""
    scratch = Scratch(spark)
    found = rollup(rebuild(table(spark, sf_dir, "conversations"), scratch), scratch)
    names = [F.col("rep").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return scratch.result(found.select(*names), "trie")


_CRC = """xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(c::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda acc, x: case when x >= 0 then xor(acc, x) else xor(acc >> 1, 3988292384 * (acc & 1)) end), 4294967295::bigint)"""

SQL = f"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
  from conversations where conv_id is not null),
convs as (select c, c - c % {FAMILY} as base, ({_CRC}) % {SHARED} as h from (select distinct conv_id as c from turns)),
rebuilt as (
  select v.c, t.role, t.text, 0 as own, t.place from convs v join turns t on t.conv_id = v.base and t.place <= v.h
  union all
  select v.c, t.role, t.text, 1, t.place from convs v join turns t on t.conv_id = v.c and t.place > v.h),
numbered as (select c, role, text, row_number() over (partition by c order by own, place) as depth from rebuilt),
paths as (
  select c, depth, octet_length(encode(text)) as bytes,
         list({{'role': role, 'text': text}}) over (partition by c order by depth) as path
  from numbered
  union all
  select c, 0, 0, [] from convs),
lasts as (select c, max(depth) as last from paths group by c),
named as (select c, depth, bytes, min(c) over (partition by depth, path) as rep from paths),
nodes as (
  select n.rep, n.depth, count(*) as n_convs, max(n.bytes) as bytes, any_value(u.rep) as up,
         string_agg(n.c::varchar, ',' order by n.c) filter (n.depth = l.last) as ends
  from named n join lasts l using (c) left join named u on u.c = n.c and u.depth = n.depth - 1
  group by n.rep, n.depth),
children as (select up as rep, depth - 1 as depth, count(*) as n from nodes where depth > 0 group by up, depth),
counted as (select n.*, coalesce(k.n, 0) as n_children from nodes n left join children k using (rep, depth)),
totals as (
  select a.rep, a.depth, count(*) filter (d.n_children = 0) as n_leaves, sum((d.n_convs - 1) * d.bytes)::bigint as saved_tokens
  from counted d join named a on a.c = d.rep and a.depth <= d.depth
  group by a.rep, a.depth)
select n.rep as conv_id, n.depth::bigint as depth, n.up as parent_conv_id, n.n_convs, n.n_children, t.n_leaves, t.saved_tokens, sha256(coalesce(n.ends, '')) as ends_sha256
from counted n join totals t using (rep, depth)
"""

"""Near-duplicate vectors by a forest of random-projection trees with spill.

A tree splits its rows again and again at the median of a random projection; rows
near the median go to both sides, and many trees are grown, so that a close pair
shares a leaf of some tree almost surely. Whatever shares a leaf is compared by
cosine in double precision, and links become components.

Split points are fitted on a bounded sample of a node's rows; every row is then
sent down. Nodes still too large are sampled and split again, by themselves, until
none is; what cannot be split (many scalings of one vector), and a node of whose
sampled pairs many are links, which a split would part, is compared in pairs of
chunks, so no leaf is capped. Each vector length has levels and trees by its own
number of rows. Equal vectors are one row throughout.

Splits would part a group that owns a large share of the table, and such a group
would keep all nodes above it from being split. So it is peeled off first: a
sample shows pivots that many rows are near to; the rows within the bound of a
pivot are compared to all rows within twice its angle, which is exact, and leave
the forest. That comparison returns a count a row and the spanning links of each
pair of chunks, no pairs.

Cases: vectors that are null, zero, or hold null or non-finite components, and
rows of null id, link with nothing and are their own component; vectors of
different length are never linked; equal vectors are linked, also as repeated
rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.llm.common import Scratch, hash_share, matrix, sorted_groups, spread_lookup, table, usable_vector
from promoledger.llm.components import connected_components
from promoledger.session import stage

LEAST_COSINE = 0.9
#: Trees at least; deep forests have as many more as keep the share of pairs at the bound that no tree holds together.
TREES = 10
#: Chance that a level keeps such a pair together at the default spill, and the share that may be missed.
KEPT_TOGETHER, MISSED = 0.93, 0.01
#: A node is not split where this share of its sampled pairs are links: comparing all costs at most its inverse a link.
#: Nodes of over so many leaves are split all the same.
DENSE, DENSE_SAMPLE, DENSE_LEAVES = 0.02, 256, 64
#: A pivot has this share of the rows within the bound, so there are its inverse of them at most; rows of the sample that shows them.
PEEL_SHARE, PEEL_SAMPLE, PEEL_LEAST = 0.005, 4096, 20
#: Rows of a chunk of a pivot's comparison while there are few chunks, and how many are few.
PIECE, PIECES = 256, 8
#: Rows of a leaf, about; one of over four times as many is split again.
LEAF = 1024
#: Share of a node's rows that go to both sides.
SPILL = 0.1
#: Levels of the first round and of each later one, and rows sampled to fit a node's levels.
FIRST_LEVELS, FIRST_SAMPLE = 10, 32_768
MORE_LEVELS, MORE_SAMPLE = 4, 1024
#: Later rounds; 10 + 8 * 4 levels are beyond any table.
MOST_ROUNDS = 8
#: Rows of a chunk of a leaf that no split makes smaller.
CHUNK = 2048


def directions(tree: int, turn: int, size: int, levels: int) -> np.ndarray:
    """The random directions of a tree's levels in one round, one a level."""
    return np.random.default_rng([17, tree, turn, size]).standard_normal((size, levels))


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def trees_for(depth: int, least: int = TREES) -> int:
    """Trees of so many levels that miss a pair at the bound with the chance ``MISSED`` at most, ``least`` at least."""
    return max(least, math.ceil(math.log(MISSED) / math.log1p(-(KEPT_TOGETHER**depth)))) if depth else least


def dense(units: np.ndarray, least: float) -> bool:
    """Whether a large part of the pairs of some of these rows are links."""
    some = units[np.linspace(0, len(units) - 1, min(len(units), DENSE_SAMPLE)).astype(np.int64)]
    near = int((some @ some.T >= least).sum()) - len(some)
    return len(some) > 1 and near >= DENSE * len(some) * (len(some) - 1)


def fit_levels(projected: np.ndarray, spill: float = SPILL, units: np.ndarray | None = None, least: float = LEAST_COSINE, small: float = 0, large: float = math.inf) -> tuple[np.ndarray, np.ndarray]:
    """For each inner node, in heap order, below which projection rows go left and above which right.

    Both are infinite, so that all rows go left, where a node has at most ``small`` of these rows, or is dense and has at most ``large``.
    """
    levels = projected.shape[1]
    low, high = np.zeros(1 << levels), np.zeros(1 << levels)
    rows = {1: np.arange(len(projected))}
    for level in range(levels):
        below = {}
        for at, own in rows.items():
            values = projected[own, level]
            if len(own) <= small or len(own) <= large and units is not None and dense(units[own], least):
                low[at] = high[at] = np.inf
            elif len(own):
                low[at], high[at] = np.quantile(values, [0.5 - spill / 2, 0.5 + spill / 2])
            below[2 * at], below[2 * at + 1] = own[values <= high[at]], own[values >= low[at]]
        rows = below
    return low, high


def descend(projected: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and leaf numbers of rows sent down; ``low`` and ``high`` are one list, or one a row."""
    row, at = np.arange(len(projected)), np.ones(len(projected), np.int64)
    for level in range(projected.shape[1]):
        value = projected[row, level]
        least = low[at] if low.ndim == 1 else low[row, at]
        most = high[at] if high.ndim == 1 else high[row, at]
        left, right = value <= most, value >= least
        row, at = np.concatenate([row[left], row[right]]), np.concatenate([2 * at[left], 2 * at[right] + 1])
    return row, at


def _levels(count: int, leaf: int) -> int:
    return max(0, math.ceil(math.log2(max(1, count / leaf))))


def _fit_node(rows: pd.DataFrame, turn: int, levels: int, spill: float, leaf: int, least: float) -> pd.DataFrame:
    tree, size, node, count = (int(rows[c].iloc[0]) for c in ("tree", "size", "node", "n"))
    levels = levels if turn else min(levels, _levels(count, leaf))
    vectors = unit(np.stack(rows["vector"].to_numpy()).astype(np.float64))
    small = leaf * len(rows) / count
    low, high = fit_levels(vectors @ directions(tree, turn, size, levels), spill, vectors, least, small, DENSE_LEAVES * small)
    return pd.DataFrame({"tree": [tree], "size": [size], "node": [node], "low": [low], "high": [high]})


_SPLITS = "tree int, size int, node long, low array<double>, high array<double>"


def _out(tree, size, node, batch: pa.RecordBatch, row: np.ndarray) -> pa.RecordBatch:
    rows = batch.select(["id", "copies", "vector"]).take(pa.array(row))
    count = len(row)
    heads = [pa.array(np.broadcast_to(tree, count), pa.int32()), pa.array(np.broadcast_to(size, count), pa.int32()), pa.array(node, pa.int64())]
    return pa.RecordBatch.from_arrays([*heads, *rows.columns], ["tree", "size", "node", "id", "copies", "vector"])


def _first_round(batches: Iterator[pa.RecordBatch], model: dict, grown: dict) -> Iterator[pa.RecordBatch]:
    """Send every vector down every tree of its length; the model holds bounded lists of split points.

    Rows of a length without trees are one node, of number 0, which is not split later.
    """
    for whole in batches:
        sizes = np.asarray(whole.column("size"))
        for size in np.unique(sizes).tolist():
            batch = whole.filter(pa.array(sizes == size))
            trees, levels = grown.get(size, (0, 0))
            if not trees:
                yield _out(0, size, np.zeros(batch.num_rows, np.int64), batch, np.arange(batch.num_rows))
                continue
            vectors = unit(matrix(batch.column("vector")))
            for tree in range(trees):
                low, high = model[tree, size]
                row, node = descend(vectors @ directions(tree, 0, size, levels), low, high)
                yield _out(tree, size, node, batch, row)


def _later_round(batches: Iterator[pa.RecordBatch], turn: int, levels: int) -> Iterator[pa.RecordBatch]:
    """Send rows of large nodes further down by the split points joined to them."""
    for whole in batches:
        trees, sizes = np.asarray(whole.column("tree")), np.asarray(whole.column("size"))
        for tree, size in sorted(set(zip(trees.tolist(), sizes.tolist(), strict=True))):
            batch = whole.filter(pa.array((trees == tree) & (sizes == size)))
            projected = unit(matrix(batch.column("vector"))) @ directions(tree, turn, size, levels)
            row, at = descend(projected, matrix(batch.column("low")), matrix(batch.column("high")))
            node = (np.asarray(batch.column("node"))[row] << levels) | (at - (1 << levels))
            yield _out(tree, size, node, batch, row)


def leaves(values: DataFrame, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, least: float = LEAST_COSINE) -> DataFrame:
    """``tree, size, node, id, copies, vector``: each vector in its leaf, or leaves, of every tree."""
    schema = f"tree int, size int, node long, id long, copies long, vector {values.schema['vector'].dataType.simpleString()}"
    fit = partial(_fit_node, spill=spill, leaf=leaf, least=least)
    # Only lengths of over a leaf of rows are split, so the driver gets a row for each leaf at most.
    sizes = values.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf)
    grown, model = {}, {}
    for row in sizes.collect():
        depth = _levels(row["n"], leaf)
        grown[row["size"]] = (trees_for(depth, trees), min(FIRST_LEVELS, depth))
    if grown:
        number = F.create_map(*[F.lit(x) for size, (count, _) in grown.items() for x in (size, count)])
        drawn = values.join(sizes, "size").where(hash_share("id") < FIRST_SAMPLE / F.col("n"))
        spread = drawn.select("size", "vector", "n", F.lit(1).cast("long").alias("node"), F.explode(F.sequence(F.lit(0), number[F.col("size")] - 1)).alias("tree"))
        fitted = spread.groupBy("tree", "size", "node").applyInPandas(partial(fit, turn=0, levels=FIRST_LEVELS), _SPLITS)
        # At most 2 ** FIRST_LEVELS split points for each tree.
        for row in fitted.collect():
            model[row["tree"], row["size"]] = (np.array(row["low"]), np.array(row["high"]))
        for size in {size for (_, size), (low, _) in model.items() if low[1] == np.inf}:
            del grown[size]
    rows, _ = stage(values.mapInArrow(partial(_first_round, model=model, grown=grown), schema), "forest")
    done = None
    for turn in range(1, MOST_ROUNDS + 1):
        counts = rows.groupBy("tree", "size", "node").agg(F.count(F.lit(1)).alias("n"))
        large, _ = stage(counts.where((F.col("n") > 4 * leaf) & (F.col("node") > 0)), "forest-large")
        if not large.limit(1).count():
            break
        keys = ["tree", "size", "node"]
        hot = rows.join(large, keys)
        drawn = hot.where(hash_share("id") < MORE_SAMPLE / F.col("n"))
        fitted = drawn.groupBy(*keys).applyInPandas(partial(fit, turn=turn, levels=MORE_LEVELS), _SPLITS)
        # A node that is not to be split stays as it is.
        splits, _ = stage(fitted.where(F.element_at("low", 2) < float("inf")), "forest-splits")
        whole = rows.join(splits, keys, "left_anti")
        done = whole if done is None else done.unionByName(whole)
        split = hot.drop("n").join(splits, keys).mapInArrow(partial(_later_round, turn=turn, levels=MORE_LEVELS), schema)
        rows, _ = stage(split, "forest")
    return rows if done is None else done.unionByName(rows)


_PAIRS = "a long, b long, copies_a long, copies_b long"


def _compare(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Links within each leaf, or between the two chunks of a pair of chunks."""
    for group in sorted_groups(batches, ["tree", "size", "node", "first", "second"]):
        if group.num_rows < 2:
            continue
        ids, copies, side = (group.column(c).to_numpy() for c in ("id", "copies", "side"))
        vectors = matrix(group.column("vector"))
        units = unit(vectors)
        quick = units.astype(np.float32)
        first, second = group.column("first")[0].as_py(), group.column("second")[0].as_py()
        for at in range(0, len(ids), 512):
            near = np.argwhere(quick[at : at + 512] @ quick.T >= least - 1e-4)
            i, j = near[:, 0] + at, near[:, 1]
            chosen = ids[i] < ids[j] if first == second else (side[i] == first) & (side[j] == second)
            i, j = i[chosen], j[chosen]
            cosine = np.einsum("ij,ij->i", units[i], units[j])
            i, j = i[cosine >= least], j[cosine >= least]
            if len(i):
                swap = ids[i] > ids[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[i], ids[j], copies[i], copies[j])], ["a", "b", "copies_a", "copies_b"])


def links(values: DataFrame, least: float = LEAST_COSINE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL) -> DataFrame:
    """Distinct pairs ``a, b`` of ids of distinct vectors, a < b, with how many copies each has."""
    rows = leaves(values, trees, leaf, spill, least)
    keys = ["tree", "size", "node"]
    large, _ = stage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 4 * leaf), "forest-chunks")
    marked = rows.join(large, keys, "left")
    chunks = F.coalesce(F.ceil(F.col("n") / CHUNK).cast("int"), F.lit(1))
    side = F.pmod(F.xxhash64("id"), chunks).cast("int")
    dealt = marked.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    dealt = dealt.withColumn("first", F.least("side", "other")).withColumn("second", F.greatest("side", "other")).drop("other", "n")
    order = [*keys, "first", "second"]
    grouped = dealt.repartition(*order).sortWithinPartitions(*order)
    return grouped.mapInArrow(partial(_compare, least=least), _PAIRS).distinct()


def pivots(units: np.ndarray, least: float) -> np.ndarray:
    """Rows of a sample that ``PEEL_SHARE`` of it are near to, each near to none before it."""
    wanted = max(PEEL_LEAST, PEEL_SHARE * len(units))
    near = units @ units.T >= least
    left, found = np.ones(len(units), bool), []
    while left.any():
        counts = (near & left).sum(axis=1) * left
        best = int(counts.argmax())
        if counts[best] < wanted:
            break
        found.append(best)
        left &= ~near[best]
    return units[found]


def _peel(batches: Iterator[pa.RecordBatch], sent, least: float) -> Iterator[pa.RecordBatch]:
    """Each row once for every pivot at whose comparison it takes part, and once (pivot -1) for the forest if no pivot owns it.

    A row belongs to the first pivot it is within the bound of, and takes part at
    that and the pivots before it; one that belongs to none takes part at all.
    """
    reach = 2 * least * least - 1 - 1e-9
    for whole in batches:
        sizes = np.asarray(whole.column("size"))
        for size in np.unique(sizes).tolist():
            batch = whole.filter(pa.array(sizes == size))
            centres = sent.value.get(size)
            every = np.arange(batch.num_rows)
            if centres is None:
                row, pivot, inner = every, np.full(len(every), -1), np.zeros(len(every), bool)
            else:
                cosine = unit(matrix(batch.column("vector"))) @ centres.T
                inside = cosine >= least
                owner = np.where(inside.any(axis=1), inside.argmax(axis=1), len(centres))
                row, pivot = np.nonzero((cosine >= reach) & (np.arange(len(centres)) <= owner[:, None]))
                free = np.flatnonzero(owner == len(centres))
                inner = np.concatenate([owner[row] == pivot, np.zeros(len(free), bool)])
                row, pivot = np.concatenate([row, free]), np.concatenate([pivot, np.full(len(free), -1)])
            part = batch.take(pa.array(row, pa.int64()))
            columns = [pa.array(pivot.astype(np.int32)), pa.array(inner), *[part.column(c) for c in ("id", "copies", "vector", "size")]]
            yield pa.RecordBatch.from_arrays(columns, ["pivot", "inner", "id", "copies", "vector", "size"])


def spanning(near: np.ndarray) -> np.ndarray:
    """For the two sides of a bipartite graph, first side first: the number of each node's component, its least node."""
    first, second = near.shape
    root = np.full(first + second, -1)
    for start in range(first + second):
        if root[start] >= 0:
            continue
        root[start] = start
        waiting = [start]
        while waiting:
            at = waiting.pop()
            reached = np.flatnonzero(near[at]) + first if at < first else np.flatnonzero(near[:, at - first])
            fresh = reached[root[reached] < 0]
            root[fresh] = start
            waiting.extend(fresh.tolist())
    return root


def _balls(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Counts and spanning links between a chunk of a pivot's own rows and a chunk of all that may be near to them."""
    for group in sorted_groups(batches, ["size", "pivot", "first", "second"]):
        role, inner, ids, copies = (np.asarray(group.column(c)) for c in ("role", "inner", "id", "copies"))
        units = unit(matrix(group.column("vector")))
        own, other = np.flatnonzero(role), np.flatnonzero(~role)
        if not len(own) or not len(other):
            continue
        cosine = units[own] @ units[other].T
        i, j = np.nonzero(np.abs(cosine - least) < 1e-9)
        cosine[i, j] = np.einsum("ij,ij->i", units[own[i]], units[other[j]])
        near = (cosine >= least) & (ids[own][:, None] != ids[other][None, :])
        # A row of the pivot's own counts when it is on the first side, any other on the second.
        counted = np.concatenate([near @ copies[other], np.where(inner[other], 0, copies[own] @ near)])
        node = ids[np.concatenate([own, other])]
        root = node[spanning(near)]
        told = (counted > 0) | (root != node)
        yield pa.RecordBatch.from_arrays([pa.array(node[told]), pa.array(counted[told].astype(np.int64)), pa.array(root[told])], ["id", "n", "root"])


def peeled(values: DataFrame, scratch: Scratch, least: float = LEAST_COSINE, leaf: int = LEAF) -> tuple[DataFrame, DataFrame | None]:
    """The rows left for the forest, and ``id, n, root`` of what the pivots' rows link to, if there are pivots."""
    spark = values.sparkSession
    found: dict[int, np.ndarray] = {}
    for row in values.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf).collect():
        drawn = values.where((F.col("size") == row["size"]) & (hash_share("id") < PEEL_SAMPLE / row["n"])).orderBy("id").select("vector").toPandas()
        centres = pivots(unit(np.stack(drawn["vector"].to_numpy()).astype(np.float64)), least) if len(drawn) else ()
        if len(centres):
            found[row["size"]] = centres
    if not found:
        return values, None
    kind = values.schema["vector"].dataType.simpleString()
    sent = spark.sparkContext.broadcast(found)
    rows = scratch.stage(values.select("id", "copies", "vector", "size").mapInArrow(partial(_peel, sent=sent, least=least), f"pivot int, inner boolean, id long, copies long, vector {kind}, size int"), "peeled")
    taking = rows.where(F.col("pivot") >= 0)
    keys = ["size", "pivot"]
    chunks = lambda count: F.greatest(F.ceil(count / CHUNK), F.least(F.ceil(count / PIECE), F.lit(PIECES))).cast("int")
    sizes = scratch.stage(taking.groupBy(*keys).agg(chunks(F.count_if("inner")).alias("firsts"), chunks(F.count(F.lit(1))).alias("seconds")), "pivots")
    marked = taking.join(sizes, keys)
    chunk = lambda count: F.pmod(F.xxhash64("id"), F.greatest(F.col(count), F.lit(1))).cast("int")
    to = lambda count: F.explode(F.sequence(F.lit(0), F.greatest(F.col(count), F.lit(1)) - 1))
    own = marked.where("inner").withColumn("first", chunk("firsts")).withColumn("second", to("seconds")).withColumn("role", F.lit(True))
    other = marked.withColumn("second", chunk("seconds")).withColumn("first", to("firsts")).withColumn("role", F.lit(False))
    order = [*keys, "first", "second"]
    dealt = own.unionByName(other).select(*order, "role", "inner", "id", "copies", "vector").repartition(*order).sortWithinPartitions(*order)
    linked = scratch.stage(dealt.mapInArrow(partial(_balls, least=least), "id long, n long, root long"), "pivot-links")
    return rows.where(F.col("pivot") < 0).select("id", "copies", "vector", "size"), linked


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST_COSINE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL) -> DataFrame:
    """``id, n_links, component`` of every row."""
    ident, vector = F.col(id_col).cast("long"), F.col(vector_col)
    # 128 bits of hash stand for a vector wherever only equality counts.
    key = F.struct(F.xxhash64(vector).alias("p"), F.xxhash64(F.lit(1), vector).alias("q"))
    usable = rows.select(ident.alias("id"), vector.alias("vector"), usable_vector(vector, ident).alias("ok"))
    named = rows.select(ident.alias("id"), F.when(usable_vector(vector, ident), key).alias("key"))
    equal = usable.where("ok").groupBy(F.struct(F.xxhash64("vector").alias("p"), F.xxhash64(F.lit(1), "vector").alias("q")).alias("key")).agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")
    )
    scratch = Scratch(rows.sparkSession)
    values = scratch.stage(equal.withColumn("size", F.size("vector")), "vectors")
    left, balls = peeled(values, scratch, least, leaf)
    pairs = scratch.stage(links(left, least, trees, leaf, spill), "vector-links")
    both = pairs.select(F.col("a").alias("id"), F.col("copies_b").alias("n")).unionAll(pairs.select(F.col("b").alias("id"), F.col("copies_a").alias("n")))
    edges = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    if balls is not None:
        both = both.unionAll(balls.select("id", "n"))
        edges = edges.unionAll(balls.where(F.col("id") != F.col("root")).select(F.col("root").alias("src"), F.col("id").alias("dst")))
    degree = both.groupBy("id").agg(F.sum("n").alias("n"))
    roots = connected_components(edges).select(F.col("node").alias("id"), "root")
    known = values.select("key", "id", "copies").join(degree, "id", "left").join(roots, "id", "left").where(F.col("root").isNotNull() | (F.col("copies") > 1))
    lookup = known.select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "id").alias("component"))
    found = spread_lookup(named, scratch.result(lookup, "vector-components"), ["key"])
    return found.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component"))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: links and component of every embedding."""
    found = near_duplicates(table(spark, sf_dir, "embeddings"))
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(False))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), kept.alias("kept"))

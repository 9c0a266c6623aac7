"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in half and each half is quantised by centroids of its own; a
cell is a pair of centroids. A query sorts either half's centroids by distance
and a heap walks their pairs by summed distance, nearest first, until the cells
seen hold enough vectors; all of those are scored on the original vectors in
double precision. Nearness is the inner product, so a centroid's distance is its
negative inner product with the query's half, which adds up over halves.

Centroids are fitted on a bounded sample (about ``SAMPLE`` vectors by hash share);
every vector is indexed, and the number of cells follows the table's. How many
vectors are enough is measured, not assumed: about ``CALIBRATION`` of the queries
are answered exactly first, and the walk goes so far that it meets ``TARGET`` of
their true neighbours. Vectors in clusters need a small share of the table, those
without structure most of it. Each length of vectors has an index of its own.
Equal vectors are one entry with the least ids, as many as a result can name.
Neighbouring cells form blocks, so that a query goes once to a block with the list
of cells that it looks at there; blocks with many entries or queries are cut into
chunks, so neither a popular cell nor a popular query lands in one task.

Cases: vectors that are null, zero, or hold null or non-finite components and rows
of null id take no part; vectors of unlike length have no inner product, so each is
searched among those of its own; equal scores go to the smaller id; a repeated row
is found once and a repeated query is answered once; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoledger.llm.common import hash_share, matrix, sorted_groups, table, usable_vector
from promoledger.session import stage

NEAREST = 20
SAMPLE = 32_768
#: Centroids a half, at most; the index has this many squared cells at most.
MOST_CENTROIDS = 1024
#: Share of the true neighbours of the calibration queries that the walk has to meet, and about how many such queries.
TARGET = 0.95
CALIBRATION = 256
#: Entries of a block of cells, and queries of a block, that one task compares, about.
CHUNK = 2048
#: Queries whose cells one task walks through, about.
QUERIES_A_TASK = 128
_ROUNDS = 12


def centroids_for(count: int) -> int:
    """The power of two nearest to 0.6 times the square root of the number of entries: a few entries a cell."""
    return int(min(MOST_CENTROIDS, max(4, 2 ** round(math.log2(0.6 * math.sqrt(max(1, count)))))))


def k_means(points: np.ndarray, k: int) -> np.ndarray:
    """Centroids by Lloyd's rounds from k-spread rows; an empty one takes the row farthest from its own."""
    rng = np.random.default_rng(5)
    centres = points[rng.permutation(len(points))[: min(k, len(points))]].copy()
    for _ in range(_ROUNDS):
        own = nearest_centre(points, centres)
        apart = ((points - centres[own]) ** 2).sum(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        counts = np.bincount(own, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        for i, far in zip(np.flatnonzero(counts == 0), np.argsort(-apart), strict=False):
            centres[i] = points[far]
    return centres


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def _fit_half(rows: pd.DataFrame, centroids: int) -> pd.DataFrame:
    half = int(rows["half"].iloc[0])
    vectors = np.stack(rows.sort_values("id")["vector"].to_numpy()).astype(np.float64)
    middle = vectors.shape[1] // 2
    centres = k_means(vectors[:, :middle] if half == 0 else vectors[:, middle:], centroids)
    return pd.DataFrame({"half": half, "number": np.arange(len(centres)), "centre": list(centres)})


def cells_of(vectors: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    middle = vectors.shape[1] // 2
    return nearest_centre(vectors[:, :middle], model[0]) * len(model[1]) + nearest_centre(vectors[:, middle:], model[1])


def nearest_cells(query: np.ndarray, model: tuple[np.ndarray, np.ndarray], held: np.ndarray, wanted: int) -> list[int]:
    """Non-empty cells in order of summed distance, until they hold ``wanted`` entries."""
    middle = len(query) // 2
    first, second = -(model[0] @ query[:middle]), -(model[1] @ query[middle:])
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    near, far = first[one].tolist(), second[two].tolist()
    heap, seen, chosen, total = [(near[0] + far[0], 0, 0)], {(0, 0)}, [], 0
    while heap and total < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(one[i]) * len(two) + int(two[j])
        if held[cell]:
            chosen.append(cell)
            total += int(held[cell])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(near) and b < len(far) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (near[a] + far[b], a, b))
    return chosen


def _assign(batches: Iterator[pa.RecordBatch], model: tuple) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = cells_of(matrix(batch.column("vector")), model) if batch.num_rows else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), *batch.columns], ["cell", *batch.schema.names])


def blocks_of(held: np.ndarray, seconds: int) -> np.ndarray:
    """A block number for each cell: runs of neighbouring cells of one first centroid that hold about CHUNK entries."""
    rows = held.reshape(-1, seconds)
    inside = (np.cumsum(rows, axis=1) - rows) // CHUNK
    start = np.concatenate([[0], np.cumsum(inside[:, -1] + 1)[:-1]])
    return (inside + start[:, None]).ravel()


def _visit(batches: Iterator[pa.RecordBatch], model: tuple, sent, wanted: int) -> Iterator[pa.RecordBatch]:
    """The cells to look at for each query, one row a block."""
    held, block = sent.value
    for batch in batches:
        vectors = matrix(batch.column("vector"))
        for at in range(0, batch.num_rows, 256):
            rows, blocks, cells = [], [], []
            for row in range(at, min(at + 256, batch.num_rows)):
                chosen = np.sort(np.array(nearest_cells(vectors[row], model, held, wanted), np.int32))
                own = block[chosen]
                starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                rows.extend([row] * len(starts))
                blocks.extend(own[starts].tolist())
                cells.extend(np.split(chosen, starts[1:]))
            part = batch.select(["id", "vector"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(cells, pa.list_(pa.int32())), *part.columns], ["block", "cells", "id", "vector"])


def _score(batches: Iterator[pa.RecordBatch], nearest: int) -> Iterator[pa.RecordBatch]:
    """Best entries of one chunk of a block for each of its queries, of the cells that the query looks at."""
    for group in sorted_groups(batches, ["block", "entries", "queries"]):
        asks = group.column("asks").to_numpy()
        if asks.all() or not asks.any():
            continue
        queries, entries = group.filter(pa.array(asks)).combine_chunks(), group.filter(pa.array(~asks)).combine_chunks()
        vectors, names = matrix(entries.column("vector")), entries.column("ids").to_pylist()
        known, place = np.unique(entries.column("cells").combine_chunks().flatten().to_numpy(), return_inverse=True)
        wanted, own = matrix(queries.column("vector")), queries.column("id").to_numpy()
        lists = queries.column("cells").combine_chunks()
        asked = np.clip(np.searchsorted(known, lists.flatten().to_numpy()), 0, len(known) - 1)
        there = known[asked] == lists.flatten().to_numpy()
        looks = np.zeros((len(wanted), len(known)), bool)
        looks[np.repeat(np.arange(len(wanted)), lists.value_lengths().to_numpy())[there], asked[there]] = True
        # A few more than needed: scores that rounding could swap are computed again.
        count = min(nearest + 9, len(vectors))
        found_query, found_entry, found_score = [], [], []
        for at in range(0, len(wanted), 256):
            part = wanted[at : at + 256]
            rough = np.where(looks[at : at + 256][:, place], part @ vectors.T, -np.inf)
            best = np.argpartition(-rough, count - 1, axis=1)[:, :count]
            exact = np.einsum("qcd,qd->qc", vectors[best], part)
            exact[np.isneginf(np.take_along_axis(rough, best, axis=1))] = -np.inf
            order = np.argsort(-exact, axis=1, kind="stable")[:, : nearest + 1]
            for q in range(len(part)):
                for c in order[q]:
                    if exact[q, c] == -np.inf:
                        break
                    for name in names[best[q, c]]:
                        if name != own[at + q]:
                            found_query.append(own[at + q]), found_entry.append(name), found_score.append(exact[q, c])
        columns = [pa.array(found_query, pa.int64()), pa.array(found_entry, pa.int64()), pa.array(found_score, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])


def _exact(batches: Iterator[pa.RecordBatch], sent, nearest: int) -> Iterator[pa.RecordBatch]:
    """For each calibration query the cells of the nearest entries among these rows, with their scores."""
    names, wanted = sent.value
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64)) for _ in names]
    for batch in batches:
        vectors, cells, ids = matrix(batch.column("vector")), batch.column("cell").to_numpy(), batch.column("id").to_numpy()
        alone = batch.column("ids").value_lengths().to_numpy() == 1
        scores = wanted @ vectors.T
        scores[(names[:, None] == ids[None, :]) & alone[None, :]] = -np.inf
        for q in range(len(names)):
            kept = np.concatenate([best[q][0], scores[q]])
            top = np.argsort(-kept, kind="stable")[:nearest]
            best[q] = kept[top], np.concatenate([best[q][1], cells])[top]
    for q, (scores, cells) in enumerate(best):
        there = scores > -np.inf
        if there.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(int(there.sum()), q, np.int32)), pa.array(scores[there]), pa.array(cells[there])], ["query", "score", "cell"])


def walked(query: np.ndarray, model: tuple[np.ndarray, np.ndarray], held: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """How many entries the walk of a query has met when it has been through each of the cells."""
    middle = len(query) // 2
    apart = (-(model[0] @ query[:middle])[:, None] - (model[1] @ query[middle:])[None, :]).ravel()
    order = np.argsort(apart, kind="stable")
    met = np.cumsum(held[order])
    return met[np.searchsorted(apart[order], apart[cells], side="right") - 1]


def _budgets(batches: Iterator[pa.RecordBatch], sent, model: tuple, held) -> Iterator[pa.RecordBatch]:
    wanted = sent.value[1]
    for group in sorted_groups(batches, ["query"]):
        query = wanted[group.column("query")[0].as_py()]
        yield pa.RecordBatch.from_arrays([pa.array(walked(query, model, held.value[0], group.column("cell").to_numpy()))], ["met"])


def calibrated(index: DataFrame, asking: DataFrame, model: tuple, held, asked: int, nearest: int = NEAREST, target: float = TARGET, queries: int = CALIBRATION) -> int:
    """How many entries a walk has to meet so that it finds ``target`` of the true neighbours, as measured on a sample of the queries.

    A sample of about ``queries`` rows goes to all tasks, each answers it exactly for
    its own entries, and the best of those say how far each neighbour's cell is.
    """
    spark = index.sparkSession
    drawn = asking.where(hash_share("id") < queries / max(1, asked)).orderBy("id").toPandas()
    if not len(drawn):
        return 0
    sent = spark.sparkContext.broadcast((drawn["id"].to_numpy(), np.stack(drawn["vector"].to_numpy()).astype(np.float64)))
    found = index.select("cell", "id", "ids", "vector").mapInArrow(partial(_exact, sent=sent, nearest=nearest), "query int, score double, cell long")
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cell"))
    nearest_cells_ = found.withColumn("rank", best).where(F.col("rank") <= nearest).select("query", "cell")
    by_query = nearest_cells_.repartition("query").sortWithinPartitions("query")
    # A number a neighbour: at most some queries times nearest.
    met = np.sort(by_query.mapInArrow(partial(_budgets, sent=sent, model=model, held=held), "met long").toPandas()["met"].to_numpy())
    return int(met[math.ceil(target * len(met)) - 1]) if len(met) else 0


def search(
    rows: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", nearest: int = NEAREST, share: float | None = None, target: float = TARGET
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found for every row that the condition ``is_query`` picks.

    Every walk goes on until it has met the calibrated number of entries, or with
    ``share`` that share of them.
    """
    ident, vector = F.col(id_col).cast("long"), F.col(vector_col)
    usable = rows.where(usable_vector(vector, ident)).select(ident.alias("id"), vector.alias("vector"), is_query.alias("asks"))
    # One entry a length: a table of embeddings has few.
    sizes = sorted(r["size"] for r in usable.groupBy(F.size("vector").alias("size")).agg(F.max("asks").alias("asks")).where("asks").collect())
    found = None
    for size in sizes:
        part = _search(usable.where(F.size("vector") == size), nearest, share, target)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return found


def _search(usable: DataFrame, nearest: int, share: float | None, target: float) -> DataFrame:
    """The search among vectors of one length."""
    spark = usable.sparkSession
    key = [F.xxhash64("vector").alias("p"), F.xxhash64(F.lit(1), "vector").alias("q")]
    ids = usable.select("id", *key).distinct()
    place = F.row_number().over(Window.partitionBy("p", "q").orderBy("id"))
    named = ids.withColumn("place", place).where(F.col("place") <= nearest + 1).groupBy("p", "q").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    one = usable.select("id", "vector", *key)
    # The vector travels with the least id of its copies only.
    entries = named.withColumn("id", F.col("ids")[0]).join(one.dropDuplicates(["id"]), ["id", "p", "q"]).select("id", "ids", "vector")
    entries, _ = stage(entries, "index-entries")
    count = entries.count()
    drawn = entries.where(hash_share("id") < SAMPLE / max(1, count))
    halves = drawn.select("id", "vector", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
    fitted = halves.groupBy("half").applyInPandas(partial(_fit_half, centroids=centroids_for(count)), "half int, number int, centre array<double>")
    centres = fitted.toPandas().sort_values(["half", "number"])
    schema = "query_id long, vec_id long, score double"
    model = tuple(np.stack(centres.loc[centres["half"] == h, "centre"].to_numpy()) for h in (0, 1))
    kind = entries.schema["vector"].dataType.simpleString()
    index, _ = stage(entries.mapInArrow(partial(_assign, model=model), f"cell long, id long, ids array<long>, vector {kind}"), "index")

    def counted(rows: DataFrame, column: str, size: int) -> np.ndarray:
        found = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).toPandas()
        counts = np.zeros(size, np.int64)
        counts[found[column].to_numpy()] = found["n"].to_numpy()
        return counts

    # All that is known of cells and blocks: at most MOST_CENTROIDS squared numbers.
    held = counted(index, "cell", len(model[0]) * len(model[1]))
    block = blocks_of(held, len(model[1]))
    sent = spark.sparkContext.broadcast((held, block))
    asking = usable.where("asks").select("id", "vector").dropDuplicates(["id"])
    asked = asking.count()
    wanted = math.ceil(share * count) if share is not None else calibrated(index, asking, model, sent, asked, nearest, target)
    # Few bytes but much work a query: tasks by their number, which no merging of small partitions undoes.
    asking = asking.repartition(max(1, math.ceil(asked / QUERIES_A_TASK)), "id")
    visits, _ = stage(
        asking.mapInArrow(partial(_visit, model=model, sent=sent, wanted=wanted), f"block long, cells array<int>, id long, vector {kind}"), "index-visits"
    )
    asked = counted(visits, "block", int(block.max()) + 1)
    inside = np.bincount(block, held)
    chunks = spark.sparkContext.broadcast((-(-np.maximum(inside, 1) // (2 * CHUNK)), -(-np.maximum(asked, 1) // CHUNK)))

    @F.arrow_udf("long")
    def block_of(cells: pa.Array) -> pa.Array:
        return pa.array(sent.value[1][cells.to_numpy()])

    @F.arrow_udf("entries int, queries int")
    def chunk_counts(blocks: pa.Array) -> pa.Array:
        at = blocks.to_numpy()
        return pa.StructArray.from_arrays([pa.array(c[at].astype(np.int32)) for c in chunks.value], ["entries", "queries"])

    def dealt(rows: DataFrame, asks: bool) -> DataFrame:
        own, other = ("queries", "entries") if asks else ("entries", "queries")
        chunked = rows.withColumn("__chunks", chunk_counts("block"))
        chunked = chunked.withColumn(own, F.pmod(F.xxhash64("id"), F.col(f"__chunks.{own}")).cast("int"))
        chunked = chunked.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"__chunks.{other}") - 1)))
        names = F.lit(None).cast("array<long>") if asks else F.col("ids")
        return chunked.select("block", "entries", "queries", F.lit(asks).alias("asks"), "cells", "id", names.alias("ids"), "vector")

    own_cells = index.withColumn("block", block_of("cell")).withColumn("cells", F.array(F.col("cell").cast("int")))
    order = ["block", "entries", "queries"]
    together = dealt(own_cells, False).unionByName(dealt(visits, True)).repartition(*order).sortWithinPartitions(*order)
    scored = together.mapInArrow(partial(_score, nearest=nearest), schema)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", best).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op7: the twenty nearest of every embedding whose id is divisible by twenty."""
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, F.col("vec_id") % 20 == 0)

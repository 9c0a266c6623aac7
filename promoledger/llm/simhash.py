"""SimHash near-duplicates: 64-bit fingerprints of word shingles, joined on pigeonhole blocks.

A fingerprint is cut into six blocks. Two fingerprints that differ in at most
three bits agree on at least three of the six, so they meet under one of the
twenty keys made of three blocks; whatever meets is compared bit by bit. Equal
fingerprints are one row before that, so a group of copies never meets itself.

Cases: null, empty and blank texts have fingerprint zero and are linked like any
other; repeated rows stay, with the same component; rows of null id take part and
get the least id of their component (null if it has none); whole texts are read,
however long; an input column called like an output column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoledger.llm.common import spread_lookup, table, with_outputs
from promoledger.llm.components import connected_components
from promoledger.session import stage

SHINGLE = 3
SEED = 42
MOST_BITS = 3
#: Bits of each of the six blocks.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: A key shared by more distinct fingerprints is cut further before it is compared.
LARGE = 4096
_PIECE = 1 << 18


def fingerprint(text: str | None, words: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set where it is set in more than half the shingles' XXH64."""
    import xxhash

    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return 0
    whole = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    count = max(1, len(parts) - words + 1)
    begin, end = begins[:count].tolist(), ends[min(words, len(parts)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, count, _PIECE):
        spans = zip(begin[at : at + _PIECE], end[at : at + _PIECE], strict=True)
        hashes = np.array([digest(whole[b:e], seed) for b, e in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > count, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fp", words: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of each whole text, as a signed long."""

    @F.arrow_udf("long")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            yield pa.array([fingerprint(t, words) for t in column.to_pylist()], pa.int64())

    return docs.select(*with_outputs(docs, [out]), of(F.col(text_col)).alias(out))


def block_keys(fp: Column) -> Column:
    """The twenty keys of a fingerprint: three of its six blocks, with the choice's number."""
    lows = [sum(BLOCKS[:i]) for i in range(len(BLOCKS))]
    masks = [((1 << size) - 1) << low for size, low in zip(BLOCKS, lows, strict=True)]
    keys = []
    for number, chosen in enumerate(combinations(range(len(BLOCKS)), len(BLOCKS) - MOST_BITS)):
        mask = sum(masks[i] for i in chosen)
        mask -= 1 << 64 if mask >> 63 else 0
        keys.append(F.xxhash64(F.lit(number), fp.bitwiseAND(F.lit(mask).cast("long"))))
    return F.array(*keys)


def part_keys(fp: Column, number: Column) -> Column:
    """The bits that the key of that number leaves open, in four parts: two fingerprints of one key that differ in three bits at most agree on a part."""
    lows = [sum(BLOCKS[:i]) for i in range(len(BLOCKS))]
    choices = []
    for chosen in combinations(range(len(BLOCKS)), len(BLOCKS) - MOST_BITS):
        open_bits = [low + bit for i, (low, size) in enumerate(zip(lows, BLOCKS, strict=True)) if i not in chosen for bit in range(size)]
        masks = [sum(1 << bit for bit in open_bits[at :: MOST_BITS + 1]) for at in range(MOST_BITS + 1)]
        masks = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
        choices.append(F.array(*[F.lit(mask).cast("long") for mask in masks]))
    masks = F.element_at(F.array(*choices), number + 1)
    return F.transform(masks, lambda mask, at: F.struct(at.alias("at"), fp.bitwiseAND(mask).alias("bits")))


def star_links(values: np.ndarray, most: int = MOST_BITS) -> list[tuple[int, int]]:
    """Least spanning links of the graph "at most ``most`` bits apart" over distinct values.

    One pass from value to value: each is compared once to all not yet reached.
    """
    left = np.sort(values)
    out: list[tuple[int, int]] = []
    while len(left) > 1:
        root, waiting, left = left[0], [left[0]], left[1:]
        while waiting and len(left):
            # Counted without sign: of a negative number, bitwise_count takes the magnitude.
            near = np.bitwise_count((left ^ waiting.pop()).view(np.uint64)) <= most
            if near.any():
                reached = left[near]
                left = left[~near]
                out.extend((int(v), int(root)) for v in reached)
                waiting.extend(reached)
    return out


def _compare(batches: Iterator[pa.RecordBatch], large: int | None) -> Iterator[pa.RecordBatch]:
    """Links among the fingerprints of each key, of rows sorted by key; keys of over ``large`` are named instead.

    Keeps one batch and the fingerprints of one key.
    """
    pending: list[np.ndarray] = []
    held, key, over = 0, None, False

    def result(links, large_keys=()):
        src = [a for a, _ in links] + list(large_keys)
        dst = [b for _, b in links] + [None] * len(large_keys)
        return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])

    def close():
        if over:
            return result([], [key])
        return result(star_links(np.concatenate(pending))) if held > 1 else None

    for batch in batches:
        keys, values = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
        if not len(keys):
            continue
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        ends = np.append(starts[1:], len(keys))
        if keys[0] == key:
            # The first run goes on from the batch before.
            held += int(ends[0])
            over = over or (large is not None and held > large)
            pending = [] if over else [*pending, values[: ends[0]]]
            starts, ends = starts[1:], ends[1:]
            if not len(starts):
                continue
        if key is not None and (found := close()) is not None:
            yield found
        links, named = [], []
        for i in np.flatnonzero(ends[:-1] - starts[:-1] > 1):
            run = values[starts[i] : ends[i]]
            if large is not None and len(run) > large:
                named.append(int(keys[starts[i]]))
            else:
                links.extend(star_links(run))
        if links or named:
            yield result(links, named)
        key, pending, held = int(keys[starts[-1]]), [values[starts[-1] :]], int(ends[-1] - starts[-1])
        over = large is not None and held > large
        pending = [] if over else pending
    if key is not None and (found := close()) is not None:
        yield found


def link_distinct(values: DataFrame) -> DataFrame:
    """Links ``src, dst`` that join distinct fingerprints ``fp`` into the components of "three bits apart or less".

    Keys of more than ``LARGE`` fingerprints come back as names; their rows are
    dealt out again by the bits that the key leaves open, in four parts, one of
    which close fingerprints share, and compared there. So a hot key is spread
    over many tasks and none is dropped.
    """
    keyed = values.select("fp", F.explode(block_keys(F.col("fp"))).alias("key"))
    schema = "src long, dst long"
    sorted_keys = keyed.repartition("key").sortWithinPartitions("key")
    first, _ = stage(sorted_keys.mapInArrow(partial(_compare, large=LARGE), schema), "simhash-links")
    large = first.where(F.col("dst").isNull()).select(F.col("src").alias("key"))
    links = first.where(F.col("dst").isNotNull())
    if large.limit(1).count():
        numbered = values.select("fp", F.posexplode(block_keys(F.col("fp"))).alias("number", "key"))
        parts = numbered.join(large, "key", "left_semi").select("key", "fp", F.explode(part_keys(F.col("fp"), F.col("number"))).alias("part"))
        finer = parts.select(F.xxhash64("key", "part.at", "part.bits").alias("key"), "fp").repartition("key").sortWithinPartitions("key")
        links = links.unionByName(finer.mapInArrow(partial(_compare, large=None), schema))
    return links.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """``id, fp, component`` of every document; the component is the least id reachable over links.

    Only (id, fingerprint) pairs are shuffled, never texts. Fingerprints alone on
    their own are their own component; only the others are looked up, spread over
    salts, since one fingerprint may own a third of all rows.
    """
    marked = fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), words=words).select("id", "fp")
    rows, _ = stage(marked, "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    values, _ = stage(distinct, "distinct-fingerprints")
    roots = connected_components(link_distinct(values)).select(F.col("node").alias("fp"), "root")
    known = values.join(roots, "fp", "left").where(F.col("root").isNotNull() | (F.col("copies") > 1))
    named = known.withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component"))
    lookup, _ = stage(spread_lookup(named.select("fp", "root"), least, ["root"], "inner").select("fp", "component"), "components")
    found = spread_lookup(rows, lookup.withColumn("known", F.lit(True)), ["fp"])
    return found.select("id", "fp", F.when(F.col("known"), F.col("component")).otherwise(F.col("id")).alias("component"))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))

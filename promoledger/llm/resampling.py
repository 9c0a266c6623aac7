"""Importance resampling towards a target distribution, by hashed word n-grams.

Features are runs of one to three words, joined by one space; a feature's bucket
is its CRC-32 modulo the number of buckets. Both corpora are counted by bucket, a
bucket's gain is the logarithm of the ratio of its smoothed shares, a document's
weight is the sum of its features' gains, and a share of the documents is drawn
without replacement by weight plus Gumbel noise that a hash of the id fixes.

No feature is ever spelled out. Words are read once, each followed by a space,
and only the running CRC after each is kept. The CRC up to the end of a word
follows by taking the space back; the CRC of the bytes between two places is that
of the longer prefix, less that of the shorter one carried on over the length in
between, which is a linear map over GF(2) and so four table lookups.

Cases: null, empty and blank texts have no feature and weight 0; a null id has
the noise of an empty id and comes last among equal scores; repeated rows are
documents of their own; an empty target gives gains too; an empty corpus gives an
empty result; an input column called like an output column is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promoledger.llm.common import table, unused, with_outputs
from promoledger.llm.decontamination import plain_bytes, word_pieces
from promoledger.session import stage

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: The reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
#: Words worked on in one go, about.
_GROUP = 1 << 16
#: Bytes of a text that are split into words in one go, about.
_PIECE = 1 << 18
#: Lengths up to here have a table of their own; longer ones are made of powers of two of it.
_SHORT = 64
#: Ranges of scores that are ordered each by itself, among those that may be drawn.
_RANGES = 256


def crc_table() -> np.ndarray:
    """CRC register after each single byte, from a register of zero."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> 1) ^ np.where(table & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    return table


class PrefixCrc:
    """Tables that carry CRCs on over a number of bytes, and take the last byte back."""

    def __init__(self):
        self.step = crc_table()
        # The high byte of an entry tells which entry it is.
        self.entry = np.zeros(256, np.uint32)
        self.entry[self.step >> 24] = np.arange(256)
        units = np.uint32(1) << np.arange(32, dtype=np.uint32)
        images = [units]
        for _ in range(_SHORT):
            images.append((images[-1] >> 8) ^ self.step[images[-1] & 0xFF])
        self.short = np.stack([self._tables(i) for i in images[:_SHORT]])
        # doubled[k] carries on over _SHORT * 2**k bytes; applying a map to its own images doubles the length.
        self.doubled = [self._tables(images[_SHORT])]

    @staticmethod
    def _tables(images: np.ndarray) -> np.ndarray:
        """From the images of the 32 unit registers: the images of every value of each of the four bytes."""
        out = np.zeros((4, 256), np.uint32)
        for bit in range(8):
            chosen = (np.arange(256) >> bit & 1).astype(bool)
            for byte in range(4):
                out[byte, chosen] ^= images[8 * byte + bit]
        return out

    @staticmethod
    def _apply(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
        return tables[0][crcs & 0xFF] ^ tables[1][crcs >> 8 & 0xFF] ^ tables[2][crcs >> 16 & 0xFF] ^ tables[3][crcs >> 24]

    def carry_on(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The registers after ``lengths`` further bytes of zero."""
        low, high = lengths % _SHORT, lengths // _SHORT
        flat = self.short.reshape(-1)
        base = (low * 1024).astype(np.int64)
        out = flat[base + (crcs & 0xFF)] ^ flat[base + 256 + (crcs >> 8 & 0xFF)] ^ flat[base + 512 + (crcs >> 16 & 0xFF)] ^ flat[base + 768 + (crcs >> 24)]
        bit = 0
        while (rest := high >> bit).any():
            if bit == len(self.doubled):
                units = np.uint32(1) << np.arange(32, dtype=np.uint32)
                once = self._apply(self.doubled[-1], units)
                self.doubled.append(self._tables(self._apply(self.doubled[-1], once)))
            chosen = (rest & 1).astype(bool)
            out[chosen] = self._apply(self.doubled[bit], out[chosen])
            bit += 1
        return out

    def before_space(self, crcs: np.ndarray) -> np.ndarray:
        """The CRCs as they were before a last byte that was a space."""
        register = crcs ^ np.uint32(0xFFFFFFFF)
        entry = self.entry[register >> 24]
        return (((register ^ self.step[entry]) << np.uint32(8)) | (entry ^ np.uint32(32))) ^ np.uint32(0xFFFFFFFF)

    def features(self, words: list[bytes], fresh: np.ndarray, room: np.ndarray) -> Iterator[np.ndarray]:
        """CRCs of the runs of one, two and three words that end at the words marked ``fresh``.

        ``room`` says how many words of the same text stand before each. One array
        a run length, in the order of the words that end the runs.
        """
        crc, running = zlib.crc32, 0
        after = np.array([running := crc(b" ", crc(w, running)) for w in words], np.uint32)
        ends = self.before_space(after)
        starts = np.concatenate([np.zeros(1, np.uint32), after[:-1]])
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        places = np.concatenate([[0], np.cumsum(sizes)])
        for size in range(1, LONGEST + 1):
            last = np.flatnonzero(fresh & (room >= size - 1))
            first = last - (size - 1)
            yield ends[last] ^ self.carry_on(starts[first], places[last + 1] - 1 - places[first])


def _groups(texts: list[str | None]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """Words of several texts, or of a piece of a long one: (words, row of each, words of its text before it here, whether it is new).

    A piece begins with the last two words of the piece before, which are not new.
    """
    words: list[bytes] = []
    rows, rooms, news = [], [], []
    for row, text in enumerate(texts):
        tail: list[bytes] = []
        for own in word_pieces(plain_bytes(text), _PIECE):
            both = tail + own
            words += both
            rows.append(np.full(len(both), row))
            rooms.append(np.arange(len(both)))
            news.append(np.arange(len(both)) >= len(tail))
            tail = both[1 - LONGEST :]
            if len(words) >= _GROUP:
                yield words, np.concatenate(rows), np.concatenate(rooms), np.concatenate(news)
                words, rows, rooms, news = [], [], [], []
    if words:
        yield words, np.concatenate(rows), np.concatenate(rooms), np.concatenate(news)


def _slices(column: pa.Array, most: int = 512) -> Iterator[tuple[int, list[str | None]]]:
    for at in range(0, len(column), most):
        yield at, column.slice(at, most).to_pylist()


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all whole texts fall into each bucket; a task hands on one count a bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, total = PrefixCrc(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _slices(batch.column(0)):
                for words, _, room, new in _groups(texts):
                    for crcs in tools.features(words, new, room):
                        total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["bucket", "n"])

    found = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of a bucket's smoothed share of the target to that of the source."""
    s, t, size = source.astype(float), target.astype(float), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + size) / ((s + 1) * (t.sum() + size)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_features`` and ``weight``, the sum of the gains of all features."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    outputs = ["n_words", "n_features", "weight"]

    @F.arrow_udf("n_words long, n_features long, weight long")
    def found(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tools, own = PrefixCrc(), sent.value
        for column in columns:
            out = np.zeros((3, len(column)), np.int64)
            for start, texts in _slices(column):
                for words, rows, room, new in _groups(texts):
                    at = rows + start
                    out[0] += np.bincount(at[new], minlength=len(column))
                    for size, crcs in enumerate(tools.features(words, new, room)):
                        ends = at[new & (room >= size)]
                        out[1] += np.bincount(ends, minlength=len(column))
                        # Sums of whole numbers, exact in doubles.
                        out[2] += np.bincount(ends, own[crcs % np.uint32(len(own))], len(column)).astype(np.int64)
            yield pa.StructArray.from_arrays([pa.array(x) for x in out], outputs)

    name = unused(docs, "found")
    marked = docs.withColumn(name, found(F.col(f"`{text_col}`")))
    return marked.select(*with_outputs(docs, outputs), *[F.col(f"{name}.{c}").alias(c) for c in outputs])


def noise(ident: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, id_col: str = "doc_id") -> DataFrame:
    """``scored`` (id, n_words, score and more) with ``rank``: 1, 2, 3... of the drawn rows by score, null elsewhere.

    Scores that may be drawn are cut into ranges at their quantiles, each range is
    ordered by itself, and ranks go on where the range before ends. Equal rows are
    one row with a count until their ranks are dealt. The quantiles only shape the
    ranges: counts and order are exact.
    """
    able = F.coalesce(F.col("n_words") >= least_words, F.lit(False))
    top = min(1.0, 1.1 * percent / 100)
    accuracy = 20 * _RANGES
    steps = [1 - top * i / _RANGES for i in range(1, _RANGES + 1)]
    total, bounds = scored.where(able).agg(F.count(F.lit(1)), F.percentile_approx("score", steps, accuracy)).first()
    wanted = percent * total // 100
    bounds = sorted(set(bounds or []), reverse=True)
    high = F.array(*[F.lit(int(b)).cast("long") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    part = F.when(able, F.size(F.filter(high, lambda b: b > F.col("score"))))
    columns, group, copies = scored.columns, unused(scored, "part"), unused(scored, "copies")
    keyed = scored.withColumn(group, part)
    sizes = {r[group]: r["count"] for r in keyed.where(able).groupBy(group).count().collect()}
    before, starts = 0, {}
    for number in sorted(sizes):
        if before < wanted:
            starts[number] = before
        before += sizes[number]
    chosen = F.coalesce(F.col(group).isin(list(starts)), F.lit(False))
    rest = keyed.where(~chosen).select(*columns, F.lit(None).cast("long").alias("rank"))
    if not starts:
        return rest
    offset = F.element_at(F.create_map(*[F.lit(x).cast(t) for k, v in starts.items() for x, t in ((k, "int"), (v, "long"))]), F.col(group))
    quoted = [f"`{c}`" for c in columns]
    equal = keyed.where(chosen).groupBy(*quoted, group).agg(F.count(F.lit(1)).alias(copies))
    order = Window.partitionBy(group).orderBy(F.desc("score"), F.col(f"`{id_col}`").asc_nulls_last(), *quoted).rowsBetween(Window.unboundedPreceding, -1)
    first = offset + F.coalesce(F.sum(copies).over(order), F.lit(0)) + 1
    dealt = equal.withColumn("rank", first).select(*quoted, F.explode(F.sequence(F.col("rank"), F.col("rank") + F.col(copies) - 1)).alias("rank"))
    return dealt.select(*quoted, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank")).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``docs`` without the text, with ``n_words, n_features, weight, score, rank``."""
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, text_col, buckets))
    weighed = weigh(docs.select(*with_outputs(docs, ["n_words", "n_features", "weight", "score", "rank"])), gain, text_col).drop(text_col)
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col(f"`{id_col}`"), seed))
    rows, _ = stage(scored, "scored")
    return draw(rows, percent, least_words, id_col)


def query(spark, sf_dir: str) -> DataFrame:
    """op12: weight, score and rank of every document, drawn towards the benchmark's distribution."""
    found = resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")

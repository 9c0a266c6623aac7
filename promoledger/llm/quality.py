"""Quality classifier: hashed word n-grams, logistic regression fitted by follow-the-regularised-leader.

A word is a run of letters and digits or a run of other visible characters, so
the marks glued to a word count as a word of their own. Features are hashed
single words, word pairs, and pairs of word shapes (case, digits, marks, "same
as the word before"), each with its share of the document's features as value.
A score is the logistic function of one sparse dot product over the whole text.

Cases: null and empty texts have no feature and get the score of the bias
alone; repeated rows are scored alike; rows without a 0/1 label teach nothing;
without any label every score is 0.5; an input column called like an output
column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.llm.common import fold, hash_share, table, text_groups, with_outputs

#: Weights: 2 to this power.
BITS = 18
#: Bound of the fitting sample: so many labelled documents are expected in it.
SAMPLE_ROWS = 16_384
EPOCHS = 3
THRESHOLD = 0.3
#: Bytes of text, about, that numpy works on at a time; a longer text is cut into words in segments.
_GROUP = 1 << 18
_SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _byte_classes() -> np.ndarray:
    """0 white space, 1 lower case and non-ASCII, 2 upper case, 3 digit, 4 mark."""
    classes = np.full(256, 4, np.uint8)
    classes[[0x20, *range(0x09, 0x0E)]] = 0
    classes[ord("a") : ord("z") + 1] = 1
    classes[0x80:] = 1
    classes[ord("A") : ord("Z") + 1] = 2
    classes[ord("0") : ord("9") + 1] = 3
    return classes


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base & _MASK, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _words(data: np.ndarray, cuts: np.ndarray, tools: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, hash and shape of each word; no word crosses an offset in ``cuts``."""
    classes, powers, inverse = tools
    kind = classes[data]
    group = np.where(kind == 0, 0, np.where(kind == 4, 2, 1)).astype(np.int8)
    edge = np.empty(len(data), bool)
    edge[:1] = True
    edge[1:] = group[1:] != group[:-1]
    edge[cuts[cuts < len(data)]] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], len(data))
    visible = group[starts] != 0
    starts, ends = starts[visible], ends[visible]
    lower = np.where(kind == 2, data + 32, data).astype(np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((lower + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    uppers = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kind == 2, out=uppers[1:])
    upper = uppers[ends] - uppers[starts]
    shape = np.where(upper == 0, 1, np.where((upper > 1) | (ends - starts == 1), 3, 2))
    shape = np.where(group[starts] == 2, 4 + np.minimum(ends - starts, 8), np.where(kind[starts] == 3, 0, shape))
    return starts, hashes, shape


def make_tools() -> tuple:
    size = _SEGMENT + 1
    inverse = pow(_BASE | 1, -1, 1 << 64)
    return _byte_classes(), _powers(_BASE | 1, size), _powers(inverse, size)


def features(data: np.ndarray, offsets: np.ndarray, tools: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of a run of texts, grouped by text, and where each text's begin."""
    starts, hashes, shapes = [], [], []
    for at in range(0, len(data), _SEGMENT):
        part = data[at : at + _SEGMENT]
        inside = offsets[(offsets >= at) & (offsets < at + len(part))] - at
        s, h, p = _words(part, inside, tools)
        starts.append(s + at), hashes.append(h), shapes.append(p)
    none = np.zeros(0, np.int64)
    start = np.concatenate(starts) if starts else none
    word = np.concatenate(hashes) if hashes else none.astype(np.uint64)
    shape = np.concatenate(shapes).astype(np.uint64) if shapes else none.astype(np.uint64)
    text = np.searchsorted(offsets, start, side="right") - 1
    first = np.ones(len(text), bool)
    first[1:] = text[1:] != text[:-1]
    before = np.where(first, np.uint64(1), np.roll(word, 1))
    old_shape = np.where(first, np.uint64(31), np.roll(shape, 1))
    same = (before == word).astype(np.uint64)
    spread = np.uint64(0xD6E8FEB86659FD93)
    pair = (before * np.uint64(0xC2B2AE3D27D4EB4F) + word) * spread
    shaped = ((old_shape * np.uint64(64) + shape * np.uint64(2) + same + np.uint64(1 << 40)) * spread) * np.uint64(0x165667B19E3779F9)
    all_three = np.stack([word * spread, pair, shaped], axis=1).ravel() >> np.uint64(64 - BITS)
    counts = np.bincount(text, minlength=len(offsets) - 1)
    return all_three.astype(np.int64), 3 * np.concatenate([[0], np.cumsum(counts)])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse feature vectors of the sampled documents."""
    tools = make_tools()
    for batch in batches:
        for low, high, data, offsets in text_groups(batch.column("text"), _GROUP):
            numbers, begins = features(data, offsets, tools)
            index, value = [], []
            for i in range(high - low):
                found, count = np.unique(numbers[begins[i] : begins[i + 1]], return_counts=True)
                index.append(found.astype(np.int32))
                value.append((count / max(1, count.sum())).astype(np.float32))
            ends = pa.array(np.cumsum([0, *map(len, index)]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (index, value)]
            rows = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays([rows.column("position"), rows.column("label"), *lists], ["position", "label", "index", "value"])


def ftrl(alpha: float = 3.0, beta: float = 0.1, l1: float = 0.02, l2: float = 0.0):
    """The trainer of one pass over ordered sparse rows; yields the non-zero weights, the bias at -1."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = (1 << BITS) + 1
        z, n = np.zeros(size), np.zeros(size)
        seen = [0, 0]

        def weights(at):
            push = np.sign(z[at]) * l1 - z[at]
            return np.where(np.abs(z[at]) <= l1, 0.0, push / ((beta + np.sqrt(n[at])) / alpha + l2))

        for batch in batches:
            for label, index, value in zip(batch.column("label").to_pylist(), batch.column("index"), batch.column("value"), strict=True):
                at = np.append(index.values.to_numpy(), size - 1)
                x = np.append(value.values.to_numpy(), 0.1).astype(float)
                w = weights(at)
                chance = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
                slope = (chance - label) * x
                sigma = (np.sqrt(n[at] + slope * slope) - np.sqrt(n[at])) / alpha
                z[at] += slope - sigma * w
                n[at] += slope * slope
                seen[label] += 1
        if sum(seen):
            final = weights(np.arange(size))
            kept = np.flatnonzero(final[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(kept, -1).astype(np.int32)), pa.array(np.append(final[kept], 0.1 * final[-1]))], ["index", "weight"]
            )

    return train


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias from about ``sample_rows`` labelled documents at most.

    A label is in the sample if its id's hash falls below a share that the number
    of labels sets. The texts of the sample are joined to that bounded list, turned
    into features where they lie, and passed ``epochs`` times, in order, to one
    task that keeps the weights and one batch.
    """
    usable = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).distinct()
    order = F.xxhash64("id")
    sample = usable.where(hash_share("id") < sample_rows / max(1, usable.count()))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    vectors = rows.select(order.alias("position"), "label", "text").mapInArrow(_sparse, "position long, label int, index array<int>, value array<float>")
    passes = vectors.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    ordered = passes.repartition(1).sortWithinPartitions("epoch", "position", "label", "index", "value").select("label", "index", "value")
    found = ordered.mapInArrow(ftrl(), "index int, weight double").toPandas()
    weights = np.zeros(1 << BITS, np.float32)
    number = found["index"].to_numpy()
    weights[number[number >= 0]] = found["weight"].to_numpy()[number >= 0]
    return weights, float(found["weight"].to_numpy()[number < 0].sum())


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the chance that the label is 1; the weights (1 MB) travel with the function."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def chance(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, bias = sent.value
        tools = make_tools()
        for column in texts:
            scores = np.full(len(column), bias)
            for low, high, data, offsets in text_groups(column, _GROUP):
                numbers, begins = features(data, offsets, tools)
                sums = np.concatenate([[0.0], np.cumsum(weights[numbers], dtype=np.float64)])
                total = np.maximum(1, np.diff(begins))
                scores[low:high] += (sums[begins[1:]] - sums[begins[:-1]]) / total
            yield pa.array(1 / (1 + np.exp(-scores)))

    return docs.select(*with_outputs(docs, [out]), chance(F.col(text_col)).alias(out))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: every document scored by a model that never saw the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 5) != 0)
    model = fit(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

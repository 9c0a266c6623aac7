from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from promoledger.llm import resampling as r
from promoledger.llm.common import table
from tests.llm.data import SMALL, edge_docs, empty_docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % r.BUCKETS for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain_draw(texts, target, percent=r.PERCENT):
    """(id, text) rows -> {row: (n_features, weight, score, rank)}, spelling every feature out."""
    features = [plain_features(t) for _, t in texts]
    s, t = Counter(b for _, f in features for b in f), Counter(b for x in target for b in plain_features(x)[1])
    size, total = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (size + r.BUCKETS) / ((s[b] + 1) * (total + r.BUCKETS)))) for b in s}
    out = []
    for (ident, _), (words, own) in zip(texts, features, strict=True):
        h = int(hashlib.sha256(f"42:{'' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        out.append([ident, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((row for row in out if row[5] >= r.LEAST_WORDS), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(x[:5]) for x in out), key=str)


@pytest.mark.parametrize("piece", [1 << 18, 9])
def test_prefix_crcs_equal_crcs_of_the_spelled_features(monkeypatch, piece):
    monkeypatch.setattr(r, "_PIECE", piece)
    monkeypatch.setattr(r, "_GROUP", 50)
    rng = np.random.default_rng(5)
    texts = [" ".join("xé漢😀"[k % 4] * int(n) for k, n in enumerate(rng.integers(1, 5, m))) for m in rng.integers(0, 40, 30)]
    texts += [None, "", "one", "ONE two", "a" * 700 + " " + "b" * 70_000 + " c", "x" * 63 + " " + "y" * 64 + " " + "z" * 65]
    tools, found, words_of = r.PrefixCrc(), [Counter() for _ in texts], np.zeros(len(texts), int)
    for words, rows, room, new in r._groups(texts):
        words_of += np.bincount(rows[new], minlength=len(texts))
        for size, crcs in enumerate(tools.features(words, new, room)):
            for row, crc in zip(rows[new & (room >= size)], crcs, strict=True):
                found[row][int(crc) % r.BUCKETS] += 1
    for text, own, n in zip(texts, found, words_of, strict=True):
        want = plain_features(text)
        assert (n, own) == (want[0], Counter(want[1]))


def test_query_equals_a_plain_version(spark):
    texts = [(x["doc_id"], x["text"]) for x in table(spark, SMALL, "documents").collect()]
    target = [x["text"] for x in table(spark, SMALL, "benchmark").collect()]
    rows = r.query(spark, SMALL).collect()
    assert sorted(map(tuple, rows), key=str) == plain_draw(texts, target)
    assert sum(x["rank"] is not None for x in rows) == r.PERCENT * sum(plain_features(t)[0] >= r.LEAST_WORDS for _, t in texts) // 100


def test_edges(spark):
    docs = edge_docs(spark).withColumnRenamed("host", "Weight").withColumnRenamed("fp", "part")
    target = [None, "", "the cat sat on the mat", "the dog"]
    texts = [(x["doc_id"], x["text"]) for x in docs.collect()]
    found = r.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent=60, least_words=10)
    assert "part" in found.columns and "text" not in found.columns
    want = plain_draw(texts, target)
    rows = found.collect()
    assert sorted(((x["doc_id"], x["n_features"], x["weight"], x["score"]) for x in rows), key=str) == [w[:4] for w in want]
    able = [x for x in rows if x["n_words"] >= 10]
    drawn = sorted((x for x in able if x["rank"] is not None), key=lambda x: x["rank"])
    assert [x["rank"] for x in drawn] == list(range(1, 60 * len(able) // 100 + 1))
    assert min(x["score"] for x in drawn) >= max((x["score"] for x in able if x["rank"] is None), default=-(1 << 60))
    assert all(x["rank"] is None for x in rows if x["n_words"] < 10)
    assert r.resample(empty_docs(spark), spark.createDataFrame([], "text string")).count() == 0
    assert r.resample(docs, spark.createDataFrame([], "text string")).count() == 12


@pytest.mark.parametrize("percent", [0, 5, 37, 100])
def test_ranks_of_many_ties(spark, percent):
    rows = [(None if i % 17 == 0 else i % 400, 20 + i % 3 - (i % 11 == 0) * 10, (i * i) % 23) for i in range(3000)] + [(5, 30, 22)] * 1500
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, score long")
    out = r.draw(scored, percent).collect()
    assert sorted((x["doc_id"], x["n_words"], x["score"]) for x in out if x["doc_id"] is not None) == sorted(x for x in rows if x[0] is not None)
    able = sorted((x for x in rows if x[1] >= 20), key=lambda x: (-x[2], x[0] is None, x[0] or 0))
    drawn = sorted((x for x in out if x["rank"] is not None), key=lambda x: x["rank"])
    assert [x["rank"] for x in drawn] == list(range(1, percent * len(able) // 100 + 1))
    assert [(x["score"], x["doc_id"]) for x in drawn] == [(x[2], x[0]) for x in able[: len(drawn)]]

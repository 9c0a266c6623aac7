from __future__ import annotations

import hashlib
import random
import re

import pytest

from promoledger.llm import decontamination as d
from promoledger.llm.common import table
from tests.llm.data import SMALL, edge_docs, empty_docs

UPPER = re.compile("[A-Z]")
ITEMS = "item_id long, text string, n_words int"


def plain_words(text):
    return [(m[0], m.start(), m.end()) for m in re.finditer(d.WORD, UPPER.sub(lambda m: m[0].lower(), text or ""))]


def plain_hits(text, items, size=d.WINDOW):
    """Words, hit words and items of one text, by comparing every place with every window."""
    words = [w for w, _, _ in plain_words(text)]
    hit, found = set(), set()
    for name, item in items:
        own = [w for w, _, _ in plain_words(item)]
        for i in range(max(1, len(own) - size + 1) if own else 0):
            window = own[i : i + size]
            for at in range(len(words) - len(window) + 1):
                if words[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    if name is not None:
                        found.add(str(name))
    return len(words), hit, sorted(found)


def check(rows, texts, items, size=d.WINDOW):
    """rows: (id, n_words, hits, items) against the plain version; spans point into the original text."""
    for ident, n_words, hits, found in rows:
        want = plain_hits(texts[ident], items, size)
        got = {w for h in hits for w in range(h["first"], h["first"] + h["words"])}
        assert (n_words, got, found) == want, ident
        words = plain_words(texts[ident])
        for h in hits:
            assert (h["begin"], h["end"]) == (words[h["first"]][1], words[h["first"] + h["words"] - 1][2])


def made_texts(seed=3):
    rng = random.Random(seed)
    letters = ["a", "bb", "C", "é", "漢字", "x9", "😀", "Zz"]
    text = lambda n: "".join(rng.choice(letters) + rng.choice([" ", ", ", "\n", "-", "\x00", ".  "]) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 6, 9]))) for i in range(12)] + [(None, "bb C é"), (3, "x9 Zz a"), (40, None), (41, " ,. "), (5, "bb c É")]
    return {i: text(rng.randrange(0, 120)) for i in range(40)} | {900: None, 901: "", 902: " \n"}, items


@pytest.mark.parametrize(("limit", "piece"), [(d.LIMIT, 1 << 20), (60, 1 << 20), (d.LIMIT, 7)])
def test_hits_equal_a_plain_search(spark, monkeypatch, limit, piece):
    monkeypatch.setattr(d, "_PIECE", piece)
    monkeypatch.setattr(d.word_pieces, "__defaults__", (piece,))
    texts, items = made_texts()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = d.find_hits(docs, spark.createDataFrame([(*i, 1) for i in items], ITEMS), size=4, limit=limit)
    rows = [(r["doc_id"], r["n_words"], r["hits"], r["items"]) for r in found.collect()]
    assert len(rows) == len(texts) and any(r[2] for r in rows)
    check(rows, texts, items, size=4)


def test_query_equals_a_plain_search(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}
    items = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    rows = d.query(spark, SMALL).collect()
    assert len(rows) == len(texts) and any(r["contaminated"] for r in rows) and not all(r["contaminated"] for r in rows)
    windows = {tuple(w[i : i + d.WINDOW]) for _, t in items for w in [[x for x, _, _ in plain_words(t)]] for i in range(max(1, len(w) - d.WINDOW + 1))}
    for r in rows:
        words = [w for w, _, _ in plain_words(texts[r["doc_id"]])]
        if not any(tuple(words[i : i + d.WINDOW]) in windows for i in range(len(words))):
            want = (len(words), set(), [])
        else:
            want = plain_hits(texts[r["doc_id"]], items)
        digest = hashlib.sha256(",".join(want[2]).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (want[0], len(want[1]), len(want[2]), digest, bool(want[1]))


def test_edges(spark):
    items = spark.createDataFrame([(7, "the CAT sat on the mat and the dog ran off to the sea", 0), (8, "12 34", 0), (8, "12 34", 0), (9, None, 0)], ITEMS)
    docs = edge_docs(spark).withColumnRenamed("n", "Items").withColumnRenamed("score", "found")
    out = d.find_hits(docs, items)
    assert out.columns == [c for c in docs.columns if c != "Items"] + d.OUTPUTS
    rows = out.collect()
    assert len(rows) == 12
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[1]["items"] == ["7"] and by[2]["hits"][0]["words"] == 14 and by[7]["items"] == ["8"]
    assert all(by[i]["n_words"] == 0 and not by[i]["hits"] and by[i]["items"] == [] for i in (3, 4, 5, 8)) and by[6]["n_words"] == 150_000 and by[9]["n_words"] == 5
    assert d.find_hits(docs, items.limit(0)).where("size(hits) > 0 or size(items) > 0").count() == 0
    assert d.find_hits(empty_docs(spark), items).count() == 0

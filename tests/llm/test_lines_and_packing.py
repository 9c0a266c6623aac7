from __future__ import annotations

import itertools

import pytest

from check_queries import normalise
from promoledger.llm import line_dedup, packing
from tests.llm.data import SMALL, edge_docs, empty_docs, oracle, write_tables


@pytest.mark.parametrize("module", [line_dedup, packing])
def test_equals_sql(spark, module):
    assert normalise(module.query(spark, SMALL).toPandas()) == normalise(oracle(module.SQL))


def test_line_dedup_edges_equal_sql(spark, tmp_path):
    lines = spark.createDataFrame(
        [(i, f"header\n\nown {i}\nheader \n", None if i % 2 else "a") for i in range(12)] + [(50, None, "a"), (51, "", "a"), (52, "header", "b"), (53, "header", "b")],
        "doc_id long, text string, source string",
    )
    folder = write_tables(spark, tmp_path, documents=lines)
    found = line_dedup.query(spark, folder).toPandas()
    assert normalise(found) == normalise(oracle(line_dedup.SQL, folder))
    kept = dict(zip(found.doc_id, found.text, strict=True))
    assert kept[0] == "\nown 0\n" and kept[1] == "\nown 1\n" and kept[52] == "header" and kept[50] is None


def test_line_dedup_keeps_columns_and_empty_tables(spark):
    found = line_dedup.drop_boilerplate(edge_docs(spark), dropped_col="n")
    assert set(found.columns) == set(edge_docs(spark).columns) and found.count() == edge_docs(spark).count()
    assert line_dedup.drop_boilerplate(empty_docs(spark)).count() == 0


def test_line_dedup_is_native(spark):
    plan = line_dedup.query(spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def waste(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= length) - length) for length, n in histogram.items())


@pytest.mark.parametrize("seed", range(6))
def test_bounds_are_optimal(seed):
    import random

    rng = random.Random(seed)
    histogram = {x: rng.randint(1, 9) for x in rng.sample(range(1, 40), 9)}
    for buckets in (1, 2, 3, 12):
        bounds = packing.optimal_bounds(histogram, buckets)
        lengths = sorted(histogram)
        choices = [c for k in range(1, min(buckets, 9) + 1) for c in itertools.combinations(lengths, k) if c[-1] == lengths[-1]]
        assert len(bounds) <= buckets and waste(histogram, bounds) == min(waste(histogram, c) for c in choices)
    assert packing.optimal_bounds({}, 3) == []


def test_packing_edges(spark):
    docs = edge_docs(spark)
    rows = packing.pack(docs, max_tokens=100, buckets=3, budget=400).collect()
    per_doc = {}
    for r in rows:
        per_doc.setdefault(r["doc_id"], []).append(r)
    assert sum(r["length"] for r in per_doc[6]) == 150_000 and len(per_doc[6]) == 1500
    assert len(per_doc[2]) == 2 and all(r["length"] == 0 and r["bucket"] is None for i in (3, 4, 5) for r in per_doc[i])
    filled = [r for r in rows if r["length"]]
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in filled}) == len(filled)
    for r in filled:
        assert r["length"] <= r["bucket"] and r["slot"] < max(1, 400 // r["bucket"])
    for bucket in {r["bucket"] for r in filled}:
        own = [r for r in filled if r["bucket"] == bucket]
        assert max(r["batch"] for r in own) == (len(own) - 1) // max(1, 400 // bucket)
    assert packing.pack(empty_docs(spark)).count() == 0


def test_packing_by_more_slices_is_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = sorted(map(tuple, packing.pack(docs).collect()), key=str)
    monkeypatch.setattr(packing, "SLICE", 3)
    assert sorted(map(tuple, packing.pack(docs).collect()), key=str) == before

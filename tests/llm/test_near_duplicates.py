from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from promoledger.llm import forest, multi_index, simhash
from promoledger.llm.common import table
from promoledger.llm.components import connected_components
from tests.llm.data import SMALL, edge_docs, empty_docs

VECTORS = "vec_id long, embedding array<float>, label int, size int, node string, tree string, score string, rank int"


def least_reachable(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components_of_chains_stars_and_random_links(spark):
    rng = np.random.default_rng(2)
    pairs = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(1079, 1001)]
    pairs += [(int(a), int(b)) for a, b in rng.integers(2000, 2200, (120, 2))]
    pairs += [(5, 5), (3001, 3000), (3000, 3001)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect()}
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert found == least_reachable(pairs, linked)
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def plain_fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_simhash(rows, texts):
    """rows: (doc_id, fingerprint, component_id); texts by id."""
    values = {i: plain_fingerprint(t) for i, t in texts.items()}
    pairs = [(a, b) for a, b in combinations(values, 2) if (values[a] ^ values[b]).bit_count() <= 3]
    components = least_reachable(pairs, values)
    for i, fp, component in rows:
        assert fp == f"{values[i]:016x}" and component == components[i]


def test_simhash_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SMALL, "documents").collect()}
    base = " ".join(f"w{i}" for i in range(400))
    extra = {10_000 + k: base.replace(f"w{k * 7} ", "changed ") for k in range(12)} | {20_000: "", 20_001: None, 20_002: " ", 20_003: "One", 20_004: "one", 20_005: "One TWO"}
    rows = table(spark, SMALL, "documents").select("doc_id", "text").unionByName(spark.createDataFrame(list(extra.items()), "doc_id long, text string"))
    found = simhash.near_duplicates(rows)
    out = found.select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component").collect()
    assert len(out) == len(texts) + len(extra)
    check_simhash([tuple(r) for r in out], texts | extra)
    assert len({r["component"] for r in out if 10_000 <= r["id"] < 20_000}) < 12


@pytest.mark.parametrize("large", [3, 4096])
def test_links_join_all_that_three_bits_part(spark, monkeypatch, large):
    """Also with keys that count as large, whose rows are dealt out again."""
    monkeypatch.setattr(simhash, "LARGE", large)
    rng = np.random.default_rng(9)
    centre = rng.integers(-(2**62), 2**62, 8)
    values = set(centre.tolist())
    for c in centre.tolist():
        for _ in range(40):
            bits = rng.choice(64, rng.integers(1, 6), replace=False)
            flipped = (c & (2**64 - 1)) ^ sum(1 << int(b) for b in bits)
            values.add(flipped - (1 << 64) if flipped >> 63 else flipped)
    values = sorted(values)
    links = simhash.link_distinct(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    unsigned = [v & (2**64 - 1) for v in values]
    want = least_reachable([(values[i], values[j]) for i, j in combinations(range(len(values)), 2) if (unsigned[i] ^ unsigned[j]).bit_count() <= 3], values)
    assert least_reachable([(r["src"], r["dst"]) for r in links], values) == want
    assert len(links) < 20 * len(values)


def test_a_hot_key_is_dealt_by_the_bits_it_leaves_open(spark):
    """Fingerprints that agree on three blocks: each part of the others spreads them, and close ones meet in one."""
    rng = np.random.default_rng(4)
    low = sum(simhash.BLOCKS[:3])
    values = np.unique(rng.integers(0, 1 << 31, 5000) << low) | 5
    near = np.unique(values[:300] ^ (np.int64(1) << (low + rng.integers(0, 31, 300))) ^ (np.int64(1) << (low + rng.integers(0, 31, 300))))
    rows = spark.createDataFrame([(int(v),) for v in np.unique(np.concatenate([values, near]))], "fp long")
    parts = rows.select(F.explode(simhash.part_keys(F.col("fp"), F.lit(0))).alias("part"))
    sizes = parts.groupBy("part.at", "part.bits").count()
    # Four parts of seven or eight bits: hundreds of groups, none of a large share of the rows.
    assert sizes.count() > 500 and sizes.agg(F.max("count")).first()[0] < 0.05 * rows.count()
    codes = {r["fp"]: {(p["at"], p["bits"]) for p in r["parts"]} for r in rows.select("fp", simhash.part_keys(F.col("fp"), F.lit(0)).alias("parts")).collect()}
    pairs = [(a, b) for a in near.tolist() for b in values.tolist() if 0 < ((a ^ b) & (2**64 - 1)).bit_count() <= 3]
    assert len(pairs) >= 250 and all(codes[a] & codes[b] for a, b in pairs)


def test_simhash_edges(spark):
    rows = simhash.near_duplicates(edge_docs(spark)).collect()
    assert len(rows) == edge_docs(spark).count()
    by_id = {r["id"]: r["component"] for r in rows if r["id"] is not None}
    assert by_id[3] == by_id[4] == by_id[5] == 3 and by_id[1] == by_id[2] == 1
    assert simhash.near_duplicates(empty_docs(spark)).count() == 0


def vectors(spark, size=16, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((30, size))
    near = np.concatenate([c + 0.17 * rng.standard_normal((20, size)) for c in centres])
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(np.concatenate([near, rng.standard_normal((300, size))]))]
    rows += [(2000 + i, rows[5][1]) for i in range(40)] + [(2100, [float(np.float32(3 * x)) for x in rows[5][1]]), (2000, rows[5][1])]
    odd = [None, [], [0.0] * size, [None] + [1.0] * (size - 1), [float("nan")] * size, [float("inf")] * size, [1.0, 2.0], [1.0, 2.0]]
    rows += [(3000 + i, v) for i, v in enumerate(odd)] + [(None, rows[5][1])]
    return spark.createDataFrame([(i, v, None, 1, "n", "t", "s", 1) for i, v in rows], VECTORS), rows


def usable(rows):
    return [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]


@pytest.mark.parametrize("settings", [{}, {"leaf": 40, "trees": 12}])
def test_forest_equals_brute_force(spark, monkeypatch, settings):
    """With one leaf, and with splits in several rounds."""
    if settings:
        monkeypatch.setattr(forest, "FIRST_LEVELS", 1)
        monkeypatch.setattr(forest, "MORE_LEVELS", 2)
    df, rows = vectors(spark)
    found = forest.near_duplicates(df, **settings).collect()
    assert len(found) == len(rows)
    good = usable(rows)
    linked = [[j for j, (_, w) in enumerate(good) if j != i and len(w) == len(v) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.9] for i, (_, v) in enumerate(good)]
    components = least_reachable([(good[i][0], good[j][0]) for i, js in enumerate(linked) for j in js], {i for i, _ in good})
    degrees = dict(zip([i for i, _ in good], map(len, linked), strict=True))
    wrong = 0
    for r in found:
        if r["id"] in components:
            wrong += r["n_links"] != degrees[r["id"]] or r["component"] != components[r["id"]]
            assert r["n_links"] <= degrees[r["id"]]
        else:
            assert r["n_links"] == 0 and r["component"] == r["id"]
    assert wrong == 0 if not settings else wrong < 0.05 * len(found)


def test_unsplittable_leaves_are_compared_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(forest, "MOST_ROUNDS", 1)
    monkeypatch.setattr(forest, "CHUNK", 7)
    rows = [(i, [float(i + 1), 0.0, 0.0]) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = forest.near_duplicates(df, leaf=5, trees=2).collect()
    assert {(r["n_links"], r["component"]) for r in found} == {(89, 0)}


def test_forest_of_nothing(spark):
    df, _ = vectors(spark)
    assert forest.near_duplicates(df.limit(0)).count() == 0


def test_index_equals_brute_force_when_all_cells_are_seen(spark):
    df, rows = vectors(spark)
    found = multi_index.search(df, (F.col("vec_id") % 20 == 0) | (F.col("vec_id") == 3006), share=1.0).collect()
    good = dict(usable(rows))
    want = {}
    for q in good:
        if q % 20 == 0 or q == 3006:
            # Vectors of each length are searched among their own.
            scores = sorted(((-(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q])))
            if scores:
                want[q] = scores[:20]
    assert len({len(good[q]) for q in want}) > 1
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert set(got) == set(want)
    for q, best in want.items():
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in best], rtol=0, atol=1e-9)
        assert len({i for _, i in got[q]} & {i for _, i in best}) >= len(best) - 1
    # Copies come in the order of their ids.
    for q in got:
        copies = [i for _, i in got[q] if 2000 <= i < 2040]
        assert copies == sorted(copies)


def recall(found, ids, matrix, nearest=20):
    """Share of the true neighbours of the queries that were found, by brute force."""
    queries = np.flatnonzero(ids % 20 == 0)
    scores = matrix[queries] @ matrix.T
    scores[np.arange(len(queries)), queries] = -np.inf
    by_query = {}
    for r in found:
        by_query.setdefault(r["query_id"], set()).add(r["vec_id"])
    true = np.argpartition(-scores, nearest, axis=1)[:, :nearest]
    return sum(len(by_query[ids[q]] & set(ids[t].tolist())) for q, t in zip(queries, true, strict=True)) / (nearest * len(queries))


def test_index_recall_as_the_query_is_set(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings")
    data = rows.toPandas()
    found = multi_index.query(spark, "/root/testdata/sf0.1").collect()
    assert recall(found, data.vec_id.to_numpy(), np.stack(data.embedding).astype(float)) >= 0.9


@pytest.mark.parametrize("clusters", [0, 300])
def test_index_recall_on_twenty_thousand_vectors(spark, monkeypatch, clusters):
    """Vectors without structure, and vectors in clusters, of which a small share of the table is enough."""
    rng = np.random.default_rng(11)
    matrix = rng.standard_normal((20_000, 32))
    if clusters:
        matrix = 3 * rng.standard_normal((clusters, 32))[rng.integers(0, clusters, 20_000)] + 0.5 * matrix
    ids = np.arange(20_000) * 3
    rows = spark.createDataFrame(pa.table({"vec_id": ids, "embedding": pa.FixedSizeListArray.from_arrays(matrix.ravel(), 32).cast(pa.list_(pa.float64()))}))
    budgets = []
    real = multi_index.calibrated
    monkeypatch.setattr(multi_index, "calibrated", lambda *a, **k: budgets.append(real(*a, **k)) or budgets[-1])
    found = multi_index.search(rows, F.col("vec_id") % 20 == 0).collect()
    assert recall(found, ids, matrix) >= 0.9
    assert len(budgets) == 1 and (0.02 * 20_000 > budgets[0] if clusters else budgets[0] < 0.9 * 20_000)


def test_a_walk_has_met_what_stands_before_a_cell():
    rng = np.random.default_rng(3)
    model = (rng.standard_normal((5, 2)), rng.standard_normal((6, 2)))
    query, held = rng.standard_normal(4), rng.integers(0, 4, 30)
    cells = np.array(multi_index.nearest_cells(query, model, held, 10**6))
    assert multi_index.walked(query, model, held, cells).tolist() == np.cumsum(held[cells]).tolist()


def test_cells_come_in_order_of_summed_distance():
    rng = np.random.default_rng(8)
    model = (rng.standard_normal((7, 4)), rng.standard_normal((9, 4)))
    query, held = rng.standard_normal(8), rng.integers(0, 4, 63)
    cells = multi_index.nearest_cells(query, model, held, 10**6)
    distance = lambda c: -(model[0][c // 9] @ query[:4] + model[1][c % 9] @ query[4:])
    assert sorted(cells) == np.flatnonzero(held).tolist()
    assert all(distance(a) <= distance(b) + 1e-12 for a, b in zip(cells, cells[1:]))
    some = multi_index.nearest_cells(query, model, held, 20)
    assert some == cells[: len(some)] and held[some].sum() >= 20 > held[some[:-1]].sum()


def test_index_edges(spark):
    df, _ = vectors(spark)
    assert multi_index.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in multi_index.search(two, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 4.0)]

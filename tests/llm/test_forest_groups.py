from __future__ import annotations

import numpy as np

from promoledger.llm import forest


def rows_of(vectors, first=0):
    return [(first + i, v.astype(np.float64).tolist()) for i, v in enumerate(vectors)]


def true_links(vectors, least=0.9):
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return (units @ units.T >= least).sum(axis=1) - 1


def test_links_of_a_dense_group_far_over_a_leaf_are_all_counted(spark):
    """A group of 30 leaves in three times as many rows, and one that is small in the table but large in a node."""
    rng = np.random.default_rng(11)
    for group, others in ((1200, 2400), (300, 5700)):
        near = rng.standard_normal(32) + 0.2 * rng.standard_normal((group, 32))
        vectors = np.concatenate([near, rng.standard_normal((others, 32))])
        df = spark.createDataFrame(rows_of(vectors), "vec_id long, embedding array<double>")
        found = dict(forest.near_duplicates(df, leaf=40).select("id", "n_links").collect())
        want = true_links(vectors)
        got = np.array([found[i] for i in range(len(vectors))])
        assert (got == want).all() if others < 3000 else got.sum() >= 0.99 * want.sum()


def test_a_rare_length_is_not_cut_by_the_count_of_another(spark):
    rng = np.random.default_rng(12)
    common = rng.standard_normal((3000, 16))
    half = rng.standard_normal((20, 8))
    rare = np.concatenate([half, half + 0.1 * rng.standard_normal((20, 8))])
    df = spark.createDataFrame(rows_of(common) + rows_of(rare, 10_000), "vec_id long, embedding array<double>")
    found = dict(forest.near_duplicates(df, leaf=40).select("id", "n_links").collect())
    assert [found[10_000 + i] for i in range(40)] == true_links(rare).tolist() and true_links(rare).sum() >= 40


def test_a_third_of_a_large_table_is_peeled_off_and_the_rest_is_split(spark, monkeypatch):
    """Links of the peeled groups are exact, among themselves and to rows around them, and what is written grows with the rows."""
    rng = np.random.default_rng(13)
    one, two = rng.standard_normal(24), rng.standard_normal(24)
    vectors = np.concatenate([one + 0.2 * rng.standard_normal((6600, 24)), two + 0.28 * rng.standard_normal((900, 24)), one + 0.45 * rng.standard_normal((300, 24)), rng.standard_normal((12_200, 24))])
    rows = [(i, v) for i, v in rows_of(vectors)] + [(50_000, vectors[3].tolist()), (50_001, vectors[19_000].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)
    seen = {}
    real = forest.peeled

    def watched(values, scratch, *more):
        left, linked = real(values, scratch, *more)
        seen.update(left=left.count(), linked=linked.count())
        trees = forest.leaves(left, leaf=256)
        seen["nodes"] = trees.select("tree", "node").distinct().count()
        return left, linked

    monkeypatch.setattr(forest, "peeled", watched)
    found = {r["id"]: r for r in forest.near_duplicates(df, leaf=256).collect()}
    whole = np.concatenate([vectors, vectors[[3, 19_000]]])
    want = np.concatenate([near_counts(whole, a, 4000) for a in range(0, len(whole), 4000)])
    got = np.array([found[i]["n_links"] for i, _ in rows])
    assert (got[:6600] == want[:6600]).all() and found[50_000]["n_links"] == want[-2]
    assert (got <= want).all() and got.sum() >= 0.999 * want.sum()
    assert len({found[i]["component"] for i in range(6600)}) == 1 and found[50_000]["component"] == found[3]["component"]
    # The group has left, the forest has split the rest, and there are a few rows for each of the group, not its pairs.
    assert seen["left"] < 14_000 and seen["nodes"] > 300 and seen["linked"] < 30 * len(rows)


def near_counts(vectors, at, size, least=0.9):
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return (units[at : at + size] @ units.T >= least).sum(axis=1) - 1


def test_spanning_links_of_two_sides():
    near = np.array([[1, 0, 0], [1, 1, 0], [0, 0, 0]], bool)
    assert forest.spanning(near).tolist() == [0, 0, 2, 0, 0, 5]

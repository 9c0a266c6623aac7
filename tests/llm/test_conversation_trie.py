from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from promoledger.llm import conversation_trie as c
from promoledger.llm.common import Scratch, table
from tests.llm.data import SMALL, oracle, write_tables

TURNS = "conv_id long, turn long, role string, text string, depth string, rep int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_rebuild(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    whole = {k: [(r, t) for _, _, r, t in sorted(v)] for k, v in turns.items()}
    out = {}
    for k, own in whole.items():
        h = zlib.crc32(str(k).encode()) % 9
        out[k] = whole.get(k - int(np.fmod(k, 5)), [])[:h] + own[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for k, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(k)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in sorted(members, key=len, reverse=True):
        leaves[path] += not children[path]
        saved[path] += (len(members[path]) - 1) * (len(path[-1][1].encode()) if path else 0)
        if path:
            leaves[path[:-1]] += leaves[path]
            saved[path[:-1]] += saved[path]
    out = []
    for path, own in members.items():
        ends = ",".join(str(k) for k in sorted(own) if len(convs[k]) == len(path))
        up = min(members[path[:-1]]) if path else None
        out.append((min(own), len(path), up, len(own), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, local=c.LOCAL):
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS)
    scratch = Scratch(spark)
    nodes = c.rollup(c.rebuild(turns, scratch), scratch, local)
    return sorted(map(tuple, nodes.selectExpr("rep", "depth", "up", *COLUMNS[3:]).collect()), key=str)


def made_rows(seed=1):
    """Families that begin alike, ties, repeated rows, nulls, negative ids, a long conversation and one shared by many."""
    rng = random.Random(seed)
    rows = []
    for conv in [*range(-6, 40), 10**15, 2**60 + 3]:
        for turn in range(rng.randrange(1, 7)):
            rows.append((conv, turn, rng.choice(["u", "a"]), rng.choice(["hé", "yo", "x", None, ""])))
    for conv in range(100, 160):
        rows += [(conv, t, "u", f"t{t}") for t in range(12)]
    rows += [(200, t, "u", f"long {t}") for t in range(300)]
    rows += [(None, 1, "u", "no"), (7, None, None, None), (7, None, "a", "b"), (8, 0, "u", "x"), (8, 0, "u", "x"), (300, 0, "u", "only")]
    return rows


@pytest.mark.parametrize("local", [1, 20, 4096])
def test_trie_equals_a_plain_version(spark, monkeypatch, local):
    monkeypatch.setattr(c, "RANGES", 7)
    rows = made_rows()
    if local == 1:  # centroids down to single nodes, over fewer of them
        rows = [r for r in rows if r[0] is None or r[0] < 12 or (r[0] == 200 and r[1] < 30)]
    assert found(spark, rows, local) == plain_trie(plain_rebuild(rows))


def test_query_equals_a_plain_version_and_sql(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table(spark, SMALL, "conversations").collect()]
    got = sorted((tuple(r[x] for x in COLUMNS) for r in c.query(spark, SMALL).collect()), key=str)
    assert got == plain_trie(plain_rebuild(rows))
    want = oracle(c.SQL)
    assert got == sorted((tuple(v if isinstance(v, str) else None if pd.isna(v) else int(v) for v in r) for r in want[COLUMNS].itertuples(index=False)), key=str)


def test_empty_table_has_no_node(spark, tmp_path):
    folder = write_tables(spark, tmp_path, conversations=spark.createDataFrame([(None, 1, "u", "x", "y", 1)], TURNS))
    assert c.query(spark, folder).count() == 0
    assert c.query(spark, write_tables(spark, tmp_path / "none", conversations=spark.createDataFrame([], TURNS))).count() == 0


def test_centroids_of_chains_stars_and_random_trees():
    rng = np.random.default_rng(2)
    chain = np.arange(-1, 499)
    star = np.array([-1] + [0] * 300)
    wild = np.array([-1] + [int(rng.integers(max(0, i - 20), i)) for i in range(1, 400)])
    for parents in (chain, star, wild, np.array([-1])):
        depth = np.zeros(len(parents), int)
        for i, p in enumerate(parents[1:], 1):
            depth[i] = depth[p] + 1
        order = np.argsort(depth, kind="stable")
        number = np.empty(len(order), int)
        number[order] = np.arange(len(order))
        ups = np.array([-1 if parents[v] < 0 else number[parents[v]] for v in order])
        own, values = rng.integers(1, 5, len(ups)), rng.integers(0, 9, (len(ups), 2))
        sizes, want = own.copy(), values.copy()
        for v in range(len(ups) - 1, 0, -1):
            sizes[ups[v]] += sizes[v]
            want[ups[v]] += want[v]
        assert (c.split(ups, sizes, values) == want).all()

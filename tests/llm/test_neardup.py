from __future__ import annotations

from collections import defaultdict
from math import comb

import numpy as np

from tests.llm.frames import documents, empty, odd
from waitlens.llm import neardup
from waitlens.llm.common import Scratch
from waitlens.llm.components import components
from waitlens.llm.queries import REGISTRY


def brute(rows, k, threshold=0.8):
    """(set size, smallest id reached) by comparing all documents that share a shingle."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            inverted[x].append(i)
    pairs = {(a, b) for held in inverted.values() for a in held for b in held if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if common >= threshold * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_agrees_with_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = result(REGISTRY["op9_near_duplicates"].run(spark, sf))
    assert got == brute([(r.doc_id, r.text) for r in documents(spark, sf).collect()], 4)


def family(n=700, words=60, seed=3):
    """One large group of near copies in a chain of edits, and unrelated texts."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 5000, words)]
    rows = []
    for i in range(n):
        copy = list(base)
        for at in rng.integers(0, words, rng.integers(0, 3)):
            copy[at] = f"x{rng.integers(0, 10**6)}"
        rows.append((i, " ".join(copy)))
    for i in range(n, n + 60):
        rows.append((i, " ".join([*base[:20], *(f"y{j}" for j in rng.integers(0, 10**6, 40))])))
    return rows


def test_large_group_of_near_copies(spark):
    rows = family()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(neardup.near_duplicates(df, shingle=4)) == brute(rows, 4)


def test_nodes_too_large_to_split_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", 4)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rows = family(160, seed=5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(neardup.near_duplicates(df, shingle=4)) == brute(rows, 4)


def test_odd_rows(spark):
    got = neardup.near_duplicates(odd(spark)).collect()
    by = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in got}
    assert len(got) == 9
    assert by[(1, 6)] == (1, True) and by[(2, 0)] == (2, True) and by[(3, 0)] == (3, True)
    assert by[(None, 1)] == (None, True)
    assert [r.component_id for r in got if r.doc_id in (5, 6)] == [5, 5]
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_components_of_a_path_and_a_cycle(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (102, 100), (7, 7), (2, 1)]
    df = spark.createDataFrame(links, "u long, v long")
    found = {r.vertex: r.root for r in components(df, Scratch(spark, "test")).collect()}
    assert found == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in (100, 101, 102)}}
    none = spark.createDataFrame([], "u long, v long")
    assert components(none, Scratch(spark, "test")).count() == 0


def test_signature_hardly_ever_hides_a_pair_at_the_threshold():
    n, p = neardup.COORDINATES, 0.8 + 0.2 / 256
    low = np.zeros((n + 1, n), np.uint8)
    for k in range(n + 1):
        low[k, k:] = 1
    estimates = neardup._agree(low, np.full(n + 1, n), np.arange(n + 1))
    missed = sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1) if estimates[k] < 0.8 - neardup.SLACK)
    assert missed < 1e-6


def test_pairs_within():
    left, right = neardup.pairs_within(np.array([3, 1, 2]))
    assert list(zip(left.tolist(), right.tolist(), strict=True)) == [(0, 1), (0, 2), (1, 2), (4, 5)]

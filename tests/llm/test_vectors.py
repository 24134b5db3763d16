from __future__ import annotations

import numpy as np
import pytest

from tests.compare import compare, connect
from tests.llm.frames import SF
from waitlens.llm import vectors
from waitlens.llm.queries import REGISTRY

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    ids = [r[0] for r in rows]
    v = np.array([r[1] for r in rows], np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    linked = (v @ v.T >= threshold) & (np.array([r[2] for r in rows])[:, None] == np.array([r[2] for r in rows])[None, :])
    np.fill_diagonal(linked, False)
    root = np.array(ids)
    while True:
        low = np.minimum(root, np.where(linked, root[None, :], 10**9).min(axis=1))
        if (low == root).all():
            return {i: (int(n), int(c)) for i, n, c in zip(ids, linked.sum(axis=1), root, strict=True)}
        root = low


def test_query_agrees_with_sql(spark):
    q = REGISTRY["op5_near_vectors"]
    assert compare(q.run(spark, SF), connect(SF), q.sql) == ""


@pytest.mark.parametrize("cell", [20, 100])
def test_many_cells_and_blocks_lose_no_link(spark, monkeypatch, cell):
    monkeypatch.setattr(vectors, "CELL", cell)
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "CHUNK", 64)
    monkeypatch.setattr(vectors, "SAMPLE", 120)
    rng = np.random.default_rng(cell)
    centres = rng.normal(size=(12, 8))
    rows = []
    for i in range(500):
        noise = rng.normal(size=8) * rng.choice([0.0, 0.15, 0.5])
        rows.append((i, [float(np.float32(x)) for x in centres[rng.integers(0, 12)] + noise], int(rng.integers(0, 2))))
    got = vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [None, 1.0], 1), (5, [inf, 1.0], 1), (6, [], 1),
            (7, [1.0, 1.0], None), (8, [1.0, 1.0], None), (None, [2.0, 2.0], 1), (9, [2.0, 2.0], 1), (9, [2.0, 2.0], 1),
            (10, [1.0, 1.0, 0.0], 1), (11, [4.0, 4.0], 1), (12, [4.0, 4.0], 2)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS _id", "2 AS cid", "3 AS copies", "4 AS home")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect()), key=str)
    alone = {1, 2, 3, 4, 5, 6, 7, 8, 10, 12}
    assert [g for g in got if g[0] in alone] == sorted(((i, 0, i, True) for i in alone), key=str)
    assert [g for g in got if g[0] in (9, 11)] == sorted([(11, 2, 9, False), (9, 2, 9, True), (9, 2, 9, True)], key=str)
    assert (None, 0, None, True) in got
    assert vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0

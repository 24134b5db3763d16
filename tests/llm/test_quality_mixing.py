from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import numpy as np

import corpus_pipeline
from tests.llm.frames import SF, documents, empty, odd
from tests.llm.test_neardup import brute
from waitlens.llm import mixing, packing, quality
from waitlens.llm.queries import REGISTRY, TOKENIZER


def test_marginals_agree_with_enumeration():
    rng = np.random.default_rng(0)
    counts = np.array([4, 1, 3])
    odds = rng.normal(size=8)
    model = quality.LineChain(np.zeros(1), 0.7, -0.4)
    p, gg, bb, log_z = model.marginals(odds, counts)
    at = 0
    for k, n in enumerate(counts):
        weights = {}
        for y in itertools.product((1, 0), repeat=int(n)):
            s = sum(odds[at + i] for i in range(n) if y[i])
            s += sum(0.7 if a and b else -0.4 if not a and not b else 0 for a, b in zip(y, y[1:], strict=False))
            weights[y] = np.exp(s)
        z = sum(weights.values())
        assert np.isclose(log_z[k], np.log(z))
        for i in range(n):
            assert np.isclose(p[at + i], sum(w for y, w in weights.items() if y[i]) / z)
            if i + 1 < n:
                assert np.isclose(gg[at + i], sum(w for y, w in weights.items() if y[i] and y[i + 1]) / z)
                assert np.isclose(bb[at + i], sum(w for y, w in weights.items() if not y[i] and not y[i + 1]) / z)
        at += n


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in REGISTRY["op10_line_quality"].run(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    out = [r for r in labels if got[r.doc_id].held_out]
    assert all(g.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, g in got.items())
    assert sum(got[r.doc_id].predicted == r.quality for r in out) >= 0.97 * len(out)
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.5) for g in got.values())


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs = documents(spark)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", labels.quality * 0 + 1).where("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1")
    kept = labels.where("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1")
    one = {r.doc_id: r.score for r in quality.rate(docs, labels).collect()}
    two = {r.doc_id: r.score for r in quality.rate(docs.withColumn("lang", docs.doc_id.cast("string")), kept.unionByName(flipped)).collect()}
    assert one == two


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (None, 1, 0), (3, None, None), (5, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.rate(odd(spark), labels).collect()
    assert len(got) == 9 and all(r.score is not None for r in got)
    assert quality.rate(empty(spark), labels).count() == 0
    none = labels.where("false")
    assert {r.score for r in quality.rate(odd(spark), none).collect()} == {0.5}


def test_fit_meets_the_budget_like_an_exhaustive_search():
    rng = np.random.default_rng(1)
    for seed in range(40):
        sizes = np.array(sorted(rng.choice(np.arange(1, 40), rng.integers(1, 6), replace=False)))
        counts = rng.integers(1, 4, len(sizes))
        total = int((sizes * counts).sum())
        budget = int(rng.integers(0, total + 1))
        taken = mixing.fit(sizes, counts, budget, seed)
        assert (taken >= 0).all() and (taken <= counts).all()
        got = int((sizes * taken).sum())
        floor = (counts.astype(object) * budget // total).astype(int)
        spare = [range(c - f + 1) for c, f in zip(counts, floor, strict=True)]
        every = [int((sizes * (floor + np.array(extra))).sum()) for extra in itertools.product(*spare)]
        assert abs(got - budget) == min(abs(s - budget) for s in every)


def plain_targets(sizes):
    """Targets by repeated capping, one source after another."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, budget = {}, list(order), 1.5 * sum(sizes.values())
    while free:
        unit = budget / sum(weight[s] for s in free)
        over = [s for s in free if unit * weight[s] > 2 * sizes[s]]
        if not over:
            target |= {s: unit * weight[s] for s in free}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
            free.remove(s)
    return target


def check_mix(docs, rows):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in docs:
        sizes[r.source] += len((r.text or "").encode().split())
    want = plain_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and np.isclose(r.target, want[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    # Ten documents a source: no subset need come closer than a few hundredths.
    for s, t in want.items():
        assert abs(t - taken[s]) <= max(2, 0.03 * t)


def test_mix_query_meets_targets_and_repeats_itself(spark):
    rows = REGISTRY["op6_mix_sources"].run(spark, SF).collect()
    check_mix(documents(spark).collect(), rows)
    again = REGISTRY["op6_mix_sources"].run(spark, SF).collect()
    assert sorted(rows) == sorted(again)


def test_mix_odd_rows(spark):
    rows = mixing.mix(odd(spark)).collect()
    assert len(rows) == 9 and {r.source for r in rows} == {None, "a", "b", "c"}
    assert mixing.mix(empty(spark)).count() == 0


def test_hot_length_is_split_and_still_exact(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "'one two three' AS text", "CASE WHEN id % 10 = 0 THEN 'b' ELSE 'a' END AS source")
    rows = mixing.mix(df).collect()
    for source, n in (("a", 4500), ("b", 500)):
        mine = [r for r in rows if r.source == source]
        assert len(mine) == n and abs(mine[0].target - sum(r.taken for r in mine)) < 3


def test_pipeline_agrees_with_plain_stages(spark, tmp_path):
    docs = documents(spark)
    frames = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF).write.parquet(f"file://{tmp_path}/{i}")
        frames.append(spark.read.parquet(f"file://{tmp_path}/{i}"))
    assert all(f.columns == docs.columns for f in frames[:-1])
    raw, rated, single, private, mixed, packed = (f.collect() for f in frames)
    # Rejected documents go, and none else.
    predicted = {r.doc_id: r.predicted for r in REGISTRY["op10_line_quality"].run(spark, SF).collect()}
    assert sorted(rated) == sorted(r for r in raw if predicted[r.doc_id])
    # One document of each group stays.
    roots = brute([(r.doc_id, r.text) for r in rated], 5)
    assert sorted(single) == sorted(r for r in rated if roots[r.doc_id][1] == r.doc_id)
    # Ids stay and texts without personal data do; lengths follow the texts.
    assert sorted(r.doc_id for r in private) == sorted(r.doc_id for r in single)
    assert all(r.n_chars == len(r.text) for r in private)
    # Every document as often as the mix says.
    copies = {r.doc_id: r.copies for r in mixing.mix(frames[3]).collect()}
    assert sorted(r.doc_id for r in mixed) == sorted(d for d, n in copies.items() for _ in range(n))
    # All tokens are packed.
    encoder = packing.Encoder(TOKENIZER)
    assert sum(r.length for r in packed) == sum(len(x) // 4 + 1 for x in encoder([r.text for r in mixed]))
    assert sorted(corpus_pipeline.run(spark, SF).select("doc_id", "start", "ids_crc32").collect()) == sorted(
        (r.doc_id, r.start, r.ids_crc32) for r in packed
    )


def test_pipeline_takes_odd_rows(spark, tmp_path):
    for name, source in (("odd", odd(spark)), ("empty", empty(spark))):
        docs = source
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF).write.parquet(f"file://{tmp_path}/{name}{i}")
            docs = spark.read.parquet(f"file://{tmp_path}/{name}{i}")
            if i < 4:
                assert docs.columns == source.columns

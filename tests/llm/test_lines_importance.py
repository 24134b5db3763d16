from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import compare, connect
from tests.llm.frames import LONG, ODD, SF, empty, odd
from waitlens.llm import importance, linededup
from waitlens.llm.queries import REGISTRY


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op13_line_dedup"])
def test_agrees_with_sql(spark, name):
    assert compare(REGISTRY[name].run(spark, SF), connect(SF), REGISTRY[name].sql) == ""


# Line dedup


def plain_dedup(docs, least_chars=20, least_docs=3):
    """[(id, text)] -> kept texts, by dictionaries."""
    ident = lambda d: linededup.NO_ID if d is None else d
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))
    holders = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders.setdefault(key(line), set()).add(ident(doc))
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        gone = [len(h := holders.get(key(x), ())) >= least_docs and ident(doc) != max(h) for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)
        out.append((doc, kept if any(gone) else text, len(lines), sum(gone)))
    return out


def rows_of(found):
    return Counter((r.row.doc_id, r.row.text, r.n_lines, r.n_dropped) for r in found.collect())


SHARED = "  A line that very many documents\tshare "
LINES = [
    *[(i, f"line {i} of its own and long\n{SHARED}\nshort\nshort") for i in range(300)],
    (300, "\n".join([SHARED.upper()] * 50)),
    (301, f"{SHARED}\x0b\nÀ line of twenty points\r"),
    (302, "À line of twenty points"),
    (303, "À line of twenty points"),
    (304, "à line of twenty points\nin just two documents, this one"),
    (305, "in just two documents, this one\nin just two documents, this one"),
    (None, f"{SHARED}\n"),
    (None, "without an id, another text\n" + SHARED),
    (7, SHARED),
    (7, SHARED),
    (1 << 62, None),
    (1 << 61, ""),
    (306, ("x" * 300 + "\n") * 3000 + SHARED),
]


def test_lines_against_plain_version(spark):
    docs = spark.createDataFrame(LINES, "doc_id long, text string").repartition(7)
    assert rows_of(linededup.keep_lines(docs)) == Counter(plain_dedup(LINES))


def test_a_key_over_many_partitions(spark):
    docs = spark.createDataFrame(LINES, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(linededup.keep_lines(docs)) == Counter(plain_dedup(LINES))
        assert rows_of(linededup.keep_lines(docs, least_docs=5, least_chars=4)) == Counter(plain_dedup(LINES, 4, 5))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 6), st.integers(0, 3)), max_size=40), st.integers(1, 6), st.integers(2, 4))
def test_cut_anywhere_the_verdict_is_the_same(lines, parts, least):
    rows = sorted({(k, 0, d, 0, p) for k, d, p in lines}, key=lambda r: (r[0], -r[2], r[4]))
    cuts = np.linspace(0, len(rows), parts + 1).astype(int)
    judged = [v for a, b in zip(cuts, cuts[1:], strict=False) for v in linededup.judge(iter(rows[a:b]), least)]
    seen = {}
    for kind, hi, _, doc, _, _ in judged:
        if kind == linededup.SEEN:
            seen.setdefault(hi, set()).add(doc)
    got = {v[1:] for v in judged if v[0] == linededup.DROPPED}
    got |= {v[1:] for v in judged if v[0] == linededup.UNSETTLED and len(seen[v[1]]) >= least and v[3] != max(seen[v[1]])}
    docs = {}
    for r in rows:
        docs.setdefault(r[0], set()).add(r[2])
    assert got == {r for r in rows if len(docs[r[0]]) >= least and r[2] != max(docs[r[0]])}


def test_line_dedup_odd_rows(spark):
    found = linededup.keep_lines(odd(spark))
    assert rows_of(found) == Counter(plain_dedup([r[:2] for r in ODD]))
    assert found.select("row.*").columns == odd(spark).columns
    assert linededup.keep_lines(empty(spark)).count() == 0


def test_bitmaps_hold_the_kept_lines(spark):
    from waitlens.llm.common import Scratch

    docs = spark.createDataFrame(LINES[300:], "doc_id long, text string")
    for r in linededup.keep_bitmaps(docs, Scratch(spark, "test")).collect():
        assert (r.keep is None) == (r.n_dropped == 0)
        if r.keep:
            keep = linededup.unpack_bits(r.keep, r.n_lines)
            assert len(keep) == r.n_lines and (~keep).sum() == r.n_dropped


# Importance resampling


def plain_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    out, word = [], ""
    for c in low + " ":
        if c.isascii() and not ("0" <= c <= "9" or "a" <= c <= "z"):
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def plain_resample(docs, target, run=1, buckets=10_000, percent=10, least=20, seed=2024):
    def features(text):
        w = plain_words(text)
        return [" ".join(w[i : i + n]) for n in range(1, run + 1) for i in range(len(w) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own, other = Counter(), Counter()
    for _, text in docs:
        own.update(map(bucket, features(text)))
    for text in target:
        other.update(map(bucket, features(text)))
    s, t = own.total(), other.total()
    gain = lambda b: math.floor(1000 * math.log((other[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets))))
    rows = []
    for doc, text in docs:
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        fs = features(text)
        weight = sum(map(gain, map(bucket, fs)))
        rows.append([doc, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_words(text))])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for i, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = i + 1
    return Counter(tuple(r[:5]) for r in rows)


def resampled(spark, docs, target, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return Counter(map(tuple, importance.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), **options).collect()))


def test_resampling_against_plain_version(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["alpha", "Beta", "épsilon", "数", "x1", "d-e", "z" * 300, "", "\x7f", "été\x00ou"]
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(200)]
    docs += [(None, "no id " * 20), (5, docs[5][1]), (5, docs[5][1]), (900, None), (901, ""), (902, LONG)]
    target = [docs[3][1], None, "", docs[8][1]]
    for options in ({}, {"run": 3, "buckets": 70_001, "percent": 50, "least": 3}, {"percent": 100}, {"percent": 0}):
        least = {"least_words": options["least"]} if "least" in options else {}
        want = plain_resample(docs, target, **options)
        assert resampled(spark, docs, target, **{k: v for k, v in options.items() if k != "least"}, **least) == want


def test_resampling_odd_rows(spark):
    names = [(r[0], r[1]) for r in ODD]
    got = importance.resample(odd(spark), odd(spark).limit(2), percent=40)
    assert Counter(map(tuple, got.collect())) == plain_resample(names, [r[1] for r in ODD[:2]], percent=40)
    assert importance.resample(empty(spark), odd(spark)).count() == 0
    assert importance.resample(odd(spark), empty(spark)).count() == len(ODD)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=30))
def test_checksums_of_any_bytes(features):
    assert importance.buckets_of(pa.array(features, pa.binary()), 1 << 32 - 1).tolist() == [zlib.crc32(f) % (1 << 31) for f in features]

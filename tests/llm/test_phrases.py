"""Fingerprints against a parse spelled out symbol by symbol, and passages in long texts."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from waitlens.llm import phrases

ALL = (1 << 64) - 1


def mix(x):
    x ^= x >> 32
    x = x * 0x9E3779B97F4A7C15 & ALL
    x ^= x >> 29
    x = x * 0xD6E8FEB86659FD93 & ALL
    return x ^ x >> 32


def plain_print(text):
    """The fingerprint of one text, without arrays."""
    symbols, level, hashes = [mix(ord(c) + 1) for c in text], 0, set()
    while symbols:
        level += 1
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        symbols = [s if n == 1 else mix(s + n * 0x9E3779B97F4A7C15 & ALL) for s, n in runs]
        labels = symbols
        for _ in range(4):
            tossed = []
            for i, s in enumerate(labels):
                differ = s ^ (labels[i - 1] if i else s ^ 1)
                place = (differ & -differ).bit_length() - 1
                tossed.append(place << 1 | s >> place & 1)
            labels = tossed
        blocks = []
        for i, s in enumerate(symbols):
            peak = 0 < i < len(symbols) - 1 and labels[i - 1] < labels[i] > labels[i + 1]
            if i == 0 or peak:
                blocks.append([])
            blocks[-1].append(s)
        symbols = []
        for block in blocks:
            total = sum(mix(s + mix((k & 255) + 1) & ALL) * (k | 1) for k, s in enumerate(block))
            symbols.append(mix(total + level * 0xD6E8FEB86659FD93 + len(block) & ALL))
        if level >= 2:
            hashes |= {mix(s ^ 0xA5A5A5A5) >> (24 + 3 * min(level - 2, 5)) for s in symbols}
        if len(symbols) == 1:
            break
    held = sorted(hashes)
    n = max(64, sum(h < 1 << 25 for h in held))
    return "".join(f"{h:010x}" for h in held[:n])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab cé😀\n", max_size=400), max_size=6))
def test_fingerprints_against_plain_parse(texts):
    assert phrases.fingerprints(texts) == [plain_print(t) for t in texts]


def words(rng, n):
    return " ".join(f"{i:x}" for i in rng.integers(0, 1 << 32, n))


@pytest.fixture(scope="module")
def long_texts():
    rng = np.random.default_rng(5)
    return words(rng, 200_000), words(rng, 200_000), words(rng, 300), words(rng, 3_000)


def test_long_texts_against_plain_parse(long_texts):
    text = long_texts[3] + " " + "z" * 3000 + "ab" * 900
    assert phrases.fingerprints(["", text, "x"]) == ["", plain_print(text), plain_print("x")]


def test_a_passage_shows_in_long_texts(long_texts):
    one, two, passage, longer = long_texts
    at = 900_000
    with_passage = [t[:cut] + passage + t[cut:] for t, cut in ((one, at), (two, at // 3))]
    with_longer = [t[:cut] + longer + t[cut:] for t, cut in ((one, at), (two, at // 3))]
    prints = phrases.fingerprints([one, two, *with_passage, *with_longer])
    apart, shared, more = (phrases.likeness(prints[i], prints[i + 1]) for i in (0, 2, 4))
    # Random texts share a few short phrases; the passage adds to them, ten times as much if ten times as long.
    assert apart < 5e-4 and apart < 0.7 * shared and more > 5 * shared and more < 0.05
    # The sketch grows with the text, far slower than the text.
    assert len(prints[0]) > 20_000 and len(prints[0]) < len(one) / 8
    assert phrases.likeness(prints[0], prints[2]) > 0.9


def test_likeness_estimates_resemblance():
    rng = np.random.default_rng(9)
    base = words(rng, 3000)
    for share in (0.9, 0.66, 0.33):
        cut = int(len(base) * share)
        other = base[:cut] + words(rng, 3000)[: len(base) - cut]
        a, b = phrases.fingerprints([base, other])
        assert abs(phrases.likeness(a, b) - share / (2 - share)) < 0.15

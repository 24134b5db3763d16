from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.frames import documents, empty, odd
from waitlens.llm import packing
from waitlens.llm.queries import REGISTRY, TOKENIZER
from tests.llm.frames import SF


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(TOKENIZER)


def plain(text):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("text", ["", " ", "  ", "a  b", "   a", "a ", "a  ", "\n \n", " \nfoo", "a\n \nb", "a\n\n b <|endoftext|> c", "\x1c \x1c b", "é 　 x\x85 y", "'s 't don't", "x \t y", "123abc!!! 😀 😀"])
def test_word_by_word_equals_whole(encoder, text):
    assert encoder([text])[0] == plain(text)


def test_word_by_word_equals_whole_on_documents(encoder, spark):
    texts = [r.text or "" for r in documents(spark).collect()]
    assert encoder(texts) == [plain(t) for t in texts]


def test_few_words_kept_change_nothing(spark):
    texts = [r.text or "" for r in documents(spark).limit(20).collect()]
    assert packing.Encoder(TOKENIZER, bound=7)(texts) == packing.Encoder(TOKENIZER)(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_decreasing(lengths):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    where, offset = packing.best_fit_decreasing(lengths, 64)
    # Against a plain search for the tightest open window.
    rooms, want = [], []
    for n in lengths.tolist():
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(64 - n)
        want.append(sorted(rooms))
    used = defaultdict(int)
    for w, o, n in zip(where.tolist(), offset.tolist(), lengths.tolist(), strict=True):
        assert o == used[w]
        used[w] += n
    assert sorted(64 - u for u in used.values()) == (want[-1] if want else [])


def check(rows, texts, window=1024):
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append((r.offset, r.length))
    for doc, text in texts.items():
        ids = plain(text or "") + b"\0\0\0\0"
        pieces = sorted(by_doc[doc], key=lambda r: r.start)
        at = 0
        for r in pieces:
            assert r.start == at and r.doc_tokens == len(ids) // 4 and 0 < r.length <= window
            assert r.ids_crc32 == zlib.crc32(ids[4 * at : 4 * (at + r.length)])
            at += r.length
        assert at == len(ids) // 4
    for pieces in by_window.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    return len(by_window)


def test_query_packs_every_id_once(spark):
    rows = REGISTRY["op2_pack_windows"].run(spark, SF).collect()
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    windows = check(rows, texts)
    assert sum(r.length for r in rows) > 0.98 * 1024 * (windows - 1)


def test_odd_rows(spark):
    rows = packing.pack(odd(spark).where("doc_id > 1"), TOKENIZER).collect()
    check(rows, {r.doc_id: r.text for r in odd(spark).where("doc_id > 1").collect()})
    twice = packing.pack(odd(spark).where("doc_id = 1"), TOKENIZER).collect()
    assert len(twice) == 2
    assert packing.pack(empty(spark), TOKENIZER).count() == 0


def test_sequences_hold_the_ids(spark):
    packed = packing.pack(documents(spark), TOKENIZER, with_ids=True, shard=50)
    for r in packing.sequences(packed).limit(30).collect():
        n = r.n_tokens
        assert len(r.ids) == (n if n & (n - 1) == 0 else 1024) and not any(r.ids[n:])

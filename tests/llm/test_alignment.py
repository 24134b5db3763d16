from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from tests.llm.frames import LONG, ODD, SF, documents, empty, odd
from waitlens.llm import alignment
from waitlens.llm.queries import PIECES, REGISTRY, TOKENIZER


@pytest.fixture(scope="module")
def plain():
    """Whole texts through both libraries, without segments, caches or arrays."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(TOKENIZER)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    shown = {}
    spare = 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            shown[chr(byte)] = byte
        else:
            shown[chr(spare)] = byte
            spare += 1

    def groups(text):
        if not text:
            return []
        spaced = (" " + text).encode()
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        spell_a = [bytes(shown[c] for c in a.id_to_token(i)) for i in ids_a]
        spell_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(spell_a) != spaced or b"".join(spell_b) != spaced:
            return []
        out, left, right, x, y = [], [], [], 0, 0
        while ids_a or ids_b or left:
            if x <= y:
                left.append(ids_a.pop(0))
                x += len(spell_a.pop(0))
            else:
                right.append(ids_b.pop(0))
                y += len(spell_b.pop(0))
            if x == y:
                out.append((left, right))
                left, right = [], []
        return out

    def count(docs):
        parted = [(d, groups(t)) for d, t in docs]
        held = [Counter((p, q) for l, r in gs for p in l for q in r) for _, gs in parted]
        corpus = Counter(p for h in held for p in h)
        best = {}
        for (p, _), n in corpus.items():
            best[p] = max(best.get(p, 0), n)
        rows = Counter()
        for (doc, gs), h in zip(parted, held, strict=True):
            spelled = ";".join(f"{','.join(map(str, l))}|{','.join(map(str, r))}" for l, r in gs)
            rows[
                doc,
                sum(len(l) for l, _ in gs),
                sum(len(r) for _, r in gs),
                len(gs),
                h.total(),
                sum(n for p, n in h.items() if corpus[p] == best[p[0]]),
                sum(n * corpus[p] for p, n in h.items()),
                hashlib.sha256(spelled.encode()).hexdigest() if gs else "",
            ] += 1
        return rows

    return count


def counted(docs, **options):
    return Counter(map(tuple, alignment.count_links(docs, TOKENIZER, PIECES, **options).collect()))


def test_query_against_plain_version(spark, plain):
    docs = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert Counter(map(tuple, REGISTRY["op12_token_alignment"].run(spark, SF).collect())) == plain(docs)


TEXTS = [
    " ",
    "  ",
    "a ",
    " a",
    "a  b   c\n  d \n e\t f  ",
    "\n\n x",
    "x▁y spells what it is not",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "ﬁne Été é 数え 😀😀 \x00 \x1c b",
    "don't 's ll 've",
    "----------------" * 40,
    " " + "-" * 700 + " " + "=" * 33,
    "１２３ 1234567   　 y  z",
    "word " * 50,
    "word " * 50,
    "supercalifragilistic antidisestablishmentarianism " * 3,
]


@pytest.mark.parametrize("frequent", [1 << 18, 5, 1])
def test_odd_texts_with_any_table_size(spark, plain, frequent):
    docs = [*enumerate(TEXTS), (None, "no id"), (3, None), (4, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert counted(frame, frequent=frequent) == plain(docs)


def test_odd_rows(spark, plain):
    docs = [r[:2] for r in ODD if r[1] is None or len(r[1]) < 100]
    assert counted(odd(spark).where("text IS NULL OR length(text) < 100")) == plain(docs)
    assert sum(counted(odd(spark)).values()) == len(ODD)
    assert not counted(empty(spark))


def test_segments_make_no_difference():
    aligner = alignment.Aligner(TOKENIZER, PIECES)
    for text in [*TEXTS, LONG[:3000], "-" * 5000 + "x " + "=" * 4000]:
        found = aligner.document(text, aligner.cut([text])[0])
        whole = aligner.align(f" {text}")
        assert (whole is None and not found) or ";".join(f[4] for f in found) == whole[4]


def test_identity_map_names_equal_bytes():
    words = alignment.Vocabularies(TOKENIZER, PIECES)
    some = [(i, j) for i, j in enumerate(words.identity) if j >= 0]
    assert len(some) > 10_000
    assert all(words.bytes_a[i] == words.bytes_b[j] for i, j in some)

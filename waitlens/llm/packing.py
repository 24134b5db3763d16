"""Packing documents into fixed windows by best-fit decreasing.

Each document becomes token ids plus one end id. Full windows are cut off its front and
fill a sequence each; the remainder, shorter than a window, is packed. Remainders are dealt
at random into shards of bounded size, and each shard is packed by itself: longest piece
first, into the open window with the least room that still holds it. Thousands of pieces
per shard leave next to nothing of a window unused, so shards cost no padding worth naming.

Results: a null text is the empty document (its end id alone); repeated rows are packed
once per row; an empty table gives no rows; columns other than the two named are ignored. A text of any
length is encoded whole and gives as many full windows as it takes.
"""

from __future__ import annotations

import math
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import WordTable

WINDOW = 1024
END_ID = 0
#: Pieces one task packs at a time.
SHARD = 4_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class RoomTree:
    """A segment tree over remaining capacities: which is the tightest one with an open window?

    Leaf ``c`` counts open windows with ``c`` free slots. ``tightest(need)`` is the smallest
    such ``c >= need``, found by climbing from the leaf and descending into the first
    non-empty subtree to its right.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        node = room + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, room: int) -> int:
        node = room + self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return self.open[room].pop()

    def tightest(self, need: int) -> int | None:
        node = need + self.leaves
        if self.count[node]:
            return need
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset) of each length; the lengths must come longest first."""
    tree = RoomTree(window)
    where = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    opened = 0
    for i, need in enumerate(lengths.tolist()):
        room = tree.tightest(need)
        if room is None:
            number, room = opened, window
            opened += 1
        else:
            number = tree.take(room)
        where[i], offset[i] = number, window - room
        if room > need:
            tree.add(room - need, number)
    return where, offset


def byte_names() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Byte-level BPE ids of whole texts, as little-endian unsigned 32-bit bytes.

    The vocabulary's splitting pattern never lets a token run from a non-space over a
    following space, so a text can be encoded word by word and the ids of a word reused.
    That fails only where a space stands between white space on both sides (or at the
    end after white space), or where the text spells a special token: those texts are
    encoded whole.

    A word met for the first time goes through a second implementation of the same merges,
    several times faster on short strings. It takes its ranks from the vocabulary file, and
    is used only if the file's merges stand in the order of their ids, which makes both
    implementations agree; otherwise words go through the first one too.
    """

    def __init__(self, path: str, bound: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import re

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([r"\s \s", r"\s \Z", *map(re.escape, special)]))
        self.ranks = self._ranks(path)
        self.words = WordTable(self._word, bound)

    def _ranks(self, path: str):
        import json

        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        vocabulary = model["vocab"]
        if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
            return None
        names = byte_names()
        ranks = {bytes(names[c] for c in token): i for token, i in vocabulary.items() if i < 256 + len(pairs)}
        return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _word(self, word: str) -> bytes:
        """Ids of a word with the space before it."""
        if self.ranks is None:
            return self._whole([f" {word}"])[0]
        return array("I", self.ranks.encode_ordinary(f" {word}")).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        # "a b" holds the words "a" and " b"; all but the first are kept without their space.
        split = [None if self.whole.search(t) else t.split(" ") for t in texts]
        heads = self._whole([t if p is None else p[0] for t, p in zip(texts, split, strict=True)])
        get = self.words.__getitem__
        return [
            head if p is None else head + b"".join(map(get, p[1:]))
            for head, p in zip(heads, split, strict=True)
        ]


def cut(docs: DataFrame, tokenizer_path: str, id_col: str, text_col: str, window: int, with_ids: bool) -> DataFrame:
    """Pieces of each document: full windows from the front, then the remainder."""
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            step, at = 2 << 20, 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size < step):
                    size += len(texts[stop])
                    stop += 1
                rows: list[tuple] = []
                for doc, tokens in zip(ids[at:stop], encoder(texts[at:stop]), strict=True):
                    tokens += end
                    total = len(tokens) // 4
                    for start in range(0, total, window):
                        part = tokens[4 * start : 4 * (start + window)]
                        row = (doc, start, len(part) // 4, zlib.crc32(part), total)
                        rows.append((*row, np.frombuffer(part, "<u4").astype(np.int32)) if with_ids else row)
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int64()] * 5 + [pa.list_(pa.int32())] * with_ids
                names = PIECES.replace(" long", "").split(", ") + ["ids"] * with_ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
                )
                at = stop

    narrow = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    return narrow.mapInArrow(pieces, schema)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    shard: int = SHARD,
    with_ids: bool = False,
) -> DataFrame:
    """Every piece with its sequence and its offset there, and its ids if asked for.

    The number of shards follows the number of rows, so what one task packs stays bounded.
    A sequence id is the shard's number times 2^32 plus the window's number in the shard.
    Order within a shard is fixed by length, document and start, so a repeated task gives
    the same windows.
    """
    shards = max(1, math.ceil(docs.count() / shard))
    pieces = cut(docs, tokenizer_path, id_col, text_col, window, with_ids)
    schema = pieces.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")
    schema += ", sequence_id long, offset long"

    def place(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        group = group.sort_by(order)
        where, offset = best_fit_decreasing(group.column("length").to_numpy(), window)
        where += key[0].as_py() << 32
        group = group.drop_columns(["_shard"])
        return group.append_column("sequence_id", pa.array(where)).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shards)))
    return dealt.groupBy("_shard").applyInArrow(place, schema)


def sequences(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """The padded sequences of a packing made ``with_ids``.

    A sequence is padded with the end id up to the window, unless its length is a power of
    two already, which kernels take as it is.
    """
    rows = packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("pieces")
    )
    ids = F.flatten(F.col("pieces.ids"))
    used = F.size("ids")
    power = F.log2(used) == F.floor(F.log2(used))
    return (
        rows.select("sequence_id", ids.alias("ids"), F.col("pieces.doc_id").alias("doc_ids"), F.col("pieces.offset").alias("starts"))
        .withColumn("n_tokens", used)
        .withColumn("ids", F.when(power, F.col("ids")).otherwise(F.concat("ids", F.array_repeat(F.lit(END_ID), window - used))))
    )

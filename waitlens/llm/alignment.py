"""Two tokenizers aligned on the bytes they both cut at.

A text is encoded by a byte-level vocabulary A and a piece vocabulary B. Byte offsets where
a token of A and a token of B both end cut the tokens into groups; every token of A in a
group is linked with every token of B in it, and pairs of ids are counted by the documents
that hold them linked.

Most groups hold one token on each side, which then spell the same bytes. For those an
identity map, made once from the two vocabularies, names the B id of each A id, and such
pairs are counted in a vector as long as the vocabulary. Only other pairs are shuffled.

Neither vocabulary has a token that runs from a character into a following space (B is
checked, A's splitting pattern rules it out), so a text falls into segments that start with
spaces and are aligned one by one; short segments are remembered.

To give every document its pairs' counts back, pairs in more than a share of all documents
are looked up in a table that the share bounds to ``FREQUENT`` rows, whatever the input; no
other pair has many rows, so the join on the rest has no hot key.

Results: null and empty texts, and texts whose tokens do not spell the text, have no tokens:
zeros and an empty string; repeated rows are documents of their own, null ids too; an empty
table gives no rows; texts of any length are encoded whole, long segments by code that needs
no more than their length times its logarithm; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import Scratch, WordTable, slices
from waitlens.llm.packing import Encoder, byte_names

#: Rows of the table of frequent pairs at most.
FREQUENT = 1 << 18
#: Characters up to which segments are remembered.
SHORT = 48
#: A pair of ids as one number: a * SPAN + b.
SPAN = 1 << 24
_SPACE_AFTER = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


def segments(spaced: str) -> list[str]:
    """The text, which starts with a space, cut before each space that follows no white space."""
    if _SPACE_AFTER.search(spaced):
        return _CUT.split(spaced)
    return [f" {word}" for word in spaced[1:].split(" ")]


class Vocabularies:
    """Both tokenizers of a task, and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        # The same merges from the same file, several times faster on short strings; None
        # where the file's merges do not stand in the order of their ids.
        self.ranks = Encoder(path_a).ranks
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = byte_names()
        added = self.a.get_added_tokens_decoder()
        spelled = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [
            spelled[i].encode() if i in added or i not in spelled else bytes(names[c] for c in spelled[i])
            for i in range(max(spelled) + 1)
        ]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.segmented = not any(re.search("[^▁]▁", p) for p in pieces)
        self.size_a = [len(x) for x in self.bytes_a]
        self.size_b = [len(x) for x in self.bytes_b]
        # The first B id with the same bytes; -1 if there is none. Control tokens spell nothing.
        same: dict[bytes, int] = {}
        for i, spelling in enumerate(self.bytes_b):
            if not self.b.is_control(i) and not self.b.is_unknown(i):
                same.setdefault(spelling, i)
        self.identity = np.array([same.get(x, -1) for x in self.bytes_a], np.int64)

    def encode(self, spaced: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of texts that start with a space; None where they do not spell the text.

        B puts a space of its own in front, so the text's goes; an empty rest gets none.
        """
        if self.ranks is not None and all(len(s) <= SHORT for s in spaced):
            all_a = [self.ranks.encode_ordinary(s) for s in spaced]
        else:
            all_a = [e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)]
        all_b = self.b.encode([s[1:] for s in spaced], num_threads=1)
        out = []
        for text, a, b in zip(spaced, all_a, all_b, strict=True):
            b = b if len(text) > 1 else [self.b.piece_to_id("▁")]
            spelling = text.encode("utf-8", "surrogatepass")
            right = b"".join(map(self.bytes_a.__getitem__, a)) == spelling == b"".join(map(self.bytes_b.__getitem__, b))
            out.append((a, b) if right else None)
        return out


class Aligner:
    """Segment -> (tokens of A, of B, groups, links, groups spelled, pair numbers, their links).

    Numbers are packed as 64-bit words; links are None where each pair stands for one.
    """

    def __init__(self, path_a: str, path_b: str, bound: int = 200_000):
        self.words = Vocabularies(path_a, path_b)
        self.known = WordTable(self.align, bound)

    def cut(self, texts: list[str]) -> list[list[str]]:
        """The segments of some texts; short ones not remembered are aligned all at once."""
        if self.words.segmented:
            parts = [segments(f" {t}") if t else [] for t in texts]
        else:
            parts = [[f" {t}"] if t else [] for t in texts]
        fresh = self.known.lacks({p for held in parts for p in held if len(p) <= SHORT})
        for part, coded in zip(fresh, self.words.encode(fresh) if fresh else [], strict=True):
            self.known.put(part, self.pair_up(coded))
        return parts

    def align(self, spaced: str) -> tuple | None:
        return self.pair_up(self.words.encode([spaced])[0])

    def pair_up(self, coded: tuple[list[int], list[int]] | None) -> tuple | None:
        """Groups of the tokens between common ends, and their pairs, which may repeat."""
        if coded is None:
            return None
        a, b = coded
        size_a, size_b = self.words.size_a, self.words.size_b
        spelled: list[str] = []
        pairs: list[int] = []
        times: list[int] | None = None
        links = i = j = 0
        while i < len(a):
            one, two = a[i], b[j]
            x, y = size_a[one], size_b[two]
            if x == y:
                spelled.append(f"{one}|{two}")
                pairs.append(one * SPAN + two)
                i += 1
                j += 1
                continue
            p, q = i + 1, j + 1
            while x != y:
                if x < y:
                    x += size_a[a[p]]
                    p += 1
                else:
                    y += size_b[b[q]]
                    q += 1
            left, right = a[i:p], b[j:q]
            i, j = p, q
            spelled.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
            if len(left) + len(right) < 12:
                pairs += [one * SPAN + two for one in left for two in right]
                continue
            # Ids may repeat without end in a long group; their kinds are few.
            times = times or []
            times += [1] * (len(pairs) - len(times))
            left, right = Counter(left), Counter(right)
            pairs += [one * SPAN + two for one in left for two in right]
            times += [n * m for n in left.values() for m in right.values()]
        if times is not None:
            times += [1] * (len(pairs) - len(times))
        links = len(pairs) if times is None else sum(times)
        packed = None if times is None else array("q", times).tobytes()
        return len(a), len(b), len(spelled), links, ";".join(spelled), array("q", pairs).tobytes(), packed

    def document(self, text: str, parts: list[str]) -> list[tuple]:
        """The aligned segments of a text; none if its tokens do not spell it."""
        if not text:
            return []
        get, align = self.known.__getitem__, self.align
        if max(map(len, parts)) <= SHORT:
            found = [get(p) for p in parts]
        else:
            found = [get(p) if len(p) <= SHORT else align(p) for p in parts]
        if None in found:
            found = [align(f" {text}")]
        return [] if None in found else found


def pairs_of(found: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of aligned segments, and how many links each stands for."""
    keys = np.frombuffer(b"".join([f[5] for f in found]), np.int64)
    if all(f[6] is None for f in found):
        return np.unique(keys, return_counts=True)
    times = np.concatenate([np.ones(len(f[5]) // 8, np.int64) if f[6] is None else np.frombuffer(f[6], np.int64) for f in found])
    keys, place = np.unique(keys, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, place, times)
    return keys, total


def aligned(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> DataFrame:
    """One row per document: its counts, its identity pairs by A id and its other pairs, with links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        identity = aligner.words.identity
        for batch in batches:
            for start, stop in slices(batch, 1, 2 << 20):
                part = batch.slice(start, stop - start)
                texts = [t or "" for t in part.column(1).to_pylist()]
                found = map(aligner.document, texts, aligner.cut(texts))
                yield emit(part.column(0), [describe(f, identity) for f in found])

    def describe(found: list[tuple], identity: np.ndarray) -> tuple:
        keys, total = pairs_of(found)
        same = identity[keys // SPAN] == keys % SPAN
        digest = hashlib.sha256(";".join([f[4] for f in found]).encode()).hexdigest() if found else ""
        counts = [sum([f[i] for f in found]) for i in range(4)]
        return *counts, digest, (keys[same] // SPAN).astype(np.int32), total[same], keys[~same], total[~same]

    def emit(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int32())] + [pa.list_(pa.int64())] * 3
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([ids, *columns], names=names)

    fields = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, same array<int>, same_links array<long>, pairs array<long>, pair_links array<long>"
    names = ["doc_id", *(f.split()[0] for f in fields.split(", "))]
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, f"doc_id long, {fields}")


def identity_counts(rows: DataFrame, size: int) -> np.ndarray:
    """Documents per A id that hold it linked with the B id of the same bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["a", "n"])

    out = np.zeros(size, np.int64)
    for r in rows.select("same").mapInArrow(count, "a long, n long").groupBy("a").agg(F.sum("n").alias("n")).collect():
        out[r.a] = r.n  # a row per id of the vocabulary at most
    return out


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n): documents that hold a pair of different spelling linked."""
    return rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def count_links(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per document."""
    scratch = Scratch(docs.sparkSession, "alignment")
    vocabularies = Vocabularies(path_a, path_b)
    size = len(vocabularies.bytes_a)
    rows = scratch.keep(aligned(docs, id_col, text_col, path_a, path_b).withColumn("_row", F.monotonically_increasing_id()))
    same = identity_counts(rows, size)
    counts = scratch.keep(pair_counts(rows))
    a = F.call_function("shiftright", F.col("pair"), F.lit(SPAN.bit_length() - 1))
    best = same.copy()
    for r in counts.groupBy(a.alias("a")).agg(F.max("n").alias("n")).collect():  # as many as A has ids
        best[r.a] = max(best[r.a], r.n)
    # More than this many rows for a pair: so many pairs there can be at most.
    limit = (counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // frequent
    common = counts.where(F.col("n") > limit).toArrow()
    order = np.argsort(common.column("pair").to_numpy())
    known, known_n = common.column("pair").to_numpy()[order], common.column("n").to_numpy()[order]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            n_best, sums = np.zeros(n, np.int64), np.zeros(n, np.int64)

            def add(owner: np.ndarray, ids: np.ndarray, links: np.ndarray, count: np.ndarray) -> None:
                np.add.at(sums, owner, links * count)
                np.add.at(n_best, owner, np.where(count == best[ids], links, 0))

            ids, owner = flat(batch.column("same"))
            add(owner, ids, flat(batch.column("same_links"))[0], same[ids])
            pairs, owner = flat(batch.column("pairs"))
            links = flat(batch.column("pair_links"))[0]
            place = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            there = known[place] == pairs if len(known) else np.zeros(len(pairs), bool)
            add(owner[there], pairs[there] // SPAN, links[there], known_n[place[there]])
            ends = pa.array(np.r_[0, np.cumsum(np.bincount(owner[~there], minlength=n))], pa.int32())
            rest = pa.StructArray.from_arrays([pa.array(pairs[~there]), pa.array(links[~there])], ["pair", "links"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(n_best), pa.array(sums), pa.ListArray.from_arrays(ends, rest)],
                names=["_row", "n_best", "count_sum", "_rest"],
            )

    def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The values of all lists and the row each belongs to."""
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        return column.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)

    looked = scratch.keep(
        rows.select("_row", "same", "same_links", "pairs", "pair_links").mapInArrow(
            look_up, "_row long, n_best long, count_sum long, _rest array<struct<pair:long,links:long>>"
        )
    )

    def best_of(ids: pa.Array) -> pa.Array:
        return pa.array(best[ids.to_numpy()])

    top = F.arrow_udf(best_of, "long")
    rare = (
        looked.select("_row", F.inline("_rest"))
        .join(counts.where(F.col("n") <= limit), "pair")
        .select(
            "_row",
            F.when(F.col("n") == top(a), F.col("links")).otherwise(F.lit(0)).alias("n_best"),
            (F.col("links") * F.col("n")).alias("count_sum"),
        )
    )
    sums = looked.select("_row", "n_best", "count_sum").unionByName(rare).groupBy("_row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
    )
    return rows.join(sums, "_row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

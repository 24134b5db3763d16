"""Lines that many documents share are dropped everywhere but in one document.

A line's key is its text without ASCII white space at both ends, A-Z in lower case. Every
line with a long enough key becomes a row (hash of the key, document, position). The rows
are range-partitioned and sorted by hash, then document from the largest id down, then
position, so each task streams over the lines of a key: the first document keeps them, and
as soon as enough further documents have come by, theirs go. What comes back are positions,
gathered into one compressed bitmap of kept lines per document; no text takes part until
the bitmaps are applied.

A key that half of all documents share is cut by the range partitioning like any other run
of rows. Whoever holds the first or last key of a partition says only which documents it
saw there, at most as many as the threshold asks for; those few rows settle the keys that
lie on a border.

Results: a null or empty text is one empty line; a null id counts as the smallest id there
is; rows under one id are one document, rows repeated in full share a bitmap; an empty
table gives no rows; a text of any length is read once, its lines are rows of their own;
other columns are carried by ``keep_lines`` whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import Scratch, slices, utf8

LEAST_CHARS, LEAST_DOCS = 20, 3
NO_ID = -(1 << 63)
DROPPED, UNSETTLED, SEEN = 0, 1, 2
_CONTINUED = bytes(range(0x80, 0xC0))
_ROWS = 1 << 16


def line_key(line: bytes) -> bytes:
    """bytes.strip() takes off exactly the six ASCII white-space characters; lower() only A-Z."""
    return line.strip().lower()


def code_points(text: bytes) -> int:
    return len(text) if text.isascii() else len(text.translate(None, _CONTINUED))


def copy_of(texts: pa.Array) -> pa.Array:
    """A name of the text, so that rows under one id are told apart."""
    return pa.array(np.fromiter(map(xxhash.xxh3_64_intdigest, utf8(texts)), np.uint64, len(texts)).view(np.int64))


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """(_doc, _copy, _n, _lines): a row per document with the hashes of its long lines."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch, 1):
                part = batch.slice(start, stop - start)
                counts, ends, place, names = [], [0], [], []
                for text in utf8(part.column(1)):
                    lines = text.split(b"\n")
                    counts.append(len(lines))
                    for i, line in enumerate(lines):
                        key = line_key(line)
                        if len(key) >= least_chars and code_points(key) >= least_chars:
                            place.append(i)
                            names.append(xxhash.xxh3_128_digest(key))
                    ends.append(len(place))
                halves = np.frombuffer(b"".join(names), ">i8").astype(np.int64).reshape(-1, 2)
                lines = pa.StructArray.from_arrays(
                    [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(place, pa.int32())], ["hi", "lo", "pos"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        copy_of(part.column(1)),
                        pa.array(counts, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lines),
                    ],
                    names=["_doc", "_copy", "_n", "_lines"],
                )

    narrow = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), F.col(text_col).cast("string"))
    return narrow.mapInArrow(cut, "_doc long, _copy long, _n int, _lines array<struct<hi:long,lo:long,pos:int>>")


def judge(rows: Iterator[tuple], least_docs: int) -> Iterator[tuple]:
    """(kind, hi, lo, doc, copy, pos) from the sorted rows (hi, lo, doc, copy, pos) of one task.

    Held back are only the lines of the few documents that come before the threshold is met.
    """
    key, first, docs, waiting = None, False, [], []

    def border() -> Iterator[tuple]:
        for doc in docs:
            yield (SEEN, *key, doc, None, None)

    for row in rows:
        hi, lo, doc = row[:3]
        if (hi, lo) != key:
            if first:
                yield from border()
            first = key is None
            key, docs, waiting = (hi, lo), [doc], []
        elif len(docs) < least_docs and doc != docs[-1]:
            docs.append(doc)
        if first:
            yield (UNSETTLED, *row)
        elif doc != docs[0]:
            if len(docs) < least_docs:
                waiting.append(row)
            else:
                for held in waiting:
                    yield (DROPPED, *held)
                waiting = []
                yield (DROPPED, *row)
    if key is not None:
        yield from border()
        for held in waiting:
            yield (UNSETTLED, *held)


def dropped_lines(lines: DataFrame, least_docs: int, scratch: Scratch) -> DataFrame:
    """(doc, copy, pos) of all lines that go, from rows (hi, lo, doc, copy, pos)."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        held = []
        for verdict in judge(rows, least_docs):
            held.append(verdict)
            if len(held) == _ROWS:
                yield emit(held)
                held = []
        if held:
            yield emit(held)

    def emit(held: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), *[pa.int64()] * 4, pa.int32())
        columns = [pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["kind", "hi", "lo", "doc", "copy", "pos"])

    order = [F.col("hi"), F.col("lo"), F.col("doc").desc(), F.col("copy"), F.col("pos")]
    judged = scratch.keep(
        lines.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(stream, "kind int, hi long, lo long, doc long, copy long, pos int")
    )
    # Two keys a partition at most, with a few documents each: small enough to broadcast.
    shared = (
        judged.where(F.col("kind") == SEEN)
        .groupBy("hi", "lo")
        .agg(F.max("doc").alias("_top"), F.count_distinct("doc").alias("_docs"))
        .where(F.col("_docs") >= least_docs)
    )
    late = judged.where(F.col("kind") == UNSETTLED).join(F.broadcast(shared), ["hi", "lo"]).where("doc <> _top")
    return judged.where(F.col("kind") == DROPPED).select("doc", "copy", "pos").unionByName(late.select("doc", "copy", "pos"))


def pack_bits(counts: pa.Array, gone: pa.Array) -> pa.Array:
    """The kept lines of each document as a compressed bitmap; null where all are kept."""
    out = []
    for n, places in zip(counts.to_pylist(), gone, strict=True):
        if not len(places):
            out.append(None)
            continue
        keep = np.ones(n, bool)
        keep[places.values.to_numpy()] = False
        out.append(zlib.compress(np.packbits(keep).tobytes(), 6))
    return pa.array(out, pa.binary())


def unpack_bits(bitmap: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n).astype(bool)


def keep_bitmaps(
    docs: DataFrame,
    scratch: Scratch,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """(doc, copy, n_lines, n_dropped, keep), one row per document and text, without texts."""
    hashed = scratch.keep(hashed_lines(docs, id_col, text_col, least_chars))
    lines = hashed.select(F.col("_doc").alias("doc"), F.col("_copy").alias("copy"), F.inline("_lines")).select("hi", "lo", "doc", "copy", "pos")
    gone = dropped_lines(lines, least_docs, scratch)
    every = hashed.select(F.col("_doc").alias("doc"), F.col("_copy").alias("copy"), F.col("_n"), F.lit(None).cast("int").alias("pos"))
    whole = every.unionByName(gone.withColumn("_n", F.lit(None).cast("int"))).groupBy("doc", "copy").agg(
        F.max("_n").alias("n_lines"), F.collect_set("pos").alias("_gone")
    )
    return scratch.finish(
        whole.select("doc", "copy", "n_lines", F.size("_gone").alias("n_dropped"), F.arrow_udf(pack_bits, "binary")("n_lines", "_gone").alias("keep"))
    )


def _kept_text(texts: pa.Array, counts: pa.Array, bitmaps: pa.Array) -> pa.Array:
    out = []
    for text, n, bitmap in zip(utf8(texts), counts.to_pylist(), bitmaps.to_pylist(), strict=True):
        lines = np.array(text.split(b"\n"), object)
        out.append(b"\n".join(lines[unpack_bits(bitmap, n)]))
    return pa.array(out, pa.binary())


def keep_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """(row, n_lines, n_dropped): each row as a struct with its text thinned.

    Texts cross one shuffle, to meet their bitmap; a text without dropped lines stays as it is.
    """
    scratch = Scratch(docs.sparkSession, "linededup")
    bitmaps = keep_bitmaps(docs, scratch, id_col, text_col, least_chars, least_docs).where("n_dropped > 0")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        row.alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_doc"),
        F.arrow_udf(copy_of, "long")(F.col(text_col).cast("string")).alias("_copy"),
    )
    found = rows.join(bitmaps.select(F.col("doc").alias("_doc"), F.col("copy").alias("_copy"), "n_lines", "n_dropped", "keep"), ["_doc", "_copy"], "left")
    text = F.col("row").getField(text_col).cast("string")
    # The function sees empty arguments where nothing is dropped, and its result is not used there.
    some = F.col("keep").isNotNull()
    nothing = F.lit(zlib.compress(b"\x80", 6))
    thinned = F.arrow_udf(_kept_text, "binary")(
        F.when(some, text).otherwise(F.lit("")), F.coalesce("n_lines", F.lit(1)), F.coalesce("keep", nothing)
    ).cast("string")
    fields = [F.when(some, thinned).otherwise(F.col("row").getField(c)).alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    return found.select(
        F.struct(*fields).alias("row"),
        F.when(some, F.col("n_lines")).otherwise(line_count(text)).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )


def line_count(text: Column) -> Column:
    whole = F.coalesce(text, F.lit(""))
    return F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1

"""Importance resampling of documents towards a target distribution.

Features are runs of consecutive words, hashed into a fixed number of buckets by CRC-32. A
bucket's gain is the logarithm of how much more frequent it is in the target than in the
documents, a document's weight the sum of the gains of its features, and the documents with
the largest weights plus Gumbel noise are drawn: sampling without replacement in proportion
to the exponential weights.

The CRCs are computed for many words at once. The distinct features of a batch are grouped
by length; those of one length form a matrix of bytes, and a table lookup per column carries
all checksums of the matrix one byte further. The results are scattered back to the places
of the features. A feature longer than ``LONGEST`` bytes, which hardly ever has company of
its length, is summed on its own.

Texts are read once: the first pass writes the bucket of every feature, two bytes each, and
counting and weighing read those. Only bucket counts reach the driver, as many as there are
buckets.

Results: a null text has no features and weight 0; a null id is hashed as an empty id and
comes first among ties; repeated rows are documents of their own with a rank each; an empty
table gives no rows, an empty target only smoothed counts; a text of any length is read
whole; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitlens.llm.common import Scratch, slices, utf8

BUCKETS = 10_000
RUN = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Bytes up to which features enter the matrices.
LONGEST = 256
#: Bytes of one matrix at most.
MATRIX = 1 << 24


def crc_table() -> np.ndarray:
    """The effect of one byte on a reflected CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = crc_table()
#: A-Z in lower case, digits and all bytes from 0x80 as they are, the rest a space.
_WORDS = bytes(b if chr(b).isdigit() or 97 <= b < 123 or b > 127 else b + 32 if 65 <= b < 91 else 32 for b in range(256))


def crc_by_length(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of every ``data[start : start + length]``, one matrix per length."""
    sums = np.zeros(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    bounds = np.flatnonzero(np.r_[True, np.diff(lengths[order]) != 0]) if len(order) else []
    for at, end in zip(bounds, [*bounds[1:], len(order)], strict=True):
        size = int(lengths[order[at]])
        if size > LONGEST:
            for i in order[at:end]:
                sums[i] = zlib.crc32(data[starts[i] : starts[i] + size])
            continue
        step = max(1, MATRIX // max(1, size))
        for low in range(at, end, step):
            rows = order[low : min(end, low + step)]
            matrix = data[starts[rows][:, None] + np.arange(size)]
            crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
            for column in range(size):
                crc = _TABLE[(crc ^ matrix[:, column]) & 255] ^ (crc >> np.uint32(8))
            sums[rows] = crc ^ np.uint32(0xFFFFFFFF)
    return sums


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts as one binary array, and how many each text has."""
    joined = np.frombuffer(b" ".join([*texts, b""]).translate(_WORDS), np.uint8)
    inside = joined != 32
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined[inside])])
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.r_[0, np.searchsorted(starts, text_ends)])
    return words, counts


def runs_of(words: pa.Array, counts: np.ndarray, run: int) -> tuple[pa.Array, np.ndarray]:
    """The runs of ``run`` words that lie in one text, joined by a space, and how many each has."""
    if run == 1:
        return words, counts
    fits = np.maximum(counts - run + 1, 0)
    firsts = np.repeat(np.cumsum(counts) - counts, fits) + np.arange(fits.sum()) - np.repeat(np.cumsum(fits) - fits, fits)
    parts = [words.take(pa.array(firsts + i)) for i in range(run)]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())), fits


def buckets_of(features: pa.Array, buckets: int) -> np.ndarray:
    """The bucket of every feature; each distinct feature is summed once."""
    coded = features.dictionary_encode()
    distinct = coded.dictionary
    if not len(distinct):
        return np.zeros(0, np.uint32)
    _, offsets, data = distinct.buffers()
    bounds = np.frombuffer(offsets, np.int32)[distinct.offset : distinct.offset + len(distinct) + 1]
    sums = crc_by_length(np.frombuffer(data, np.uint8), bounds[:-1].astype(np.int64), np.diff(bounds))
    return (sums % np.uint32(buckets))[coded.indices.to_numpy()]


def hashed_features(docs: DataFrame, columns: list[Column], text_col: str, run: int, buckets: int) -> DataFrame:
    """(_id, _words, _n, _buckets): the features' buckets, as little-endian numbers side by side."""
    width = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch, 1):
                part = batch.slice(start, stop - start)
                words, counts = words_of(utf8(part.column(1)))
                held = [runs_of(words, counts, n) for n in range(1, run + 1)]
                found = [(buckets_of(f, buckets).astype(width), np.r_[0, np.cumsum(n)]) for f, n in held]
                packed = [b"".join(b[e[i] : e[i + 1]].tobytes() for b, e in found) for i in range(len(counts))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array([len(p) // width.itemsize for p in packed], pa.int64()),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["_id", "_words", "_n", "_buckets"],
                )

    return docs.select(*columns, F.col(text_col).cast("string")).mapInArrow(hashed, "_id long, _words long, _n long, _buckets binary")


def bucket_counts(hashed: DataFrame, buckets: int) -> np.ndarray:
    """How many features fall in each bucket, over all rows."""
    width = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_buffer(), width), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counted = hashed.select("_buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(buckets, np.int64)
    for row in counted.collect():  # one row a bucket at most
        found[row.bucket] = row.n
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed target share over the smoothed source share), per bucket."""
    buckets = len(source)
    up = (target + 1).astype(float) * float(source.sum() + buckets)
    down = (source + 1).astype(float) * float(target.sum() + buckets)
    return np.floor(1000 * np.log(up / down)).astype(np.int64)


def noise(id_col: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    run: int = RUN,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank), one row per document; rank is null if not drawn."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "importance")
    own = scratch.keep(hashed_features(docs, [F.col(id_col).cast("long")], text_col, run, buckets))
    other = hashed_features(target, [F.lit(None).cast("long")], target_text_col, run, buckets)
    gain = gains(bucket_counts(own, buckets), bucket_counts(other, buckets))
    width = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def weigh(packed: pa.Array) -> pa.Array:
        return pa.array([int(gain[np.frombuffer(p.as_buffer(), width)].sum()) for p in packed], pa.int64())

    weight = F.arrow_udf(weigh, "long")("_buckets")
    scored = scratch.keep(
        own.select("_id", "_words", "_n", weight.alias("_weight")).withColumn("_score", F.col("_weight") + noise(F.col("_id"), seed))
    )
    fit = F.col("_words") >= least_words
    wanted = percent * scored.where(fit).count() // 100
    # Ranked without a sort in one task: ranges of the order, counted, then numbered within.
    order = [fit.desc(), F.col("_score").desc(), F.col("_id").asc_nulls_first(), F.col("_n"), F.col("_words")]
    placed = scratch.keep(scored.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = sorted((r._range, r.n) for r in placed.where(fit).groupBy("_range").agg(F.count("*").alias("n")).collect())
    before, offsets = 0, {}
    for number, n in sizes:
        if before < wanted:
            offsets[number] = before
        before += n
    # One number per partition, and only of ranges that hold drawn documents.
    offset = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in offsets.items() for x in pair]), F.col("_range").cast("long")) if offsets else F.lit(None).cast("long")
    inside = fit & F.col("_range").isin(*offsets) if offsets else F.lit(False)
    place = offset + F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    ranked = placed.where(inside).withColumn("_place", place).withColumn("rank", F.when(F.col("_place") <= wanted, F.col("_place"))).drop("_place")
    rest = placed.where(~inside).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(
        F.col("_id").alias("doc_id"), F.col("_n").alias("n_features"), F.col("_weight").alias("weight"), F.col("_score").alias("score"), "rank"
    )

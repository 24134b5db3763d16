"""Document fingerprints by locally consistent parsing.

A text is cut into blocks at places that depend on a few characters around them only:
runs of one symbol are joined, deterministic coin tossing (the lowest bit in which a symbol
differs from its left neighbour) shrinks the alphabet to six labels, and local maxima of
the labels start blocks. A block's name is a hash of its symbols. Names are symbols of the
next level, until one block is left, so phrases of about 3, 10, 30, 90 characters and so on
get names that do not depend on where they stand: equal substrings share all names but
those at their ends, and an edit changes only names near it.

A fingerprint samples the distinct names from the second level on by their hashes, which are
an eighth as large on each further level up to the seventh: long phrases are kept with higher
probability, all of them from there on. It holds every name with a hash below a fixed bound,
so it grows with the text (by about one name in two hundred characters), and at least the 64
smallest, so short texts have enough. Two fingerprints are compared below the smaller of the bounds up
to which each is complete. A passage of a few hundred words thus shows in texts of any
length; between short texts the standard error is up to 1/16.

Results: null is the empty text, whose fingerprint is empty; equal texts have equal
fingerprints; repeated rows are documents of their own, and each is followed by the next in
order; ties in the id are ordered by text and a null id comes last; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import U64, mix64, width

#: The first level whose names a fingerprint holds: about ten characters.
FIRST_KEPT = 2
#: Names a fingerprint holds at least, and the bound below which it holds all.
BITS, STEP, STEPS = 40, 3, 5
KEEP, BOUND = 64, 1 << (BITS - STEP * STEPS)
#: Characters parsed at a time.
BATCH = 1 << 20
_PLACES = mix64(np.arange(1, 257, dtype=U64))


def toss(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One coin tossing: neighbours that differ get labels that differ, from far fewer."""
    left = np.roll(symbols, 1)
    left[first] = symbols[first] ^ U64(1)
    differ = symbols ^ left
    low = differ & (~differ + U64(1))
    # The exponent of a power of two, read off its floating-point form.
    place = np.frexp(low.astype(np.float64))[1].astype(U64) - U64(1)
    return (place << U64(1)) | ((symbols >> place) & U64(1))


def join_runs(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol become one symbol named after symbol and length."""
    starts = np.r_[True, symbols[1:] != symbols[:-1]] | first
    if starts.all():
        return symbols, first
    at = np.flatnonzero(starts)
    length = np.diff(np.r_[at, len(symbols)]).astype(U64)
    head = symbols[at]
    with np.errstate(over="ignore"):
        named = np.where(length > 1, mix64(head + length * U64(0x9E3779B97F4A7C15)), head)
    return named, first[at]


def block_starts(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where blocks start: at each text's first symbol and at local maxima of its labels."""
    label = symbols
    for _ in range(4):
        label = toss(label, first)
    label = label.astype(np.int8)
    last = np.roll(first, -1)
    before, after = np.roll(label, 1), np.roll(label, -1)
    before[first], after[last] = 127, 127
    return (label > before) & (label > after) | first


def name_blocks(symbols: np.ndarray, starts: np.ndarray, level: int) -> np.ndarray:
    at = np.flatnonzero(starts)
    size = np.diff(np.r_[at, len(symbols)])
    place = np.arange(len(symbols)) - np.repeat(at, size)
    with np.errstate(over="ignore"):
        parts = mix64(symbols + _PLACES[place & 255]) * (place.astype(U64) | U64(1))
        return mix64(np.add.reduceat(parts, at) + U64(level) * U64(0xD6E8FEB86659FD93) + size.astype(U64))


def parse(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level the names of all texts' phrases and the text each belongs to."""
    some = [i for i, t in enumerate(texts) if t]
    if not some:
        return []
    joined = "".join(texts[i] for i in some)
    symbols = mix64(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(U64) + U64(1))
    lengths = np.array([len(texts[i]) for i in some])
    first = np.zeros(len(symbols), bool)
    first[np.cumsum(lengths) - lengths] = True
    out = []
    owners = np.array(some)
    while len(symbols):
        symbols, first = join_runs(symbols, first)
        starts = block_starts(symbols, first)
        symbols = name_blocks(symbols, starts, len(out) + 1)
        first = first[starts]
        owner = np.cumsum(first) - 1
        out.append((symbols, owners[owner]))
        # A text of one block is done.
        sizes = np.bincount(owner)
        go_on = (sizes > 1)[owner]
        symbols, first, owners = symbols[go_on], first[go_on], owners[sizes > 1]
    return out


def kept_hashes(names: np.ndarray, level: int) -> np.ndarray:
    """Hashes of a level's names: of ``BITS`` bits, and fewer on the next few levels."""
    shift = U64(64 - BITS + STEP * min(level - FIRST_KEPT, STEPS))
    return mix64(names ^ U64(0xA5A5A5A5)) >> shift


def fingerprints(texts: list[str]) -> list[str]:
    """The sampled hashes of each text's phrase names, as sorted hex of five bytes each."""
    levels = parse(texts)
    prints = [""] * len(texts)
    kept = list(enumerate(levels, 1))[FIRST_KEPT - 1 :]
    if not kept:
        return prints
    owner = np.concatenate([o for _, (_, o) in kept])
    hashed = np.concatenate([kept_hashes(names, level) for level, (names, _) in kept])
    ordered = np.unique((owner.astype(U64) << U64(BITS)) | hashed)
    owner = (ordered >> U64(BITS)).astype(np.int64)
    values = ordered & U64((1 << BITS) - 1)
    spelled = values.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()
    bounds = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    for start, stop in zip(bounds, np.r_[bounds[1:], len(owner)], strict=True):
        below = int(np.searchsorted(values[start:stop], BOUND))
        prints[owner[start]] = spelled[5 * start : 5 * min(stop, start + max(KEEP, below))].hex()
    return prints


def hashes_of(print_: str) -> np.ndarray:
    parts = np.frombuffer(bytes.fromhex(print_), np.uint8).reshape(-1, 5)
    whole = np.zeros((len(parts), 8), np.uint8)
    whole[:, 3:] = parts
    return whole.view(">u8").ravel().astype(np.int64)


def complete_to(values: np.ndarray) -> int:
    """Up to which hash a fingerprint holds all names of its text."""
    if len(values) < KEEP:
        return 1 << BITS
    return max(BOUND - 1, int(values[-1]))


def likeness(one: str, two: str) -> float:
    """Share of common phrases where both fingerprints are complete: their estimated resemblance."""
    if one == two:
        return 1.0
    if not one or not two:
        return 0.0
    a, b = hashes_of(one), hashes_of(two)
    end = min(complete_to(a), complete_to(b))
    a, b = a[a <= end], b[b <= end]
    both = np.union1d(a, b)
    return float(np.intersect1d(a, b, assume_unique=True).size / both.size) if both.size else 0.0


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the following document's start."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_block, _guest, _id, _text): documents by descending id, each block ending in a guest.

    Blocks are ranges of ids between existing ids, so a block's first document is known by
    its id. A copy of it goes to the block before as the guest, that of the first block to
    the last. Neighbours thus meet in one task without a global sort in one task.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("_at"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"),
    )
    wanted = 4 * width(docs.sparkSession)
    top, cuts = rows.agg(
        F.max("_at"), F.percentile_approx("_at", [i / wanted for i in range(1, wanted)] or [0.5], 10_000)
    ).first()
    bounds = np.array(sorted({top, *(cuts or [])}, reverse=True)) if top is not None else np.zeros(0, np.int64)
    ascending = np.sort(bounds[1:])

    def block(at: pa.Array) -> pa.Array:
        # How many later blocks start at or above this id.
        ids = at.to_numpy(zero_copy_only=False)
        return pa.array((len(ascending) - np.searchsorted(ascending, ids, side="left")).astype(np.int32))

    number = F.arrow_udf(block, "int")("_at")
    before = F.when(F.col("_at").isin(*map(int, bounds)), F.pmod(F.col("_block") - 1, F.lit(max(1, len(bounds)))))
    places = F.array_compact(
        F.array(
            F.struct(F.col("_block").alias("block"), F.lit(False).alias("guest")),
            F.when(before.isNotNull(), F.struct(before.alias("block"), F.lit(True).alias("guest"))),
        )
    )
    dealt = rows.withColumn("_block", number).withColumn("_place", F.explode(places))
    return (
        dealt.select(F.col("_place.block").alias("_block"), F.col("_place.guest").alias("_guest"), "_id", "_at", "_text")
        .repartition(width(docs.sparkSession), "_block")
        .sortWithinPartitions("_block", "_guest", F.col("_at").desc(), "_text")
        .select("_block", "_guest", "_id", "_text")
    )


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likenesses."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        size, done = 0, None
        for batch in batches:
            for block, guest, ident, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if guest:
                    if block != done and held:
                        held.append((ident, text))
                        yield emit(held)
                        held, size = [], 0
                    done = block
                    continue
                held.append((ident, text))
                size += len(text)
                if size > BATCH and len(held) > 1:
                    yield emit(held)
                    held, size = held[-1:], len(text)

    def emit(held: list[tuple[int | None, str]]) -> pa.RecordBatch:
        texts = [t for _, t in held]
        changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        n = len(changed)
        prints = fingerprints(texts + changed)
        own, other = prints[: n + 1], prints[n + 1 :]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in held[:n]], pa.int64()),
                pa.array([len(t) for t in texts[:n]], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
                pa.array(own[:n], pa.string()),
                pa.array(other, pa.string()),
                pa.array([likeness(a, b) for a, b in zip(own, other, strict=False)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own, own[1:], strict=False)], pa.float64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    return in_order(docs, id_col, text_col).mapInArrow(
        pairs,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )

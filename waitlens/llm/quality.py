"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its evidence is a vector of surface features of the line itself
and of both neighbours; two transition weights say how far good lines and bad lines keep
company. Training takes a document's label as the label of its lines and maximises the
conditional likelihood. A document's score is the mean probability of a good line, from
forward-backward marginals, weighted by line length, then put through a fitted logistic
curve so that 0.5 is the right place to cut.

The model is a few dozen numbers. It is fitted on a bounded sample of labelled documents
(``TRAIN_DOCS``, of those with at most ``TRAIN_LINES`` lines) and applied to whole texts in
Arrow batches, without a shuffle.

Results: null and empty texts are scored as one empty line; repeated rows score alike; an
empty table gives no rows; with no usable labels every score is 0.5; other columns are
ignored; all lines of a text of any length are labelled when it is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import slices, utf8

#: Bounds of the sample the model is fitted on.
TRAIN_DOCS, TRAIN_LINES = 3000, 400
ROUNDS = 150
RIDGE = 2.0

_NEWLINE = 10


def _members(chars: str | bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(chars if isinstance(chars, bytes) else chars.encode())] = 1
    return table


_UPPER = _members(bytes(range(65, 91)))
_LOWER = _members(bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGIT = _members(b"0123456789")
_SPACE = _members(b" \t\n\r\v\f")
_PROSE = _members(b".,;:'\"?-()")
_SHOUT = _members(b"!")
_OTHER = ((_UPPER | _LOWER | _DIGIT | _SPACE | _PROSE | _SHOUT) == 0).astype(np.uint8)
_PER_LINE = 12


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, length of each line, number of lines of each text).

    A text without any line that is not blank counts as one empty line.
    """
    whole = b"\n".join(texts) + b"\n"
    data = np.frombuffer(whole, np.uint8)
    ends = np.flatnonzero(data == _NEWLINE)
    starts = np.r_[0, ends[:-1] + 1]
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(text_ends, starts, side="right")

    def per_line(flags: np.ndarray) -> np.ndarray:
        # Every line ends with its newline, so no range is empty.
        return np.add.reduceat(flags, starts, dtype=np.int64)

    upper, lower, digit, space, prose, shout, other = (
        per_line(t[data]) for t in (_UPPER, _LOWER, _DIGIT, _SPACE, _PROSE, _SHOUT, _OTHER)
    )
    length = ends - starts
    blank = _SPACE[data]
    begins = np.flatnonzero((blank == 0) & (np.r_[1, blank[:-1]] == 1))
    stops = np.flatnonzero((np.r_[blank[1:], 1] == 1) & (blank == 0)) + 1
    word_line = np.searchsorted(ends, begins)
    words = np.bincount(word_line, minlength=len(starts))
    size = stops - begins
    short = np.bincount(word_line[size <= 3], minlength=len(starts))
    marked = np.bincount(word_line[_OTHER[data[stops - 1]] == 1], minlength=len(starts)) if len(stops) else words * 0

    lines = whole[:-1].split(b"\n")
    distinct = np.fromiter((len(set(line.split())) for line in lines), np.int64, len(lines))
    again = np.fromiter((0, *(a == b for a, b in zip(lines, lines[1:], strict=False))), np.float64, len(lines))
    last = np.where(length > 0, data[np.maximum(ends - 1, 0)], 0)

    solid = np.maximum(length + 1 - space, 1)
    n = np.maximum(words, 1)
    features = np.stack(
        [
            np.log1p(words),
            upper / np.maximum(upper + lower, 1),
            other / solid,
            shout / n,
            digit / solid,
            prose / n,
            (solid / n) / 10,
            np.log((distinct + 1) / (words + 1)),
            short / n,
            marked / n,
            np.isin(last, (33, 46, 63)).astype(float),
            again * (length > 0),
        ],
        axis=1,
    )
    keep = words > 0
    some = np.zeros(len(texts), bool)
    some[owner[keep]] = True
    # The first line stands for a text that has only blank ones.
    first = np.r_[True, owner[1:] != owner[:-1]]
    keep |= first & ~some[owner]
    return features[keep], np.maximum(length[keep], 1), np.bincount(owner[keep], minlength=len(texts))


def with_neighbours(features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features, and whether there is such a neighbour."""
    ends = np.cumsum(counts)
    is_first = np.zeros(len(features), bool)
    is_last = np.zeros(len(features), bool)
    is_first[ends - counts] = True
    is_last[ends - 1] = True
    before = np.roll(features, 1, axis=0) * ~is_first[:, None]
    after = np.roll(features, -1, axis=0) * ~is_last[:, None]
    return np.hstack([np.ones((len(features), 1)), features, before, after, is_first[:, None], is_last[:, None]])


@dataclass(frozen=True)
class LineChain:
    """Weights of the field: ``unary`` for good over bad, and two for staying good or bad."""

    unary: np.ndarray
    stay_good: float
    stay_bad: float
    slope: float = 1.0
    shift: float = 0.0
    centre: np.ndarray | float = 0.0
    spread: np.ndarray | float = 1.0

    def marginals(self, odds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each line: P(good), P(this and the next good), P(both bad); of each text: log Z.

        All texts advance together, longest first, so step t touches those longer than t.
        """
        order = np.argsort(-counts, kind="stable")
        starts = (np.cumsum(counts) - counts)[order]
        lengths = counts[order]
        steps = int(lengths[0]) if len(lengths) else 0
        active = np.searchsorted(-lengths, -np.arange(steps), side="left")
        forward = np.empty((len(odds), 2))
        backward = np.zeros((len(odds), 2))
        for t in range(steps):
            at = starts[: active[t]] + t
            if t == 0:
                forward[at, 0], forward[at, 1] = odds[at], 0.0
                continue
            good, bad = forward[at - 1, 0], forward[at - 1, 1]
            forward[at, 0] = odds[at] + np.logaddexp(good + self.stay_good, bad)
            forward[at, 1] = np.logaddexp(good, bad + self.stay_bad)
        for t in range(steps - 2, -1, -1):
            at = starts[: active[t + 1]] + t
            good, bad = odds[at + 1] + backward[at + 1, 0], backward[at + 1, 1]
            backward[at, 0] = np.logaddexp(good + self.stay_good, bad)
            backward[at, 1] = np.logaddexp(good, bad + self.stay_bad)
        ends = np.cumsum(counts) - 1
        log_z = np.logaddexp(forward[ends, 0], forward[ends, 1])
        z = np.repeat(log_z, counts)
        p = np.exp(np.minimum(0.0, forward[:, 0] + backward[:, 0] - z))
        both_good, both_bad = np.zeros(len(odds)), np.zeros(len(odds))
        inner = np.ones(len(odds), bool)
        inner[ends] = False
        i = np.flatnonzero(inner)
        both_good[i] = np.exp(np.minimum(0.0, forward[i, 0] + self.stay_good + odds[i + 1] + backward[i + 1, 0] - z[i]))
        both_bad[i] = np.exp(np.minimum(0.0, forward[i, 1] + self.stay_bad + backward[i + 1, 1] - z[i]))
        return p, both_good, both_bad, log_z

    def raw(self, features: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Length-weighted mean of P(good) of each text, as log odds."""
        odds = with_neighbours((features - self.centre) / self.spread, counts) @ self.unary
        p = self.marginals(odds, counts)[0]
        starts = np.cumsum(counts) - counts
        mean = np.add.reduceat(p * lengths, starts) / np.add.reduceat(lengths, starts)
        mean = np.clip(mean, 1e-6, 1 - 1e-6)
        return np.log(mean / (1 - mean))

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return _logistic(self.slope * self.raw(*line_features(texts)) + self.shift)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_chain(features: np.ndarray, lengths: np.ndarray, counts: np.ndarray, good: np.ndarray, rounds: int = ROUNDS) -> LineChain:
    """Maximum penalised likelihood by Adam on the exact gradient, then the logistic curve."""
    centre, spread = features.mean(axis=0), np.maximum(features.std(axis=0), 1e-3)
    design = with_neighbours((features - centre) / spread, counts)
    line_good = np.repeat(good, counts).astype(float)
    stays = counts - 1
    theta = np.zeros(design.shape[1] + 2)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        model = LineChain(theta[:-2], theta[-2], theta[-1])
        p, both_good, both_bad, _ = model.marginals(design @ theta[:-2], counts)
        gradient = np.r_[
            design.T @ (line_good - p),
            (stays * good).sum() - both_good.sum(),
            (stays * ~good).sum() - both_bad.sum(),
        ]
        gradient = (gradient - RIDGE * theta) / len(counts)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta += 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    model = LineChain(theta[:-2], float(theta[-2]), float(theta[-1]), 1.0, 0.0, centre, spread)
    slope, shift = _curve(model.raw(features, lengths, counts), good.astype(float))
    return LineChain(model.unary, model.stay_good, model.stay_bad, slope, shift, centre, spread)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (never negative) and shift of a logistic curve, by damped Newton steps."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    w = np.array([0.5, 0.0])
    for _ in range(50):
        p = _logistic(design @ w)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2) * len(x) ** 0.5
        w += np.clip(np.linalg.solve(hessian, design.T @ (y - p) - 1e-3 * w), -1, 1)
    return float(max(w[0], 1e-3)), float(w[1])


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels must not be learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most_docs: int = TRAIN_DOCS,
    most_lines: int = TRAIN_LINES,
) -> LineChain | None:
    """Fit on at most ``most_docs`` labelled documents, drawn by a hash of their id.

    The drawn labels are few by their bound, so they are broadcast and texts stay where
    they are read. Only the line features of the drawn documents reach the driver.
    """
    drawn = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
        .select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_good"))
        .groupBy("_id")
        .agg(F.min("_good").alias("_good"))
        .orderBy(F.xxhash64("_id", F.lit(29)), "_id")
        .limit(most_docs)
    )
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch, 1):
                features, lengths, counts = line_features(utf8(batch.column(1)[start:stop]))
                at = np.cumsum(counts) - counts
                rows = [i for i in range(len(counts)) if counts[i] <= most_lines]
                part = lambda a, i: a[at[i] : at[i] + counts[i]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[start:stop].take(pa.array(rows, pa.int64())),
                        batch.column(2)[start:stop].take(pa.array(rows, pa.int64())),
                        pa.array([part(features, i).astype(np.float32).tobytes() for i in rows], pa.binary()),
                        pa.array([part(lengths, i).astype(np.int64).tobytes() for i in rows], pa.binary()),
                    ],
                    names=["_id", "_good", "_features", "_lengths"],
                )

    rows = (
        texts.join(F.broadcast(drawn), "_id")
        .select("_id", "_text", "_good")
        .mapInArrow(measure, "_id long, _good int, _features binary, _lengths binary")
        .dropDuplicates(["_id", "_features"])
        .collect()
    )
    rows.sort(key=lambda r: (r[0], r[2]))
    good = np.array([r[1] == 1 for r in rows], bool)
    if not len(good) or good.all() or not good.any():
        return None
    features = np.concatenate([np.frombuffer(r[2], np.float32).reshape(-1, _PER_LINE) for r in rows]).astype(float)
    lengths = np.concatenate([np.frombuffer(r[3], np.int64) for r in rows])
    counts = np.array([len(r[3]) // 8 for r in rows])
    return fit_chain(features, lengths, counts, good)


def score(text: Column, model: LineChain | None) -> Column:
    """Probability that a text is good, as a column."""
    if model is None:
        return F.lit(0.5)

    def scored(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [model.score(utf8(texts[a:b])) for a, b in slices(batch, 0)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return F.arrow_udf(scored, "double")(text.cast("string"))


def rate(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document."""
    model = train(docs, labels, id_col, text_col)
    scored = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), score(F.col(text_col), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

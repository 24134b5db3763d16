"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a target in words. A document is taken as many whole times as the target
holds its source; the rest of the budget goes to a subset of documents. That subset is
found on counts of documents by exact length, never on documents: first the same share of
every length, then a bounded-knapsack dynamic program over what the rounding left. The
documents of a length are then chosen in seeded order.

Results: a null text has size 0 and a null source is a source of its own, last in order;
repeated rows are documents of their own; an empty table gives no rows; a text of any length
counts with its whole size, other columns are ignored. ``taken`` is a
multiple (0, 1 or 2 times) of the document's size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitlens.llm.common import Scratch, utf8
from waitlens.operators.dims import dense_key
from waitlens.session import settled_folder

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
#: A document is repeated this often at most.
REPEATS = 2
#: Words the dynamic program fits at most; more is first met by single documents.
EXACT_WORDS = 65_536
#: Hot (source, length) groups are ranked in so many parts.
PARTS = 64


def size_of(text: Column) -> Column:
    """Number of maximal runs without ASCII white space; bytes.split() cuts at exactly those six."""

    def count(texts: pa.Array) -> pa.Array:
        return pa.array([len(t.split()) for t in utf8(texts)], pa.int64())

    return F.arrow_udf(count, "long")(text)


def targets(sizes: DataFrame, weights: Sequence[float], share: float, repeats: int, scratch: Scratch) -> DataFrame:
    """(_key, source_size) with a target each: ``share`` of all words dealt by weight.

    Sources in order of their key take the weights in turn. A target above ``repeats`` times
    its source stops there and the excess is dealt again among the others. Only sums reach
    the driver; each round settles at least one source or is the last.
    """
    turn = F.pmod(F.col("_turn") - 1, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    # The folder of the settled ranks goes with the block.
    with settled_folder(sizes.sparkSession):
        table = scratch.keep(
            dense_key(sizes, ["_key"], "_turn").select("_key", "source_size", weight.alias("_weight"))
        )
    cap = F.col("source_size") * F.lit(float(repeats))
    total = share * float(table.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    level = None
    while True:
        # A source is capped when its share at the last level was above its cap.
        capped = F.lit(False) if level is None else F.col("_weight") * F.lit(level) > cap
        spent, weight_left = table.agg(
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~capped, F.col("_weight"))), F.lit(0.0)),
        ).first()
        if not weight_left:
            break
        new = max((total - spent) / weight_left, level or 0.0)
        if level is not None and new == level:
            break
        level = new
    goal = F.least(F.col("_weight") * F.lit(level or 0.0), cap)
    return table.select("_key", "source_size", goal.alias("target"))


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, seed: int) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest ``budget``.

    ``sizes`` are distinct and positive. The sum may pass the budget if that is nearer.
    """
    total = int((sizes * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros_like(counts)
    if budget >= total:
        return counts.copy()
    taken = (counts.astype(object) * budget // total).astype(np.int64)
    left = budget - int((sizes * taken).sum())
    order = np.random.default_rng(seed).permutation(len(sizes))
    while left > EXACT_WORDS:
        # The rounding left less than one document of every length.
        before = left
        for i in order:
            if left <= EXACT_WORDS:
                break
            if taken[i] < counts[i] and sizes[i] <= left:
                taken[i] += 1
                left -= int(sizes[i])
        if left == before:
            break
    # Bounded knapsack: bit b of ``reach`` says that b words can be met exactly. A length
    # with c documents enters as blocks of 1, 2, 4, ... documents.
    most = 2 * left
    mask = (1 << (most + 1)) - 1
    reach, steps = 1, []
    for i in order:
        size, spare = int(sizes[i]), int(counts[i] - taken[i])
        spare = min(spare, most // size)
        block = 1
        while spare > 0 and not reach >> left & 1:
            block = min(block, spare)
            steps.append((i, block, reach))
            reach |= reach << (size * block) & mask
            spare -= block
            block *= 2
        if reach >> left & 1:
            break
    at = (reach & ((1 << (left + 1)) - 1)).bit_length() - 1
    above = reach >> (left + 1)
    if above:
        higher = left + (above & -above).bit_length()
        at = higher if higher - left < left - at else at
    for i, block, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += block
            at -= int(sizes[i]) * block
    return taken


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    repeats: int = REPEATS,
    seed: int = 17,
    carry: str | None = None,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken), one row per document.

    ``carry`` names a column to hand through, for a caller whose ids are not unique.
    """
    with Scratch(docs.sparkSession, "mix") as scratch:
        return scratch.finish(_mixed(docs, id_col, text_col, source_col, weights, share, repeats, seed, carry, scratch))


def _mixed(docs, id_col, text_col, source_col, weights, share, repeats, seed, carry, scratch) -> DataFrame:
    carried = [] if carry is None else [F.col(carry).alias("_carry")]
    key = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col).cast("string")))
    order = F.xxhash64(F.lit(seed), F.col(id_col))
    sized = scratch.keep(
        docs.select(
            F.col(id_col).cast("long").alias("_id"),
            key.alias("_key"),
            order.alias("_order"),
            size_of(F.col(text_col)).alias("_size"),
            *carried,
        ).withColumn("_part", F.pmod(F.shiftrightunsigned("_order", 33), F.lit(PARTS)).cast("int"))
    )
    parts = scratch.keep(sized.groupBy("_key", "_size", "_part").agg(F.count("*").alias("_n")))
    lengths = parts.groupBy("_key", "_size").agg(F.sum("_n").alias("_n"))
    totals = lengths.groupBy("_key").agg(F.sum(F.col("_size") * F.col("_n")).alias("source_size"))
    goals = scratch.keep(targets(totals, weights, share, repeats, scratch))

    whole = F.when(
        F.col("source_size") > 0,
        F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(repeats)),
    ).otherwise(F.lit(0)).cast("long")
    goal = F.col("target").cast("long")
    asked = goals.withColumn("_whole", whole).withColumn("_rest", goal - F.col("_whole") * F.col("source_size"))

    def choose(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by("_size")
        sizes, counts = group.column("_size").to_numpy(), group.column("_n").to_numpy()
        budget = group.column("_rest")[0].as_py()
        picked = np.zeros(len(sizes), np.int64)
        some = sizes > 0
        picked[some] = fit(sizes[some], counts[some], budget, seed)
        return group.select(["_key", "_size"]).append_column("_pick", pa.array(picked))

    picks = lengths.join(asked.select("_key", "_rest"), "_key").groupBy("_key").applyInArrow(
        choose, "_key string, _size long, _pick long"
    )
    running = Window.partitionBy("_key", "_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = parts.join(picks, ["_key", "_size"]).select(
        "_key",
        "_size",
        "_part",
        (F.col("_pick") - F.coalesce(F.sum("_n").over(running), F.lit(0))).alias("_quota"),
    )
    rank = F.row_number().over(Window.partitionBy("_key", "_size", "_part").orderBy("_order", "_id"))
    chosen = (
        sized.join(shares, ["_key", "_size", "_part"])
        .withColumn("_extra", (rank <= F.col("_quota")).cast("long"))
        .join(asked.select("_key", "source_size", "target", "_whole"), "_key")
    )
    copies = F.col("_whole") + F.col("_extra")
    return chosen.select(
        F.col("_id").alias("doc_id"),
        F.when(F.col("_key") != "1", F.substring("_key", 2, 1 << 30)).alias("source"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("_size")).alias("taken"),
        *([] if carry is None else [F.col("_carry").alias(carry)]),
    )

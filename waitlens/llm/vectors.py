"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells.

Only vectors of the same label and dimension are compared. Equal vectors form a class first.
Each label's unit vectors are assigned to the nearest of its centres; a vector also visits
every cell whose boundary is so near that a partner may live behind it. That rule is exact:
if x lives with centre c and y with c', then y is on the far side of the plane halfway
between both, and an angle of arccos(threshold) reaches no further than the sine of that
angle beyond it. So every pair above the threshold is found, once from either end.

Cells are compared block against block, so a task holds two blocks whatever the size of a
cell. A block pair yields counts and a spanning forest of its links, never all its pairs.

Results: vectors that are null, zero, empty, or hold null or non-finite components, and
those with a null label or a null id, link with nothing and are their own component;
repeated rows link with each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import Scratch
from waitlens.llm.components import components, local_roots

#: Vectors of a label the centres are learnt from, at most. Every vector is assigned.
SAMPLE = 4096
#: Vectors per cell aimed at, and centres of a label at most (cells then grow instead).
CELL, MOST_CENTRES = 1024, 4096
ROUNDS = 8
#: Vectors of a label assigned by one task, and vectors of a cell in one block.
CHUNK, BLOCK = 8192, 1024


def unit_rows(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(_id, _label, _dim, _key, _unit): the key is null where a vector cannot link."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            lists = batch.column(1)
            dims, keys, units = [], [], []
            for i in range(batch.num_rows):
                dim = key = unit = None
                if lists[i].is_valid and ids[i] is not None and labels[i] is not None:
                    v = lists[i].values.to_numpy(zero_copy_only=False).astype(np.float64)
                    largest = np.abs(v).max() if len(v) else 0.0
                    if np.isfinite(largest) and largest > 0:
                        scaled = v / largest
                        dim, unit = len(v), (scaled / np.sqrt(scaled @ scaled)).tobytes()
                        key = hashlib.blake2b(
                            f"{labels[i]}/".encode() + (v + 0.0).tobytes(), digest_size=16
                        ).digest()
                dims.append(dim)
                keys.append(key)
                units.append(unit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(units, pa.binary())],
                names=["_id", "_label", "_dim", "_key", "_unit"],
            )

    narrow = vectors.select(
        F.col(id_col).cast("long"), F.col(vec_col).cast("array<double>"), F.col(label_col).cast("string")
    )
    return narrow.mapInArrow(read, "_id long, _label string, _dim int, _key binary, _unit binary")


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def spherical_centres(units: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """``k`` unit centres or fewer, by Lloyd rounds on cosine from a seeded start."""
    rng = np.random.default_rng(11)
    centres = units[rng.choice(len(units), min(k, len(units)), replace=False)]
    for _ in range(rounds):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        norms = np.sqrt((sums**2).sum(axis=1))
        centres = sums[norms > 1e-12] / norms[norms > 1e-12, None]
    return np.unique(centres, axis=0)


def cells(classes: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """(_label, _dim, _cell, cid, home): the cell each class lives in and those it visits."""
    reach = math.sqrt(max(0.0, 1 - threshold * threshold)) + 1e-9
    groups = scratch.keep(classes.groupBy("_label", "_dim").agg(F.count("*").alias("_n")))
    share = F.least(F.lit(1.0), F.lit(float(SAMPLE)) / F.col("_n"))
    draw = F.pmod(F.xxhash64("cid", F.lit(3)), F.lit(1 << 20)) / F.lit(1 << 20)
    sample = classes.join(groups, ["_label", "_dim"]).where(draw < share)

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by("cid").combine_chunks()
        dim, n = group.column("_dim")[0].as_py(), group.column("_n")[0].as_py()
        k = min(MOST_CENTRES, max(1, n // CELL), max(1, group.num_rows // 4))
        centres = spherical_centres(_matrix(group.column("_unit"), dim), k)
        return pa.table({
            "_label": group.column("_label").slice(0, 1),
            "_dim": group.column("_dim").slice(0, 1),
            "_centres": pa.array([centres.tobytes()], pa.binary()),
        })

    centres = scratch.keep(
        sample.select("_label", "_dim", "_n", "cid", "_unit")
        .groupBy("_label", "_dim")
        .applyInArrow(learn, "_label string, _dim int, _centres binary")
    )
    # A label's vectors are assigned in chunks, each with the label's centres beside it.
    chunks = F.ceil(F.col("_n") / CHUNK).cast("int")
    rows = classes.join(groups, ["_label", "_dim"]).select(
        "_label", "_dim", F.pmod(F.xxhash64("cid", F.lit(9)), chunks).cast("int").alias("_chunk"), "cid", "_unit"
    )
    # A label of which nothing was drawn keeps a single cell around no centre at all.
    beside = (
        groups.join(centres, ["_label", "_dim"], "left")
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select("_label", "_dim", "_chunk", "_centres")
    )

    def assign(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        if not left.num_rows:
            return pa.table({"_label": pa.array([], pa.string()), "_dim": pa.array([], pa.int32()), "_cell": pa.array([], pa.int32()), "cid": pa.array([], pa.int64()), "home": pa.array([], pa.bool_())})
        dim = left.column("_dim")[0].as_py()
        packed = right.column("_centres")[0].as_py()
        units = _matrix(left.column("_unit"), dim)
        centre = np.zeros((1, dim)) if packed is None else np.frombuffer(packed, np.float64).reshape(-1, dim)
        gaps = np.sqrt(np.maximum(0.0, 2 - 2 * np.clip(centre @ centre.T, -1, 1)))
        np.fill_diagonal(gaps, 1.0)
        index, cell, home = [], [], []
        for at in range(0, len(units), 1024):
            near = units[at : at + 1024] @ centre.T
            mine = near.argmax(axis=1)
            rows_ = np.arange(len(mine))
            # Distance to the plane halfway between the own centre and each other one.
            depth = (near[rows_, mine][:, None] - near) / np.maximum(gaps[mine], 1e-12)
            i, c = np.nonzero(depth <= reach)
            index.append(i + at)
            cell.append(c)
            home.append(mine[i] == c)
        index = np.concatenate(index)
        return pa.table({
            "_label": left.column("_label").take(pa.array(index)),
            "_dim": left.column("_dim").take(pa.array(index)),
            "_cell": pa.array(np.concatenate(cell).astype(np.int32)),
            "cid": left.column("cid").take(pa.array(index)),
            "home": pa.array(np.concatenate(home)),
        })

    by = ["_label", "_dim", "_chunk"]
    return rows.groupBy(*by).cogroup(beside.groupBy(*by)).applyInArrow(
        assign, "_label string, _dim int, _cell int, cid long, home boolean"
    )


def block_links(placed: DataFrame, threshold: float) -> DataFrame:
    """(u, v, n): with v null, u has n linked vectors more; else u and v are connected.

    ``placed`` has (_label, _dim, _cell, cid, home, copies, _unit). Residents of a cell meet
    all of its rows, residents and visitors.
    """
    counts = placed.groupBy("_label", "_dim", "_cell").agg(
        F.count_if("home").alias("_homes"), F.count("*").alias("_all")
    )
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / BLOCK).cast("int"))
    rows = (
        placed.join(counts, ["_label", "_dim", "_cell"])
        .where("_homes > 0")
        .withColumns({"_hb": blocks("_homes"), "_ab": blocks("_all")})
    )
    spot = lambda n: F.pmod(F.xxhash64("cid", F.lit(21)), F.col(n)).cast("int")
    keep = ["_label", "_dim", "_cell", "cid", "copies", "_unit"]
    mine = rows.where("home").select(
        *keep, F.lit(True).alias("_mine"), spot("_hb").alias("_i"), F.explode(F.sequence(F.lit(0), F.col("_ab") - 1)).alias("_j")
    )
    others = rows.select(
        *keep, F.lit(False).alias("_mine"), F.explode(F.sequence(F.lit(0), F.col("_hb") - 1)).alias("_i"), spot("_ab").alias("_j")
    )

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        dim = group.column("_dim")[0].as_py()
        here = group.column("_mine").to_numpy()
        units = _matrix(group.column("_unit"), dim)
        ids, copies = group.column("cid").to_numpy(), group.column("copies").to_numpy()
        a, b = np.flatnonzero(here), np.flatnonzero(~here)
        linked = (units[a] @ units[b].T >= threshold) & (ids[a][:, None] != ids[b][None, :])
        counts = linked @ copies[b] if len(b) else np.zeros(len(a), np.int64)
        left, right = np.nonzero(linked)
        # Rows of one class may stand on both sides: they are one vertex.
        names, vertex = np.unique(ids, return_inverse=True)
        label = local_roots(vertex[a][left], vertex[b][right], len(names))
        moved = np.flatnonzero(label != np.arange(len(names)))
        some = counts > 0
        u = np.r_[ids[a][some], names[moved]]
        v = pa.array(np.r_[np.zeros(some.sum(), np.int64), names[label[moved]]], mask=np.r_[np.ones(some.sum(), bool), np.zeros(len(moved), bool)])
        return pa.table({"u": pa.array(u), "v": v, "n": pa.array(np.r_[counts[some], np.zeros(len(moved), np.int64)])})

    return (
        mine.unionByName(others)
        .groupBy("_label", "_dim", "_cell", "_i", "_j")
        .applyInArrow(compare, "u long, v long, n long")
    )


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per vector."""
    with Scratch(vectors.sparkSession, "vectors") as scratch:
        return scratch.finish(_linked(vectors, id_col, vec_col, label_col, threshold, scratch))


def _linked(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, threshold: float, scratch: Scratch) -> DataFrame:
    base = scratch.keep(unit_rows(vectors, id_col, vec_col, label_col))
    classes = scratch.keep(
        base.where("_key IS NOT NULL")
        .groupBy("_key")
        .agg(
            F.min("_id").alias("cid"),
            F.count("*").alias("copies"),
            F.first("_label").alias("_label"),
            F.first("_dim").alias("_dim"),
            F.first("_unit").alias("_unit"),
        )
    )
    placed = cells(classes, threshold, scratch).join(classes.select("cid", "copies", "_unit"), "cid")
    found = scratch.keep(block_links(scratch.keep(placed), threshold))
    counts = found.where("v IS NULL").groupBy("u").agg(F.sum("n").alias("_near"))
    roots = scratch.keep(components(found.where("v IS NOT NULL").select("u", "v"), scratch))
    named = (
        classes.select("_key", "cid", "copies")
        .join(counts, F.col("cid") == F.col("u"), "left")
        .join(roots, F.col("cid") == F.col("vertex"), "left")
        .select(
            "_key",
            (F.coalesce("_near", F.lit(0)) + F.col("copies") - 1).alias("_links"),
            F.coalesce("root", "cid").alias("_component"),
        )
    )
    component = F.coalesce("_component", "_id")
    return (
        base.select("_id", "_key")
        .join(scratch.keep(named), "_key", "left")
        .select(
            F.col("_id").alias("vec_id"),
            F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"),
        )
    )

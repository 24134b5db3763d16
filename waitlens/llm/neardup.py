"""Near-duplicate documents: chosen-path set similarity join on word shingles.

A document's set is its distinct runs of words. Equal sets form a class, of which one goes
on. Independent trees then split the classes: a node picks one of the minwise coordinates,
or two, so that 1 / threshold are picked on average, and a document moves to the child its
minwise token at that coordinate names. A pair of similarity s meets in 1.25 s children on
average, at least one from the threshold on, so it tends to stay together all the way down,
while others part quickly. Nodes of a few documents are compared exhaustively by signature
inside one task. Several trees bring the chance to miss a pair near zero.

Large nodes branch on, twice. Groups of near copies do not part by branching, so each large
node also proposes its members' links to its smallest member, and a node whose members are
all in one confirmed component has nothing left to find and ends. What is still large and
mixed is compared in blocks on full sets, so no pair is left out for the size of a node:
everyone against those outside the node's largest component, whose members need no
comparison with one another. Only links that connect something leave a task. Nodes with
many rows are known by their counts and never dealt to one task.

Every proposed link is confirmed on the full sets. Proposals are confirmed forest first:
one per document, then those between components that are still apart. Thus links inside a
component, of which a large group has a square number, are never listed.

Results: null, empty and white-space texts have an empty set and link with nothing; a null
id links with nothing, its component is null and it is kept; repeated rows share a
component; an empty table gives no rows; other columns are ignored; a text of any length
is one set, as large as it has distinct runs of words. Ids are taken to be
unique: of two texts under one id each row follows its own.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import U64, Scratch, WordTable, mix64, slices, utf8, width
from waitlens.llm.components import components, local_roots

#: Minwise coordinates of a document.
COORDINATES = 64
TREES = 12
#: A node of so many classes is compared exhaustively.
SMALL = 64
#: Levels of the trees, the roots included.
LEVELS = 3
#: Nodes with more than one row in so many meet their rows by broadcast; no more can be.
HOT_SHARE = 8192
#: So far below the threshold an estimate may lie: six standard deviations. All trees share
#: the signature, so what falls below is lost in all of them; links are confirmed exactly.
SLACK = 0.3
BLOCK = 512
#: Names of a membership matrix at a time.
COLUMNS = 8192

_SEEDS = mix64(np.arange(1, COORDINATES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
_PLACES = mix64(np.arange(101, 101 + 64, dtype=U64)) | U64(1)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit names of the runs of ``size`` word hashes; a shorter text is one run."""
    if not len(words):
        return words
    run = min(size, len(words))
    with np.errstate(over="ignore"):
        total = np.zeros(len(words) - run + 1, U64)
        for i in range(run):
            total += mix64(words[i : i + len(total)] + _PLACES[i]) * _PLACES[i]
        return np.unique(mix64(total + U64(run)))


def minwise(names: np.ndarray) -> np.ndarray:
    """The smallest image of a set under each of the seeded multiplications."""
    least = np.full(COORDINATES, np.iinfo(U64).max, U64)
    with np.errstate(over="ignore"):
        for at in range(0, len(names), 1024):
            np.minimum(least, (names[at : at + 1024, None] * _SEEDS).min(axis=0), out=least)
    return least


def _sets(batch: pa.RecordBatch, table: WordTable, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle set) of the texts in column 1."""
    for start, stop in slices(batch, 1):
        for i, text in enumerate(utf8(batch.column(1)[start:stop]), start):
            words = text.lower().split()  # bytes: only A-Z change and only ASCII white space cuts
            hashed = np.fromiter(map(table.__getitem__, words), U64, len(words))
            yield i, shingle_set(hashed, size)


def _key(names: np.ndarray) -> bytes | None:
    return hashlib.blake2b(names.tobytes(), digest_size=16).digest() if len(names) else None


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(_id, _n, _key, _sig, _low): set size, digest, minwise values and their low bytes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(xxhash.xxh3_64_intdigest)
        for batch in batches:
            counts, keys, sigs = [], [], []
            for _, names in _sets(batch, table, size):
                counts.append(len(names))
                keys.append(_key(names))
                sigs.append(minwise(names) if len(names) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array([None if s is None else s.view(np.int64) for s in sigs], pa.list_(pa.int64())),
                    pa.array([None if s is None else (s & U64(255)).astype(np.uint8).tobytes() for s in sigs], pa.binary()),
                ],
                names=["_id", "_n", "_key", "_sig", "_low"],
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        sign, "_id long, _n long, _key binary, _sig array<long>, _low binary"
    )


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """(cid, names) of (_id, _text, _key) rows: the whole shingle sets, where the digest agrees."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(xxhash.xxh3_64_intdigest)
        for batch in batches:
            ids, keys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows = [(ids[i], names.view(np.int64)) for i, names in _sets(batch, table, size) if _key(names) == keys[i]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))],
                names=["cid", "names"],
            )

    return docs.select("_id", "_text", "_key").mapInArrow(whole, "cid long, names array<long>")


def _child(node: Column | int, coordinate: Column, sig: Column) -> Column:
    return F.xxhash64(F.lit(node) if isinstance(node, int) else node, coordinate, F.get(sig, coordinate))


def _roots(trees: int, threshold: float) -> list[tuple[int, int]]:
    """(tree, coordinate) picked at the roots: 1 / threshold coordinates a tree on average."""
    rng = random.Random(7)
    picked = []
    double = round(trees * (1 / threshold - 1))
    for tree in range(trees):
        picked += [(tree, c) for c in rng.sample(range(COORDINATES), 2 if tree < double else 1)]
    return picked


def _branch(rows: DataFrame, threshold: float) -> DataFrame:
    """(node, cid) one level further down, from rows with node, cid and _sig."""
    draw = lambda salt, n: F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(n)).cast("int")
    first = draw(1, COORDINATES)
    second = (first + 1 + draw(2, COORDINATES - 1)) % COORDINATES
    two = draw(3, 10_000) < round(10_000 * (1 / threshold - 1))
    one = _child(F.col("node"), first, F.col("_sig"))
    both = F.array(one, _child(F.col("node"), second, F.col("_sig")))
    return rows.select(F.explode(F.when(two, both).otherwise(F.array(one))).alias("node"), "cid")


def _meet(rows: DataFrame, nodes: DataFrame, total: int) -> DataFrame:
    """Rows joined with their node's row; the few nodes that hold many rows are broadcast.

    ``nodes`` has the size ``n`` of each; ``total`` is the number of all rows, so there are
    at most ``HOT_SHARE`` such nodes.
    """
    hot = nodes.where(F.col("n") * HOT_SHARE > total)
    usual = nodes.where(F.col("n") * HOT_SHARE <= total)
    apart = rows.join(F.broadcast(hot.select("node")), "node", "left_anti")
    return rows.join(F.broadcast(hot), "node").unionByName(apart.join(usual, "node"))


def _occupied(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of nodes with company, with the node's size and smallest member."""
    rows = scratch.keep(rows)
    sizes = scratch.keep(rows.groupBy("node").agg(F.count("*").alias("n"), F.min("cid").alias("hub")).where("n > 1"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    met = scratch.keep(_meet(rows, sizes, total))
    scratch.drop(rows, sizes)
    return met


def pairs_within(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of all rows within each of the consecutive groups."""
    ends = np.cumsum(sizes)
    last = np.repeat(ends, sizes)
    index = np.arange(int(ends[-1]) if len(ends) else 0)
    later = last - index - 1
    left = np.repeat(index, later)
    step = np.arange(len(left)) - np.repeat(np.cumsum(later) - later, later)
    return left, left + 1 + step


def _agree(low: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Estimated similarity of signature pairs, chance agreement of one byte taken out."""
    out = np.empty(len(left))
    for at in range(0, len(left), 1 << 15):
        part = slice(at, at + (1 << 15))
        out[part] = (low[left[part]] == low[right[part]]).mean(axis=1)
    return (out - 1 / 256) / (1 - 1 / 256)


def _by_node(rows: DataFrame, floor: float, cross: bool) -> DataFrame:
    """Proposed links (a < b) of small nodes, compared exhaustively.

    Without ``cross`` a class proposes its smallest likely partner only; with it, all
    likely partners in another component. Rows of a node lie side by side.
    """

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            nodes = held.column("node").to_numpy()
            # The last node may go on in the next batch.
            cut = int(np.searchsorted(nodes, nodes[-1])) if len(nodes) else 0
            yield from compare(held.slice(0, cut))
            held = held.slice(cut).combine_chunks()
        if held is not None:
            yield from compare(held)

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        table = table.combine_chunks()
        nodes, ids = table.column("node").to_numpy(), table.column("cid").to_numpy()
        low = np.frombuffer(b"".join(table.column("_low").to_pylist()), np.uint8).reshape(-1, COORDINATES)
        bounds = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
        sizes = np.diff(np.r_[bounds, len(nodes)])
        left, right = pairs_within(sizes)
        if cross:
            roots = table.column("root").to_numpy()
            apart = roots[left] != roots[right]
            left, right = left[apart], right[apart]
        likely = _agree(low, left, right) >= floor
        left, right = left[likely], right[likely]
        if not cross:
            # Pairs come sorted by left; the first of each right is its smallest partner,
            # and a class without a smaller partner proposes its smallest larger one.
            keep = np.zeros(len(left), bool)
            keep[np.unique(right, return_index=True)[1]] = True
            firsts = np.unique(left, return_index=True)[1]
            keep[firsts[~np.isin(left[firsts], right)]] = True
            left, right = left[keep], right[keep]
        yield pa.RecordBatch.from_arrays([pa.array(ids[left]), pa.array(ids[right])], names=["a", "b"])

    columns = ["node", "cid", "_low", *["root"] * cross]
    dealt = rows.select(*columns).repartition(width(rows.sparkSession), "node").sortWithinPartitions("node", "cid")
    return dealt.mapInArrow(links, "a long, b long")


def common_counts(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set in ``one`` with every set in ``two``.

    As products of membership matrices, a few thousand names at a time.
    """
    names = [np.concatenate(part) if part else np.zeros(0, np.int64) for part in (one, two)]
    owners = [np.repeat(np.arange(len(part)), [len(s) for s in part]) for part in (one, two)]
    shared = np.intersect1d(*names)
    out = np.zeros((len(one), len(two)), np.float32)
    for at in range(0, len(shared), COLUMNS):
        chunk = shared[at : at + COLUMNS]
        held = []
        for name, owner, part in zip(names, owners, (one, two), strict=True):
            place = np.minimum(np.searchsorted(chunk, name), len(chunk) - 1)
            there = chunk[place] == name
            matrix = np.zeros((len(part), len(chunk)), np.float32)
            matrix[owner[there], place[there]] = 1
            held.append(matrix)
        out += held[0] @ held[1].T
    return out


def _by_block(rows: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """A spanning forest (u, v) of the links within large mixed nodes, block against block.

    One side of a block pair holds members of a node, the other members outside its largest
    component. Both come with their full sets, so links are confirmed where they are found
    and only those that connect something leave the task.
    """
    percent = round(100 * threshold)

    def links(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids = group.column("cid").to_numpy()
        names = [np.asarray(v.values.to_numpy()) for v in group.column("names")]
        other = group.column("_other").to_numpy(zero_copy_only=False)
        one, two = np.flatnonzero(~other), np.flatnonzero(other)
        common = common_counts([names[k] for k in one], [names[k] for k in two])
        size = np.array([len(n) for n in names])
        union = size[one][:, None] + size[two][None, :] - common
        left, right = np.nonzero(100 * common >= percent * union)
        # A class may stand on both sides: it is one vertex.
        vertices, vertex = np.unique(ids, return_inverse=True)
        root = local_roots(vertex[one[left]], vertex[two[right]], len(vertices))
        moved = np.flatnonzero(root != np.arange(len(vertices)))
        return pa.table({"u": pa.array(vertices[moved]), "v": pa.array(vertices[root[moved]])})

    blocks = lambda n: F.ceil(n / BLOCK).cast("int")
    mine = lambda salt, n: F.pmod(F.xxhash64("cid", F.lit(salt)), blocks(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    outside = F.col("n") - F.col("_top")
    members = rows.select("node", "cid", mine(5, F.col("n")).alias("_i"), every(outside).alias("_j"), F.lit(False).alias("_other"))
    others = rows.where("root <> _major").select(
        "node", "cid", every(F.col("n")).alias("_i"), mine(7, outside).alias("_j"), F.lit(True).alias("_other")
    )
    dealt = members.unionByName(others.select(*members.columns)).join(sets, "cid")
    return dealt.groupBy("node", "_i", "_j").applyInArrow(links, "u long, v long")


def confirm(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The links (u, v) among proposed pairs (a, b) that hold on the full sets."""
    percent = round(100 * threshold)
    right = sets.select(F.col("cid").alias("b"), F.col("names").alias("_right"))
    left = sets.select(F.col("cid").alias("a"), F.col("names").alias("_left"))
    both = pairs.join(right, "b").join(left, "a")
    sized = both.select(
        "a",
        "b",
        F.size(F.array_intersect("_left", "_right")).cast("long").alias("_common"),
        (F.size("_left") + F.size("_right")).cast("long").alias("_all"),
    )
    return sized.where(100 * F.col("_common") >= percent * (F.col("_all") - F.col("_common"))).select(
        F.col("b").alias("u"), F.col("a").alias("v")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    threshold: float = 0.8,
    trees: int = TREES,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document."""
    with Scratch(docs.sparkSession, "neardup") as scratch:
        return _join(docs, id_col, text_col, shingle, threshold, trees, scratch)


def _join(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, threshold: float, trees: int, scratch: Scratch
) -> DataFrame:
    floor = threshold - SLACK
    base = scratch.keep(signatures(docs, id_col, text_col, shingle))
    classes = scratch.keep(
        base.where("_id IS NOT NULL AND _n > 0")
        .groupBy("_key")
        .agg(F.min("_id").alias("cid"), F.first("_sig").alias("_sig"), F.first("_low").alias("_low"))
    )
    lows = classes.select("cid", "_low")

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def sets_of(ids: DataFrame) -> DataFrame:
        """The full sets of some classes, from their texts."""
        asked = ids.join(classes.select("cid", "_key"), "cid").select(F.col("cid").alias("_id"), "_key")
        return scratch.keep(full_sets(texts.join(asked, "_id"), shingle))

    # Down the trees by signature.
    first = F.array(*[_child(tree, F.lit(c), F.col("_sig")) for tree, c in _roots(trees, threshold)])
    level = _occupied(classes.select(F.explode(first).alias("node"), "cid"), scratch)
    spent = [level]
    small, stars = [level.where(F.col("n") <= SMALL)], []
    large = level.where(F.col("n") > SMALL)
    # Whoever is in a large node further down is in one here.
    walkers = scratch.keep(classes.select("cid", "_sig").join(large.select("cid").distinct(), "cid", "left_semi"))
    for _ in range(LEVELS - 1):
        if large.isEmpty():
            break
        stars.append(large.select("cid", "hub"))
        level = _occupied(_branch(large.join(walkers, "cid"), threshold), scratch)
        spent.append(level)
        small.append(level.where(F.col("n") <= SMALL))
        large = level.where(F.col("n") > SMALL)
    stars.append(large.select("cid", "hub"))
    # The rows of the last level that are read again below.
    spent = [df for df in spent if df is not level]
    few = scratch.keep(_union(small).join(lows, "cid").select("node", "cid", "_low"))
    hubs = _union(stars).where("cid <> hub").distinct()
    likely = F.arrow_udf(_estimate, "double")("_low", "_hub_low")
    starred = (
        hubs.join(lows, "cid")
        .join(lows.select(F.col("cid").alias("hub"), F.col("_low").alias("_hub_low")), "hub")
        .where(likely >= floor)
        .select(F.col("hub").alias("a"), F.col("cid").alias("b"))
    )
    proposed = scratch.keep(_by_node(few, floor, False).unionByName(starred).distinct())
    scratch.drop(*spent)
    # Members of nodes that are still large may find partners further down.
    sets = sets_of(_ends(proposed).unionByName(large.select("cid")).distinct())

    # Forest first, then what is still apart.
    forest = proposed.groupBy("b").agg(F.min("a").alias("a"))
    links = scratch.keep(confirm(forest, sets, threshold))
    roots = scratch.keep(components(links, scratch))
    rest = _apart(proposed.join(forest, ["a", "b"], "left_anti"), roots)
    before = [links, roots]
    links = scratch.keep(links.unionByName(confirm(rest, sets, threshold)))
    roots = scratch.keep(components(links, scratch))
    scratch.drop(*before)

    # Small nodes whose members are not all together yet, and large ones in blocks.
    mixed = _mixed(few, roots, scratch)
    more = scratch.keep(_apart(_by_node(mixed, floor, True).distinct(), roots).join(proposed, ["a", "b"], "left_anti"))
    open_nodes = _mixed(large.select("node", "cid"), roots, scratch)
    if not open_nodes.isEmpty():
        links = scratch.keep(links.unionByName(_by_block(open_nodes, sets, threshold)))
        roots = scratch.keep(components(links, scratch))
        more = scratch.keep(_apart(more, roots))
    if not more.isEmpty():
        links = scratch.keep(links.unionByName(confirm(more, sets, threshold)))
        roots = scratch.keep(components(links, scratch))

    named = (
        classes.select("_key", "cid")
        .join(roots, F.col("cid") == F.col("vertex"), "left")
        .select("_key", F.coalesce("root", "cid").alias("_component"))
    )
    component = F.when(F.col("_id").isNotNull(), F.coalesce("_component", "_id"))
    return scratch.finish(
        base.select("_id", "_n", "_key")
        .join(named, "_key", "left")
        .select(
            F.col("_id").alias("doc_id"),
            F.col("_n").alias("n_shingles"),
            component.alias("component_id"),
            F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"),
        )
    )


def _ends(pairs: DataFrame) -> DataFrame:
    """(cid) of all classes in some pair."""
    return pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()


def _estimate(one: pa.Array, two: pa.Array) -> pa.Array:
    left = np.frombuffer(b"".join(one.to_pylist()), np.uint8).reshape(-1, COORDINATES)
    right = np.frombuffer(b"".join(two.to_pylist()), np.uint8).reshape(-1, COORDINATES)
    return pa.array(((left == right).mean(axis=1) - 1 / 256) / (1 - 1 / 256))


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for df in frames[1:]:
        whole = whole.unionByName(df)
    return whole


def _with_root(rows: DataFrame, roots: DataFrame) -> DataFrame:
    found = roots.select(F.col("vertex").alias("cid"), "root")
    return rows.join(found, "cid", "left").withColumn("root", F.coalesce("root", "cid"))


def _mixed(rows: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows, with their root, of nodes whose members are in more than one component.

    With the node's largest component (``_major``) and how many members it has (``_top``).
    """
    rooted = scratch.keep(_with_root(rows, roots))
    counts = rooted.groupBy("node", "root").agg(F.count("*").alias("_n"))
    nodes = counts.groupBy("node").agg(F.max_by("root", "_n").alias("_major"), F.max("_n").alias("_top"), F.sum("_n").alias("n"))
    nodes = scratch.keep(nodes.where("_top < n"))
    total = nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    met = scratch.keep(_meet(rooted, nodes, total))
    scratch.drop(rooted, nodes)
    return met


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose two ends are in different components."""
    for end in ("a", "b"):
        named = roots.select(F.col("vertex").alias(end), F.col("root").alias(f"_root_{end}"))
        pairs = pairs.join(named, end, "left").withColumn(f"_root_{end}", F.coalesce(f"_root_{end}", end))
    return pairs.where("_root_a <> _root_b").select("a", "b")

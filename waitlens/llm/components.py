"""Connected components of a link table, by alternating star operations.

Large-star links every larger neighbour of a vertex to the smallest one; small-star does so
for the smaller neighbours. Both keep the components; after a logarithmic number of rounds
each component is a star around its smallest vertex. All of it is grouping with partial
minima and equi-joins whose hot side the adaptive join splits; only a checksum of the link
table reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitlens.llm.common import Scratch


def local_roots(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Of each of ``n`` rows of one task: the smallest row it reaches over the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _oriented(links: DataFrame) -> DataFrame:
    """(u, v) with u > v, each once."""
    return links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _oriented(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(moved.unionByName(least.select("u", F.col("m").alias("v"))))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(vertex, root) for every vertex that has a link; root is its component's smallest vertex."""
    mark = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    now = scratch.keep(_oriented(links))
    before, state = None, mark(now)
    while state != before and state[0]:
        after = scratch.keep(_small_star(_large_star(now)))
        scratch.drop(now)
        now, before, state = after, state, mark(after)
    roots = now.select("v").distinct().select(F.col("v").alias("vertex"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionByName(roots)

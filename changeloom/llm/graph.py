"""Connected components by large-star and small-star joins.

Joins are merge joins: there are several in each round, and a broadcast each would fill the driver with small tables.  Before each
round the links that a task holds are joined there, so a round starts from few links and few rounds are needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_key_join
from .common import stored

MOST_ROUNDS = 64
# Links that a task joins at a time.
LINKS_AT_ONCE = 1 << 19


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the edges ``u, v`` (whole numbers): root is the smallest node it reaches.

    Each round links every node's neighbours to the smallest of them, first the larger ones and then
    the smaller ones, until all edges point from a node to its root.  The number of rounds is logarithmic in
    practice; each is written to the shared folder.  Loops and repeated edges do no harm; null ends are dropped.
    """
    stars = _forest(edges.where("u <> v").select("u", "v"))
    for _ in range(MOST_ROUNDS):
        stars = stored(stars.distinct(), "stars")
        if _settled(stars):
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        stars = _forest(_small_star(_large_star(stars)))
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def local_roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for links in memory: nodes that are not their own root, and their roots."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b, label = at[: len(u)], at[len(u) :], np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            break
        np.minimum.at(label, high[apart], low[apart])
        while not (label[label] == label).all():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _forest(edges: DataFrame) -> DataFrame:
    """Links ``u, v``, the larger node first, that connect what the edges of one task at a time connect."""

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def joined() -> pa.RecordBatch:
            u, v = local_roots(*(np.concatenate(x) for x in zip(*held)))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in found:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(x[0]) for x in held) >= LINKS_AT_ONCE:
                yield joined()
                held = []
        if held:
            yield joined()

    return edges.select(F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v")).mapInArrow(batches, "u bigint, v bigint")


def _settled(stars: DataFrame) -> bool:
    """Each node has one edge, and no root has one."""
    twice = stars.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("u")
    roots = stars.select(F.col("v").alias("u")).distinct()
    return twice.union(stars.join(roots.hint("merge"), "u", "left_semi").select("u")).isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where("v > u")
    return hot_key_join(larger, least.hint("merge"), ["u"], "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    # A node may have very many smaller neighbours.
    met = hot_key_join(edges, least.hint("merge"), ["u"], "inner").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return met.union(least.select("u", F.col("m").alias("v"))).distinct()


def united(groups: DataFrame, fresh: DataFrame) -> DataFrame:
    """``groups`` (node, root) after further links ``u, v``: only the roots that these links join are worked on."""
    named = groups.select(F.col("node").alias("u"), F.col("root").alias("ru"))
    ends = hot_key_join(fresh.select("u", "v"), named.hint("merge"), ["u"], "left")
    ends = hot_key_join(ends, named.toDF("v", "rv").hint("merge"), ["v"], "left")
    more = stored(components(ends.select(F.coalesce("ru", "u").alias("u"), F.coalesce("rv", "v").alias("v"))), "united-roots")
    # A root may name a large share of all nodes.
    moved = hot_key_join(groups, more.toDF("root", "next").hint("merge"), ["root"], "left").select("node", F.coalesce("next", "root").alias("root"))
    return stored(moved.union(more.join(groups.hint("merge"), "node", "left_anti").select("node", "root")), "united")

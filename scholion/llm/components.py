"""Connected components by alternating stars, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholion.llm.common import broadcast_if_small, written


def _smallest(edges: DataFrame) -> DataFrame:
    """One row per upper end, as a table: the join with it has bare exchanges on both sides."""
    return written(edges.groupBy("a").agg(F.min("b").alias("m")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _smallest(both).select("a", F.least("a", "m").alias("m"))
    return both.join(broadcast_if_small(low), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = _smallest(edges)
    moved = edges.join(broadcast_if_small(low), "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of one orderable type -> (node, root), root the smallest node reachable.
    Nodes without an edge to another node have no row.

    Every round joins each edge with the smallest neighbour of its upper end, large stars first,
    then small ones, and writes the rest as a table; the rounds grow with the logarithm of a
    component's size. The smallest neighbours are written first: their table is broadcast while
    its files are small, and beyond that both sides of the join are bare exchanges, so adaptive
    execution splits a hub's edges over tasks. No neighbour list is ever gathered.
    """
    now = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = _state(now)
    while state[0]:
        then = written(_small_star(_large_star(now).distinct()).distinct())
        seen = _state(then)
        if seen == state:
            break
        now, state = then, seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.expr("xxhash64(b, a) % 1000003"))).first())

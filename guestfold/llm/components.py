"""Connected components of an edge table by repeated contraction, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of the long pairs (a, b) of ``edges``; nodes of one component
    share a root (one of them).  No edges: no rows.  Self-loops, nulls and repeats are ignored.

    A round hooks every node to the least of itself and its neighbours, in the order of a hash of
    the round's own seed, and replaces nodes by what they hook to, until no edge is left.  The random order leaves a
    constant share of the nodes in each round, also on long chains.  Every round is a written table, so nothing
    is recomputed from further back, and no node's neighbours are ever gathered: minima combine before the shuffle."""
    e = scratch.table(edges.filter("a <> b").select("a", "b").distinct())
    labels: DataFrame | None = None
    seed = 0
    while not e.isEmpty():
        seed += 1
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(seed)).alias("h"), F.col(c).alias("n"))  # noqa: E731, B023
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = (both.groupBy("a").agg(F.min(rank("b")).alias("m"))
                .select(F.col("a").alias("node"), F.least("m", rank("a"))["n"].alias("to")))
        hook = scratch.table(hook)
        moved = (e.join(hook.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a")
                 .join(hook.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b")
                 .filter("a2 <> b2")
                 .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct())
        if labels is None:
            new = hook.select("node", F.col("to").alias("root"))
        else:
            new = labels.join(hook.select(F.col("node").alias("root"), "to"), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root"))
        old = [e] + ([labels] if labels is not None else [])
        labels, e = scratch.table(new), scratch.table(moved)
        scratch.drop(hook, *old)
    if labels is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels

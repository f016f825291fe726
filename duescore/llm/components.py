"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duescore.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b of type long); the root is the
    smallest node of the component.

    Each round points every node to the one of least rank among itself and the nodes next
    to it (a combinable minimum, so a hub is aggregated before the shuffle) and
    contracts the edges along these pointers, until no edge is left.  Ranks are hashed
    afresh each round, so about half of the nodes go whatever order the ids have, and a
    chain takes as few rounds as any other component.  The pointers of all rounds are then
    followed from the last round back.  Every round is a written stage table.
    """
    rounds: list[DataFrame] = []
    left = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = F.xxhash64("b", F.lit(len(rounds)))
        best = both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", rank).alias("near"), F.min(rank).alias("rank"))
        own = F.xxhash64("node", F.lit(len(rounds))) < F.col("rank")
        pointer = staged(best.select("node", F.when(own, F.col("node")).otherwise(F.col("near")).alias("root")), "pointers")
        rounds.append(pointer)
        ends = {end: pointer.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")) for end in "ab"}
        moved = left.join(ends["a"], "a").join(ends["b"], "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
        left = staged(moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds.pop()
    while rounds:
        nxt = roots.select(F.col("node").alias("root"), F.col("root").alias("final"))
        roots = rounds.pop().join(nxt, "root", "left").select("node", F.coalesce("final", "root").alias("root"))
    roots = staged(roots, "roots")
    # A table of its own, so that Spark can split a component that holds most nodes.
    names = staged(roots.groupBy("root").agg(F.min("node").alias("name")), "component-names")
    return roots.join(names, "root").select("node", F.col("name").alias("root"))

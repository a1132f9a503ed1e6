"""Connected components of an undirected graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countflow.session import checkpoint

#: A round leaves less than half of the nodes that still have edges, in the mean over its hashes: 100 are enough for any graph that fits on disks.
MAX_ROUNDS = 100
#: Levels whose tables are joined before the result is written.
LEVELS = 4


def _pointers(edges: DataFrame, round_: int) -> DataFrame:
    """(a, p): of each node and its neighbours the one that comes first. In even rounds those with more edges come first, so hubs take their leaves at once; otherwise, and among equals,
    a hash decides that differs from round to round, so no order of the ids makes long chains of pointers."""
    h = lambda c: F.xxhash64(c, F.lit(round_))
    near = edges
    if round_ % 2 == 0:
        near = edges.join(edges.groupBy(F.col("a").alias("b")).agg((-F.count("*")).alias("d")), "b")
    rank = [F.col("d")] if round_ % 2 == 0 else []
    own = [-F.col("n")] if round_ % 2 == 0 else []
    best = near.groupBy("a").agg(F.min(F.struct(*rank, h("b").alias("h"), F.col("b").alias("v"))).alias("best"), F.count("*").alias("n"))
    return best.select("a", F.when(F.struct(*own, h("a"), F.col("a")) < F.col("best"), F.col("a")).otherwise(F.col("best.v")).alias("p"))


def _targets(pointers: DataFrame) -> DataFrame:
    """(a, t): the node that ``a`` becomes part of: the one its pointers end at, if that is at most two steps away, else itself."""
    one = pointers.join(pointers.select(F.col("a").alias("p"), F.col("p").alias("p2")), "p")
    two = one.join(pointers.select(F.col("a").alias("p2"), F.col("p").alias("p3")), "p2")
    return two.select("a", F.when(F.col("p3") == F.col("p2"), F.col("p2")).otherwise(F.col("a")).alias("t"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", node: str = "node", label: str = "label") -> DataFrame:
    """Each end of an edge once, with the smallest node that it is connected to.

    The graph is contracted: in a round nodes become part of a neighbour, or of its neighbour, and edges within such a group go, until no edge is left. So tables shrink from round to round
    and rounds grow with the logarithm of the number of nodes (a shuffled path of 100,000 nodes takes 11). Then the levels are read back from the last to the first, and each group takes its smallest node.
    A hub's edges are one side of joins whose other side has each key once, so Spark's adaptive skew join (on by default) splits them; aggregates have a map side.
    Self loops give their node a component of its own; edges with a null end are ignored. Tables are written to the shared folder.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = checkpoint(ends.union(ends.select("b", "a")).distinct())
    left, levels = both.filter("a <> b"), []
    while left.limit(1).count():
        if len(levels) == MAX_ROUNDS:
            raise RuntimeError(f"edges were left after {MAX_ROUNDS} rounds")
        target = checkpoint(_targets(checkpoint(_pointers(left, len(levels)))))
        levels.append(target)
        to = target.select(F.col("a").alias("b"), F.col("t").alias("tb"))
        left = checkpoint(left.join(target, "a").join(to, "b").filter("t <> tb").select(F.col("t").alias("a"), F.col("tb").alias("b")).distinct())
    if not levels:
        return both.select(F.col("a").alias(node), F.col("b").alias(label))
    group = levels.pop()
    while levels:
        upper = group.select(F.col("a").alias("t"), F.col("t").alias("t2"))
        group = levels.pop().join(upper, "t", "left").select("a", F.coalesce("t2", "t").alias("t"))
        if len(levels) % LEVELS == 0:
            group = checkpoint(group)
    first = group.groupBy("t").agg(F.min("a").alias("first"))
    found = group.join(first, "t").select(F.col("a").alias(node), F.col("first").alias(label))
    alone = both.groupBy("a").agg(F.max(F.col("b") != F.col("a")).alias("linked")).filter("NOT linked")
    return checkpoint(found.unionByName(alone.select(F.col("a").alias(node), F.col("a").alias(label))))
